"""Joins. No side is broadcast by hint: both grow with the data, and AQE broadcasts what it has measured."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.operators.dedup import first_rank


def join_details_left(cards: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Cards with their detail columns, nulls where there is no detail.

    Both sides come deduplicated on ``key``, so they are already partitioned by it and the join adds no shuffle.
    """
    return cards.join(details, on=key, how="left")


def lookup_url_by_job_id(pages: DataFrame, cards: DataFrame, job_id: Column, latest_first: Sequence[str]) -> DataFrame:
    """Add ``job_url`` to parsed pages from the cards' URLs; the last card of an id wins, '' without a card.

    ``job_id`` derives the id from the card's ``job_url``; ``latest_first`` sorts the cards, in SQL sort terms.
    """
    known = cards.where(F.coalesce(F.col("job_url"), F.lit("")) != "").withColumn("_id", job_id)
    last = first_rank(known, ["_id"], latest_first).select(F.col("_id").alias("job_id"), F.col("job_url").alias("_url"))
    joined = pages.drop("job_url").join(last, on="job_id", how="left")
    return joined.withColumn("job_url", F.coalesce(F.col("_url"), F.lit(""))).drop("_url")


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all sources; no deduplication."""
    return reduce(DataFrame.unionByName, frames)


def cross_join_total(counts: DataFrame, count_column: str, total: str) -> DataFrame:
    """Every row with the sum of ``count_column``; the broadcast side is a global aggregate, always one row."""
    one_row = counts.agg(F.sum(count_column).alias(total))
    return counts.crossJoin(F.broadcast(one_row))


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys absent in the parent, with their row counts; null child keys are ignored.

    Both sides are reduced to distinct keys first, map side included, so a hot key costs one row per task.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_key"))
    counted = keys.agg(F.count("*").alias("child_rows"))
    known = parent.select(F.col(parent_key).alias("_key")).distinct()
    return counted.join(known, on="_key", how="left_anti").withColumnRenamed("_key", child_key)
