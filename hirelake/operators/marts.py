"""Aggregates over deduplicated postings."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.text import is_blank


def filter_blank_skills(df: DataFrame, column: str = "skills") -> DataFrame:
    return df.where(~is_blank(F.col(column)))


def lateral_unnest_skills(df: DataFrame) -> DataFrame:
    """One row per posting and listed skill, trimmed, blanks dropped, repeats within a posting dropped."""
    names = F.array_distinct(F.split(F.trim(F.col("skills")), " *, *"))
    exploded = df.select("cross_source_job_key", F.explode(names).alias("skill"))
    return filter_blank_skills(exploded, "skill")


def skill_demand(deduped: DataFrame, *, keys_are_unique: bool = False) -> DataFrame:
    """Postings per skill, each posting counted once per skill.

    The unnest already drops repeats within a row. Where every posting is one row (a stored, deduplicated table)
    ``keys_are_unique=True`` skips the distinct over all pairs and with it a shuffle of the exploded data.
    """
    pairs = lateral_unnest_skills(filter_blank_skills(deduped.select("cross_source_job_key", "skills")))
    if not keys_are_unique:
        pairs = pairs.distinct()
    return pairs.groupBy("skill").agg(F.count("*").alias("job_count"))


def default_unknown(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(rules.UNKNOWN)).alias(column)


def count_by_category(df: DataFrame, column: str) -> DataFrame:
    return df.select(default_unknown(column)).groupBy(column).agg(F.count("*").alias("job_count"))


def share_pct(count: Column, total: Column) -> Column:
    """Percentage as a decimal with two places, half away from zero; null for a total of zero."""
    return F.round(F.lit(Decimal("100.0")) * count / F.nullif(total, F.lit(0)), 2)


def category_share(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of every value of a category column."""
    # a few rows, one per category: their total is a window over them, and the input is planned once
    total = F.sum("job_count").over(Window.partitionBy(F.lit(1)))
    counted = count_by_category(df, column).withColumn("_total", total)
    return counted.select(column, "job_count", share_pct(F.col("job_count"), F.col("_total")).alias("share_pct"))


def order_by_count_then_key(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.col("job_count").desc_nulls_last(), F.col(key).asc_nulls_first())


def top_skills(deduped: DataFrame, k: int, *, keys_are_unique: bool = False) -> DataFrame:
    """The k most demanded skills."""
    return order_by_count_then_key(skill_demand(deduped, keys_are_unique=keys_are_unique), "skill").limit(k)


def source_coverage(postings: DataFrame) -> DataFrame:
    return postings.groupBy("source").agg(F.count("*").alias("job_count"))
