"""Cards and details of a source → clean, tagged postings."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.classify import skills_csv, with_classification
from hirelake.operators.dedup import dedup_any_by_key
from hirelake.operators.joins import join_details_left, union_sources
from hirelake.operators.project import (
    BLOB_COLUMNS,
    build_text_blob,
    coalesce_first,
    coalesce_nonblank,
    filter_key_not_null,
    filter_title_keyword,
    final_projection,
    flatten_raw_skills,
    make_uid,
    null_text,
    project_cards,
    project_details,
)
from hirelake.params import RunParams
from hirelake.schemas import CLEAN_COLUMNS
from hirelake.sources.lake import has_rows, read_cards, read_details
from hirelake.sources.tables import day_folders, promote_replace, scan_clean, silver_path, write_silver_day
from hirelake.sources.warehouse import promote_in_warehouse, write_jdbc_replace

log = logging.getLogger(__name__)

# the column on which cards and details of a source meet
JOIN_KEYS = {"workua": "job_id", "dou": "job_url"}


def unique_cards(cards: DataFrame, source: str) -> DataFrame:
    key = JOIN_KEYS.get(source, "job_url")
    return dedup_any_by_key(filter_key_not_null(project_cards(cards, source), key), key)


def unique_details(details: DataFrame, source: str) -> DataFrame:
    key = JOIN_KEYS[source]
    return dedup_any_by_key(filter_key_not_null(project_details(details, source), key), key)


def joined_postings(cards: DataFrame, details: DataFrame | None, source: str) -> DataFrame:
    """Cards with the facts of their details merged in, before tagging."""
    if source == "ithub":
        kept = filter_title_keyword(unique_cards(cards, source))
        return kept.withColumns(
            {
                "page_text": null_text(),
                "skills_raw_text": flatten_raw_skills(F.col("skills_raw")),
                "experience_text": null_text(),
                "source_job_uid": make_uid(F.col("source"), source, F.col("job_id"), F.col("job_url")),
            }
        )
    key = JOIN_KEYS[source]
    side = unique_details(details, source)
    other = "job_id" if key == "job_url" else "job_url"
    side = side.withColumnRenamed(other, f"detail_{other}")
    joined = join_details_left(unique_cards(cards, source), side, key)
    detail_id = F.col("detail_job_id") if key == "job_url" else F.col("job_id")
    url = F.col("job_url") if key == "job_url" else coalesce_first(F.col("job_url"), F.col("detail_job_url"))
    merged = joined.withColumns(
        {
            "source_job_uid": make_uid(F.col("source"), source, detail_id, url),
            "job_id": coalesce_first(detail_id, url),
            "job_url": url,
            "title": coalesce_first(F.col("title"), F.col("detail_title")),
            **{
                c: coalesce_nonblank(F.col(c), F.col(f"detail_{c}"))
                for c in ("company", "location", "published_text")
            },
        }
    )
    return merged if source == "workua" else merged.withColumn("experience_text", null_text())


_UNTAGGED = [c for c in CLEAN_COLUMNS if c not in ("remote_type", "seniority", "skills")]


def searchable_postings(cards: DataFrame, details: DataFrame | None, source: str) -> DataFrame:
    """Merged postings with ``text_blob``, the text that the rules search; same columns for every source."""
    blob = build_text_blob(BLOB_COLUMNS[source]).alias("text_blob")
    return joined_postings(cards, details, source).select(*_UNTAGGED, "experience_text", blob)


def tagged(postings: DataFrame) -> DataFrame:
    """Searchable postings → the 19 clean columns, all expressions native."""
    return final_projection(with_classification(postings).withColumn("skills", skills_csv(F.col("skills_array"))))


def silver(cards: DataFrame, details: DataFrame | None, source: str) -> DataFrame:
    """The clean postings of one source."""
    return tagged(searchable_postings(cards, details, source))


def silver_all(inputs: Mapping[str, tuple[DataFrame, DataFrame | None]]) -> DataFrame:
    """The clean postings of several sources; tagging follows the union, so its code is generated once."""
    return tagged(union_sources(*[searchable_postings(c, d, source) for source, (c, d) in inputs.items()]))


def run_silver(spark: SparkSession, params: RunParams, source: str) -> DataFrame | None:
    """Read a day, write its parquet partition, feed the warehouse from that; None when there is nothing to do."""
    cards = read_cards(spark, params.bronze, source, params.dt)
    details = None if source == "ithub" else read_details(spark, params.bronze, source, params.dt)
    if not has_rows(cards, *([] if details is None else [details])):
        log.warning("no input for %s on %s, nothing written", source, params.dt)
        return None
    path = silver_path(params.silver, source)
    write_silver_day(silver(cards, details, source), path, params.dt)
    # both sinks get the same rows: the warehouse is fed from the stored partition, not from a second computation
    stored = scan_clean(spark, path, params.dt)
    if params.jdbc:
        final, staging = f"{source}_jobs_clean", f"{source}_jobs_clean__staging"
        write_jdbc_replace(stored, params.jdbc, staging)
        promote_in_warehouse(spark, params.jdbc, final, staging)
    if params.catalog:
        (day,) = day_folders(spark, path, params.dt)  # the files just stored, not a copy
        promote_replace(spark, f"{params.catalog}.{source}_jobs_clean", day)
    return stored
