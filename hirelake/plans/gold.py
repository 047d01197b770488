"""Clean postings of all sources → staging, unified and deduplicated postings, marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from hirelake.functions import rules
from hirelake.operators.dedup import ROW_IDS, best_per_cross_source_key, latest_per_uid
from hirelake.operators.incremental import incremental_filter
from hirelake.operators.joins import union_sources
from hirelake.operators.marts import category_share, order_by_count_then_key, skill_demand, source_coverage
from hirelake.operators.project import final_projection
from hirelake.operators.quality import Expectation, expect_accepted_values, expect_not_null, expect_unique
from hirelake.schemas import CLEAN_COLUMNS
from hirelake.sources.tables import compact_table, read_upserted, stored_batches, upsert_table


#: Batches of a staging table after which it is compacted.
COMPACT_AFTER = 30


def stage(spark: SparkSession, clean: DataFrame, path: str, *, inclusive: bool = False) -> DataFrame:
    """Bring new days of a clean table into its staging table, one row per posting."""
    rows = clean
    own = [c for c in ROW_IDS if c in clean.columns]  # stored rows are ranked without their long texts
    batches = stored_batches(spark, path)
    if batches >= COMPACT_AFTER:
        compact_table(spark, path)
    if batches:
        rows = incremental_filter(clean, read_upserted(spark, path), inclusive=inclusive)
    upsert_table(spark, path, latest_per_uid(final_projection(rows, [*CLEAN_COLUMNS, *own])), "source_job_uid")
    return final_projection(read_upserted(spark, path))


def unified(staged: Mapping[str, DataFrame]) -> DataFrame:
    return final_projection(union_sources(*staged.values()))


def deduped(all_postings: DataFrame) -> DataFrame:
    return best_per_cross_source_key(all_postings)


def marts(deduped_postings: DataFrame, *, keys_are_unique: bool = True) -> dict[str, DataFrame]:
    """The three marts, sorted, and the postings per source. Store ``deduped_postings`` first: all four read it."""
    return {
        "mart_skill_demand": order_by_count_then_key(
            skill_demand(deduped_postings, keys_are_unique=keys_are_unique), "skill"
        ),
        "mart_seniority_share": order_by_count_then_key(category_share(deduped_postings, "seniority"), "seniority"),
        "mart_remote_share": order_by_count_then_key(category_share(deduped_postings, "remote_type"), "remote_type"),
        "mart_source_coverage": order_by_count_then_key(source_coverage(deduped_postings), "source"),
    }


_CLASSES = [
    expect_accepted_values("remote_type", rules.REMOTE_TYPES),
    expect_accepted_values("seniority", rules.SENIORITIES),
]


def staging_expectations(source: str) -> list[Expectation]:
    return [
        expect_not_null("source_job_uid"), expect_unique("source_job_uid"), expect_not_null("job_url"),
        expect_not_null("source"), expect_accepted_values("source", [source]), *_CLASSES,
    ]


UNIFIED_EXPECTATIONS = [
    expect_not_null("source_job_uid"), expect_not_null("source"), expect_accepted_values("source", rules.SOURCES),
    expect_not_null("seniority"), expect_not_null("remote_type"), *_CLASSES,
]
DEDUPED_EXPECTATIONS = [
    expect_not_null("cross_source_job_key"), expect_unique("cross_source_job_key"), expect_not_null("source_job_uid"),
    expect_not_null("source"), expect_accepted_values("source", rules.SOURCES),
]
MART_EXPECTATIONS = {
    "mart_skill_demand": [expect_not_null("skill"), expect_unique("skill"), expect_not_null("job_count")],
    "mart_seniority_share": [
        expect_not_null("seniority"), expect_unique("seniority"),
        expect_accepted_values("seniority", rules.SENIORITIES), expect_not_null("job_count"), expect_not_null("share_pct"),
    ],
    "mart_remote_share": [
        expect_not_null("remote_type"), expect_unique("remote_type"),
        expect_accepted_values("remote_type", rules.REMOTE_TYPES), expect_not_null("job_count"),
        expect_not_null("share_pct"),
    ],
}
