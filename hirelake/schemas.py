"""Declared schemas: reading never infers types, and a field absent from every file reads as null."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# The field lists of cards, details and clean postings, in their order; `position` is this library's own.
_PAGE = [T.StructField("page", T.LongType()), T.StructField("position", T.LongType())]

CARD_SCHEMAS = {
    "workua": T.StructType(
        _strings(
            "source", "query_name", "query_text", "role_family", "job_id", "job_url", "title", "company",
            "location", "snippet", "published_text", "fetched_at", "dt",
        )
        + _PAGE
    ),
    "dou": T.StructType(
        _strings(
            "source", "role_family", "job_url", "title", "company", "location", "published_text", "snippet",
            "fetched_at", "dt",
        )
        + _PAGE
    ),
    "ithub": T.StructType(
        _strings("job_url", "title", "company", "company_type", "meta_text", "published_text", "description_full")
        + [T.StructField("skills_raw", T.ArrayType(T.StringType()))]
        + _strings("source", "query_name", "query_text", "role_family", "dt")
        + _PAGE
        + _strings("fetched_at")
    ),
}

DETAIL_SCHEMAS = {
    "workua": T.StructType(
        _strings(
            "job_id", "job_url", "title", "company", "location", "published_text", "employment_type",
            "experience_text", "education_text", "description_full", "page_text", "source", "dt",
        )
    ),
    "dou": T.StructType(
        _strings(
            "job_id", "job_url", "title", "company", "location", "published_text", "description_full",
            "page_text", "source", "dt",
        )
    ),
}

CLEAN_COLUMNS = [
    "source_job_uid", "job_id", "job_url", "title", "company", "location", "snippet", "published_text",
    "description_full", "page_text", "source", "query_name", "query_text", "role_family", "remote_type",
    "seniority", "skills", "dt", "fetched_at",
]
CLEAN_SCHEMA = T.StructType(_strings(*CLEAN_COLUMNS))

DEDUPED_COLUMNS = ["cross_source_job_key", *CLEAN_COLUMNS]

METRIC_SCHEMA = T.StructType(
    [T.StructField("run_date", T.DateType())]
    + _strings("dag_id", "source_name", "layer_name", "metric_name")
    + [T.StructField("metric_value", T.DecimalType(38, 18))]
)
