"""Row-wise operators of the silver layer: projections, filters, blank-aware merging, text assembly, identity."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.text import lower_or_empty
from hirelake.functions.urls import job_id_ithub, job_id_workua
from hirelake.schemas import CLEAN_COLUMNS

CARD_TEXT = [
    "job_url", "title", "company", "location", "snippet", "published_text", "source", "query_name", "query_text",
    "role_family", "dt", "fetched_at",
]
DETAIL_RENAMES = {
    "title": "detail_title",
    "company": "detail_company",
    "location": "detail_location",
    "published_text": "detail_published_text",
}
DETAIL_TEXT = {
    "dou": ["description_full", "page_text"],
    "workua": ["employment_type", "experience_text", "education_text", "description_full", "page_text"],
}

# The columns joined into the searched text, in order (classifiers read only its head).
BLOB_COLUMNS = {
    "dou": [
        "title", "snippet", "description_full", "page_text", "location", "published_text", "query_name",
        "query_text", "role_family",
    ],
    "workua": [
        "title", "snippet", "description_full", "page_text", "employment_type", "experience_text",
        "education_text", "location", "published_text", "query_name", "query_text", "role_family",
    ],
    "ithub": [
        "title", "snippet", "description_full", "query_name", "query_text", "role_family", "skills_raw_text",
    ],
}


def null_text() -> Column:
    return F.lit(None).cast("string")


def _text(present: Collection[str], name: str, source: str | None = None) -> str:
    source = name if source is None else source
    return f"CAST({source if source in present else 'NULL'} AS STRING) AS {name}"


def project_cards(cards: DataFrame, source: str) -> DataFrame:
    """Cards of one source in the common shape; what a source does not have becomes a typed null."""
    present = set(cards.columns)
    if source == "workua":
        job_id = job_id_workua(F.col("job_url")).alias("job_id")
        return cards.select(job_id, *[F.expr(_text(present, c)) for c in CARD_TEXT])
    if source == "dou":
        return cards.selectExpr(*[_text(present - {"query_name", "query_text"}, c) for c in CARD_TEXT])
    columns = {"location": None, "snippet": "meta_text"}
    texts = [_text(present - {"location"}, c, columns.get(c)) for c in [*CARD_TEXT, "description_full"]]
    return cards.select(job_id_ithub(F.col("job_url")).alias("job_id"), *[F.expr(t) for t in texts], F.col("skills_raw"))


def project_details(details: DataFrame, source: str) -> DataFrame:
    """Details of one source; columns that cards have too get the prefix ``detail_``.

    On the board that joins by URL a blank URL is no key.
    """
    present = set(details.columns)
    url = "nullif(CAST(job_url AS STRING), '') AS job_url" if source == "dou" else _text(present, "job_url")
    renamed = [_text(present, new, old) for old, new in DETAIL_RENAMES.items()]
    return details.selectExpr(_text(present, "job_id"), url, *renamed, *[_text(present, c) for c in DETAIL_TEXT[source]])


def filter_key_not_null(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def filter_title_keyword(df: DataFrame, keywords: Sequence[str] = rules.TITLE_KEYWORDS) -> DataFrame:
    """Keep rows whose title holds one of the keywords, in any case."""
    title = lower_or_empty(F.col("title"))
    wanted = F.lit(False)
    for keyword in keywords:
        wanted = wanted | title.contains(keyword)
    return df.where(wanted)


def coalesce_first(*values: Column) -> Column:
    """First non-null value; an empty string counts as a value."""
    return F.coalesce(*values)


def coalesce_nonblank(*values: Column) -> Column:
    """First value that holds more than spaces, unchanged; null when all are blank."""
    return F.coalesce(*[F.when(F.length(F.trim(v)) > 0, v) for v in values])


def build_text_blob(columns: Sequence[str]) -> Column:
    """Columns joined by single spaces; a null column leaves its separator in place."""
    return F.expr("concat_ws(' ', " + ", ".join(f"coalesce({c}, '')" for c in columns) + ")")


def flatten_raw_skills(skills: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(skills, F.array().cast("array<string>")))


def make_uid(source: Column, default_source: str, *identities: Column) -> Column:
    """``source::identity`` from the first identity that is not null."""
    return F.concat_ws("::", F.coalesce(source, F.lit(default_source)), F.coalesce(*identities))


def final_projection(df: DataFrame, columns: Sequence[str] = CLEAN_COLUMNS) -> DataFrame:
    return df.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in columns])
