"""Raw result pages of a source → cards in the bronze layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators.dedup import dedup_first_seen
from hirelake.operators.extract import QUERIES, extract_cards_dou, extract_cards_ithub, extract_cards_workua
from hirelake.params import RunParams
from hirelake.schemas import CARD_SCHEMAS
from hirelake.sources.lake import read_search_pages, write_cards

EXTRACT = {"workua": extract_cards_workua, "dou": extract_cards_dou, "ithub": extract_cards_ithub}
KEYS = {"workua": "job_id", "dou": "job_url", "ithub": "job_url"}


def parse_cards(pages: DataFrame, source: str) -> DataFrame:
    """Cards of pages(html, query_name, page, fetched_at, dt): of repeated postings the first in crawl order stays.

    Crawl order is the order of the queries as they are listed, then page, then place on the page; pages of a query that
    is not listed come last, by its name.
    """
    if source == "workua":
        listed = {q["query_name"]: q for q in QUERIES}
        of = lambda field: F.coalesce(
            *[F.when(F.col("query_name") == n, F.lit(q[field])) for n, q in listed.items()])
        pages = pages.withColumns({"query_text": of("query_text"), "role_family": of("role_family")})
    cards = EXTRACT[source](pages)
    rank = F.lit(0)
    if source == "workua":
        rank = F.coalesce(*[F.when(F.col("query_name") == q["query_name"], F.lit(i)) for i, q in enumerate(QUERIES)],
                          F.lit(len(QUERIES)))
    order = ["_crawl", *(["query_name"] if "query_name" in cards.columns else []), "page", "position"]
    first = dedup_first_seen(cards.withColumn("_crawl", rank), KEYS[source], order)
    return first.withColumn("position", F.col("position").cast("long")).select(*[
        F.col(n) if n in first.columns else F.lit(None).cast(t).alias(n)
        for n, t in ((f.name, f.dataType) for f in CARD_SCHEMAS[source])])


def run_cards(spark: SparkSession, params: RunParams, source: str) -> None:
    """Parse a day's raw result pages and store their cards."""
    pages = read_search_pages(spark, params.bronze, source, params.dt)
    write_cards(parse_cards(pages, source), params.bronze, source, params.dt)
