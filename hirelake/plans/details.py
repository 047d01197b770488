"""Raw detail pages of a source → parsed details in the bronze layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.urls import job_id_dou, workua_url_from_id
from hirelake.operators.extract import extract_detail_dou, extract_detail_workua
from hirelake.operators.joins import lookup_url_by_job_id
from hirelake.params import RunParams
from hirelake.sources.lake import read_cards, read_html_pages, write_parsed_pages


#: Sources that have posting pages.
DETAIL_SOURCES = ("workua", "dou")


def parse_details_workua(pages: DataFrame) -> DataFrame:
    """Details of pages(job_id, html, dt); the URL is rebuilt from the id."""
    return extract_detail_workua(pages.withColumn("job_url", workua_url_from_id(F.col("job_id"))))


def parse_details_dou(pages: DataFrame, cards: DataFrame) -> DataFrame:
    """Details of pages(job_id, html, dt); the URL comes from the card with the same id, the last one seen.

    The lookup follows the extraction, so pages meet the cards without their HTML.
    """
    details = extract_detail_dou(pages.withColumn("job_url", F.lit("")))
    order = [c for c in ("page", "position", "job_url") if c in cards.columns]
    latest_first = [f"{c} DESC NULLS LAST" for c in order]
    found = lookup_url_by_job_id(details, cards, job_id_dou(F.col("job_url")), latest_first)
    return found.select(*details.columns)


def run_details(spark: SparkSession, params: RunParams, source: str) -> None:
    """Parse a day's raw pages of a source that has posting pages."""
    if source not in DETAIL_SOURCES:
        raise ValueError(f"{source} has no posting pages")
    pages = read_html_pages(spark, params.bronze, source, params.dt)
    if source == "workua":
        details = parse_details_workua(pages)
    else:
        details = parse_details_dou(pages, read_cards(spark, params.bronze, source, params.dt))
    write_parsed_pages(details, params.bronze, source)
