"""The bronze layer: JSON cards and details, raw HTML pages.

Layout under the bronze root (``dt`` names the run day)::

    jobs/source=workua/query=<name>/dt=<dt>/parsed/*.json      cards, a JSON list per file
    jobs/source=<dou|ithub>/dt=<dt>/parsed/search_results.json
    jobs/source=<source>/details_raw/dt=<dt>/job_<id>.html
    jobs/source=<source>/details_parsed/dt=<dt>/job_*.json     details, one JSON object per file
    jobs/source=<source>/details_parsed/dt=<dt>/part-*.json    details as written here, one JSON object per line

Unreadable input raises (``PATH_NOT_FOUND`` and the like); it is never taken for an empty day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions.urls import job_id_from_filename
from hirelake.schemas import CARD_SCHEMAS, DETAIL_SCHEMAS


def cards_path(root: str, source: str, dt: str) -> str:
    if source == "workua":
        return f"{root}/jobs/source=workua/query=*/dt={dt}/parsed"
    return f"{root}/jobs/source={source}/dt={dt}/parsed"


def details_path(root: str, source: str) -> str:
    return f"{root}/jobs/source={source}/details_parsed"


def raw_details_path(root: str, source: str, dt: str) -> str:
    return f"{root}/jobs/source={source}/details_raw/dt={dt}/*.html"


def _json(spark: SparkSession, schema):
    """A malformed file raises instead of reading as nulls."""
    return spark.read.schema(schema).option("mode", "FAILFAST")


def read_cards(
    spark: SparkSession, root: str, source: str, dt: str, *, lines: bool = False, path: str | None = None
) -> DataFrame:
    """Cards of a day, JSON lists as well as the line-delimited files that :func:`write_cards` makes.

    ``path`` with ``lines`` reads other files of one form. Cards without ``position`` get their place in their file, from
    0, whatever splits the file is read in; files written here hold positions already.
    """
    folder = cards_path(root, source, dt)
    if path and lines:
        return _placed(_json(spark, CARD_SCHEMAS[source]).json(path, multiLine=False))
    listed = _listed_cards(spark, path or folder, source, "*" if path else "search*.json")
    if path:
        return listed
    return listed.unionByName(
        _json(spark, CARD_SCHEMAS[source]).json(folder, multiLine=False, pathGlobFilter="part-*.json"))


def _listed_cards(spark: SparkSession, path: str, source: str, files: str) -> DataFrame:
    """Files with one JSON list each. A file is one row, so its elements number themselves without shuffle."""
    schema = CARD_SCHEMAS[source]
    texts = spark.read.text(path, wholetext=True, pathGlobFilter=files).where(F.length(F.trim("value")) > 0)
    cards = F.from_json("value", T.ArrayType(schema), {"mode": "FAILFAST"})
    rows = texts.select(F.posexplode(cards).alias("_place", "_card")).select("_place", "_card.*")
    return rows.withColumn("position", F.coalesce("position", F.col("_place").cast("long"))).drop("_place")


def _placed(cards: DataFrame) -> DataFrame:
    """Rows of line-delimited files with their place in the file where they have no ``position``.

    A split numbers its rows as they come; a narrow second scan counts the rows of each split, and those of the splits
    before it in the file are added. Both scans deal the same splits to the same tasks, as the listing is the same.
    A reader that does not ask for ``position`` has neither the second scan nor the join.
    """
    rows = cards.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"))
    splits = rows.groupBy("_file", "_block").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("position").isNull()).alias("_open"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    place = F.when(F.col("_open") > 0, F.col("_before") + F.col("_row") - F.col("_first"))
    placed = rows.join(splits, ["_file", "_block"], "left").withColumn("position", F.coalesce("position", place))
    return placed.select(*cards.columns)


def write_cards(cards: DataFrame, root: str, source: str, dt: str) -> None:
    """A day's cards as JSON lines, in one folder for all queries; a rerun replaces them.

    Cards without ``position`` get one that follows their order in the frame, so every read finds the same.
    """
    cards = cards.withColumn("position", F.coalesce("position", F.monotonically_increasing_id()))
    cards.write.mode("overwrite").option("ignoreNullFields", False).json(parsed_cards_path(root, source, dt))


def parsed_cards_path(root: str, source: str, dt: str) -> str:
    return f"{root}/jobs/source={source}/{'query=all/' if source == 'workua' else ''}dt={dt}/parsed"


def search_pages_path(root: str, source: str, dt: str) -> str:
    return f"{root}/jobs/source={source}/{'query=*/' if source == 'workua' else ''}dt={dt}/raw/search_page_*.html"


def read_search_pages(spark: SparkSession, root: str, source: str, dt: str, *, path: str | None = None) -> DataFrame:
    """Every raw result page of a day: (html, source, query_name, page, fetched_at, dt); query and page from its path."""
    pages = spark.read.text(path or search_pages_path(root, source, dt), wholetext=True)
    file = F.col("_metadata.file_path")
    return pages.select(
        F.col("value").alias("html"), F.lit(source).alias("source"),
        F.nullif(F.regexp_extract(file, r"/query=([^/]*)/", 1), F.lit("")).alias("query_name"),
        F.regexp_extract(file, r"search_page_(\d+)\.html$", 1).cast("long").alias("page"),
        F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetched_at"),
        F.lit(dt).alias("dt"),
    )


def read_details(spark: SparkSession, root: str, source: str, dt: str) -> DataFrame:
    """Details of a day, whichever of the two file forms holds them."""
    path, reader = f"{details_path(root, source)}/dt={dt}", _json(spark, DETAIL_SCHEMAS[source])
    objects = reader.json(path, multiLine=True, pathGlobFilter="job_*.json")
    lines = reader.json(path, multiLine=False, pathGlobFilter="part-*.json")
    return objects.unionByName(lines).withColumn("dt", F.coalesce("dt", F.lit(dt)))


def read_html_pages(spark: SparkSession, root: str, source: str, dt: str, *, path: str | None = None) -> DataFrame:
    """Every raw detail page of a day: (job_id, html, source, dt), the id taken from the file name."""
    pages = spark.read.text(path or raw_details_path(root, source, dt), wholetext=True)
    return pages.select(
        job_id_from_filename(F.col("_metadata.file_name")).alias("job_id"),
        F.col("value").alias("html"),
        F.lit(source).alias("source"),
        F.lit(dt).alias("dt"),
    )


def write_parsed_pages(details: DataFrame, root: str, source: str) -> None:
    """Details of one source as JSON lines, many rows per file; a rerun replaces the days it holds, no others."""
    writer = details.write.mode("overwrite").partitionBy("dt").option("partitionOverwriteMode", "dynamic")
    writer.option("ignoreNullFields", False).json(details_path(root, source))


def read_parsed_pages(spark: SparkSession, root: str, source: str) -> DataFrame:
    """All days that ``write_parsed_pages`` wrote; a filter on ``dt`` prunes partitions."""
    reader = _json(spark, DETAIL_SCHEMAS[source])
    return reader.json(details_path(root, source), pathGlobFilter="part-*.json")


def day_inputs(root: str, source: str, dt: str) -> list[str]:
    """Where a day's input of a source lies, as patterns: raw pages, cards and details of that day alone."""
    pages = search_pages_path(root, source, dt).rsplit("/", 1)[0]
    return [cards_path(root, source, dt), pages, f"{details_path(root, source)}/dt={dt}", raw_details_path(root, source, dt).rsplit("/", 1)[0]]


def has_rows(*frames: DataFrame) -> bool:
    """Empty-input guard: false when any frame is empty (each probe stops at its first row)."""
    return all(not df.isEmpty() for df in frames)
