"""Queries over whole plans and stored layers, registered beside those of :mod:`harness.queries`."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from harness import oracles as o
from harness import views
from harness.queries import ORACLES, QUERIES, query
from harness.views import table
from hirelake.functions import rules
from hirelake.operators import joins
from hirelake.plans import details as plans_details
from hirelake.plans.cards import parse_cards
from hirelake.schemas import CARD_SCHEMAS
from hirelake.session import fresh_dir
from hirelake.sources import lake, tables

# --- result pages → cards ----------------------------------------------------------------------------------------

#: Pages are found under one query or another, every fourth under the first query as well.
_FOUND_BY = "CASE page % 3 WHEN 0 THEN 'inzhener_danykh' WHEN 1 THEN 'data_engineer' ELSE 'another' END"
_CARD_COLUMNS = ("source", "job_url", "title", "published_text", "query_name", "query_text", "role_family", "page")


def _first_seen_sql(source: str, url: str, columns: str, crawled: str, order: str) -> str:
    return f"""SELECT '{source}' AS source, {url} AS job_url, title, published AS published_text, {columns}, page
FROM ({crawled}) WHERE has_link = 1 QUALIFY row_number() OVER (PARTITION BY number ORDER BY {order}) = 1"""


@query(
    o.sql(
        [f"d AS (SELECT {o._cols(views.RENDERED)} FROM documents)"],
        " UNION ALL ".join([
            _first_seen_sql(
                "workua", "concat('https://www.work.ua/jobs/', number, '/')",
                """query_name, CASE query_name WHEN 'data_engineer' THEN 'data engineer' WHEN 'inzhener_danykh' THEN 'інженер даних' END
  AS query_text, CASE WHEN query_name <> 'another' THEN 'data_engineer' END AS role_family""",
                f"SELECT *, {_FOUND_BY} AS query_name FROM d UNION ALL SELECT *, 'data_engineer' FROM d WHERE page % 4 = 0",
                "CASE query_name WHEN 'data_engineer' THEN 0 WHEN 'inzhener_danykh' THEN 1 ELSE 2 END, page, doc_id"),
            _first_seen_sql(
                "dou", "concat('https://jobs.dou.ua/companies/c-', number, '/vacancies/', number, '/')",
                "NULL AS query_name, NULL AS query_text, 'data_engineer' AS role_family", "SELECT * FROM d", "page, doc_id"),
            _first_seen_sql(
                "ithub", "concat('https://ithub.ua/jobs/data-engineer-', number)",
                "'data_engineer' AS query_name, 'data engineer' AS query_text, 'data_engineer' AS role_family",
                "SELECT * FROM d", "page, doc_id"),
        ]),
    )
)
def q_parse_cards(spark, sf_dir):
    """Result pages of every board through the plan: of postings that several pages or queries show the first stays."""
    parts = []
    for s in rules.SOURCES:
        pages = views.search_pages(spark, sf_dir, s)
        if s == "workua":
            again = pages.where("page % 4 = 0").withColumn("query_name", F.lit("data_engineer"))
            pages = pages.withColumn("query_name", F.expr(_FOUND_BY)).unionByName(again)
        cards = parse_cards(pages, s).withColumn("source", F.lit(s))
        parts.append(cards.select(*[
            F.col(c) if c in cards.columns else F.lit(None).cast("string").alias(c) for c in _CARD_COLUMNS]))
    return joins.union_sources(*parts)


# --- stored layers -----------------------------------------------------------------------------------------------

_LIST = "CAST((doc_id - doc_id % 1000) / 1000 AS BIGINT)"


@query(
    o.sql(
        [o.cards_cte("dou")],
        f"""SELECT source, job_url, title, company, dt, {_LIST} AS page,
  row_number() OVER (PARTITION BY {_LIST} ORDER BY doc_id) AS place FROM cards_dou""",
    )
)
def q_cards_json_list(spark, sf_dir):
    """Cards in files that hold one JSON list each; cards without a position get their place in the list."""
    columns = [c for c in CARD_SCHEMAS["dou"].fieldNames() if c != "position"]
    cards = views.source_cards(spark, sf_dir, "dou").withColumn("page", F.expr(_LIST))
    held = F.sort_array(F.collect_list(F.struct("doc_id", F.struct(*columns).alias("card"))))
    lists = cards.groupBy("page").agg(F.to_json(F.transform(held, lambda c: c["card"])).alias("value"))
    path = fresh_dir(spark, "cards")
    lists.select("value").write.option("maxRecordsPerFile", 1).text(path)
    place = F.row_number().over(Window.partitionBy("page").orderBy("position")).cast("long").alias("place")
    read = lake.read_cards(spark, path, "dou", "", path=path)
    return read.select("source", "job_url", "title", "company", "dt", "page", place)


@query(
    o.sql(
        [o.details_cte("workua"), o.details_cte("dou")],
        " UNION ALL ".join(
            f"SELECT source, job_id, job_url, title, company, location, dt FROM details_{s}" for s in ("workua", "dou")),
    )
)
def q_read_details(spark, sf_dir):
    """Details written by day and read back day by day; the day comes from the path."""
    root, parts = fresh_dir(spark, "bronze"), []
    for s in plans_details.DETAIL_SOURCES:
        lake.write_parsed_pages(views.source_details(spark, sf_dir, s).drop("doc_id"), root, s)
        parts += [lake.read_details(spark, root, s, f"2026-03-{day}") for day in (14, 15, 16)]
    columns = ["source", "job_id", "job_url", "title", "company", "location", "dt"]
    return joins.union_sources(*[p.select(*columns) for p in parts])


_POSTED = "CASE WHEN title IS NULL THEN NULL ELSE dt END"


@query(
    o.sql(
        o.silver_ctes(),
        f"""SELECT 'stored' AS kind, '2026-03-15' AS dt, dt AS posting_dt, source_job_uid, job_url, title FROM clean_dou
UNION ALL SELECT 'stored', '2026-03-16', {_POSTED}, source_job_uid, job_url, title FROM clean_workua
UNION ALL SELECT 'warehouse', '2026-03-16', NULL, source_job_uid, job_url, title FROM clean_workua""",
    )
)
def q_silver_day(spark, sf_dir):
    """A day's write and its rerun keep postings of older days and of none, and leave the day before as it was; the
    warehouse gets the same rows."""
    path = fresh_dir(spark, "silver-day")
    tables.write_silver_day(views.silver(spark, sf_dir, "dou"), path, "2026-03-15")
    for _ in range(2):
        day = views.silver(spark, sf_dir, "workua").withColumn("dt", F.expr(_POSTED))
        tables.write_silver_day(day, path, "2026-03-16")
    columns = [F.col("dt").cast("string").alias("dt"), "posting_dt", "source_job_uid", "job_url", "title"]
    stored = tables.read_days(spark, path).select(F.lit("stored").alias("kind"), *columns)
    fed = tables.scan_clean(spark, path, "2026-03-16").withColumn("posting_dt", F.lit(None).cast("string"))
    return stored.unionByName(fed.select(F.lit("warehouse").alias("kind"), *columns))


_PLACE = "CAST(2 - doc_id % 3 AS BIGINT)"
_NUMBERED = "concat(job_url, '&n=', CAST(doc_id AS VARCHAR(20)))"


@query(
    o.sql(
        [
            o.cards_cte("dou"),
            f"cards AS (SELECT {_NUMBERED} AS job_url, {_PLACE} AS place FROM cards_dou WHERE job_url IS NOT NULL)",
            f"""ids AS (SELECT {o.ID_SQL['dou']} AS job_id, job_url FROM cards
  QUALIFY row_number() OVER (PARTITION BY {o.ID_SQL['dou']} ORDER BY place DESC) = 1)""",
            "g AS (SELECT concat('companies_c-', page_id, '_vacancies_', page_id) AS job_id FROM pages)",
        ],
        "SELECT g.job_id, coalesce(ids.job_url, '') AS job_url FROM g LEFT JOIN ids ON g.job_id = ids.job_id",
    )
)
def q_details_last_card(spark, sf_dir):
    """Posting pages through the plan: of several cards with one id on one page the last on the page gives the URL."""
    number = F.col("page_id").cast("string")
    job_id = F.concat(F.lit("companies_c-"), number, F.lit("_vacancies_"), number)
    pages = table(spark, sf_dir, "pages").select(job_id.alias("job_id"), "html", F.lit("2026-03-16").alias("dt"))
    cards = views.source_cards(spark, sf_dir, "dou").select(
        F.expr(_NUMBERED).alias("job_url"), F.lit(1).cast("long").alias("page"), F.expr(_PLACE).alias("position"))
    return plans_details.parse_details_dou(pages, cards).select("job_id", "job_url")


__all__ = ["ORACLES", "QUERIES"]
