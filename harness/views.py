"""Postings derived from the driver's tables.

The tables hold no postings, so every document becomes one card and one detail of every source, and one rendered
card and page, by expressions that read the same in Spark SQL and in DuckDB. All rows and whole texts are used.

Three documents in a row share one posting URL, so keys repeat; URLs, ids, titles, companies and places are missing
or blank here and there; every fourth posting has no detail; a quarter of the postings share one company and title.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.rules import SOURCES
from hirelake.operators.joins import union_sources
from hirelake.plans import silver as plans_silver

_N = "(doc_id - doc_id % 3)"
_NS = f"CAST({_N} AS VARCHAR(20))"
_ID = "CAST(doc_id AS VARCHAR(20))"
_URLS = {
    "workua": f"concat('https://www.work.ua/jobs/', {_NS}, '/')",
    "dou": f"concat('https://jobs.dou.ua/companies/c-', {_NS}, '/vacancies/', {_NS}, '/?from=list')",
    "ithub": f"concat('https://ithub.ua/jobs/data-engineer-', {_NS})",
}
_IDS = {"workua": _NS, "dou": f"concat('companies_c-', {_NS}, '_vacancies_', {_NS})"}
_DAY = "concat('2026-03-', CAST(14 + doc_id % 3 AS VARCHAR(2)))"
_CLOCK = f"concat({_DAY}, 'T09:', lpad(CAST(doc_id % 60 AS VARCHAR(2)), 2, '0'), ':00+00:00')"
_LEVEL = """CASE doc_id % 7 WHEN 0 THEN 'Senior ' WHEN 1 THEN 'Lead ' WHEN 2 THEN 'Middle ' WHEN 3 THEN 'Junior '
  WHEN 4 THEN 'Старший ' WHEN 5 THEN 'Тімлід, ' ELSE '' END"""
_TECH = """CASE doc_id % 19 WHEN 0 THEN 'Python, SQL and Apache Spark. ' WHEN 1 THEN 'PostgreSQL; dbt (Airflow) / k8s. '
  WHEN 2 THEN 'GitHub Actions, Jenkins. ' WHEN 3 THEN 'Power BI, Tableau. ' WHEN 4 THEN 'NoSQL, MongoDB, CI/CD. '
  WHEN 5 THEN 'digital sparkle, gitops, javascript. ' WHEN 6 THEN 'AWS Glue + Amazon S3; Kafka_Streams. '
  WHEN 7 THEN 'Azure Databricks|Snowflake|BigQuery. ' WHEN 8 THEN 'T-SQL/MySQL, MS SQL, Oracle. '
  WHEN 9 THEN 'Git, Bash, Linux, Docker. ' WHEN 10 THEN 'Scala, Java, Hadoop, Apache Flink. '
  WHEN 11 THEN 'Looker та Superset, ClickHouse. ' WHEN 12 THEN 'ETL/ELT, Terraform, Redshift, GCP. ' ELSE '' END"""
_PLACE = """CASE doc_id % 5 WHEN 0 THEN 'Remote, Europe' WHEN 1 THEN 'Гібридний формат' WHEN 2 THEN 'Робота в офісі'
  WHEN 3 THEN 'Kyiv' END"""
_YEARS = """CASE doc_id % 8 WHEN 0 THEN '5+ years' WHEN 1 THEN 'Досвід роботи від 3 років' WHEN 2 THEN '1 year'
  WHEN 3 THEN 'від 7 рок.' WHEN 4 THEN '2 роки' WHEN 5 THEN '4 роки' END"""

_CARD = {
    "query_name": "CASE WHEN doc_id % 2 = 0 THEN 'data_engineer' ELSE 'inzhener_danykh' END",
    "query_text": "CASE WHEN doc_id % 2 = 0 THEN 'data engineer' ELSE 'інженер даних' END",
    "role_family": "'data_engineer'",
    "title": f"""CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 12 BETWEEN 3 AND 5 THEN 'Data Engineer'
  ELSE concat({_LEVEL}, CASE WHEN doc_id % 10 = 9 THEN 'Analyst' ELSE 'Data Engineer' END,
              ' #', CAST(doc_id % 10 AS VARCHAR(20))) END""",
    "company": """CASE WHEN doc_id % 11 = 0 THEN '   ' WHEN doc_id % 13 = 0 THEN NULL
  WHEN doc_id % 12 BETWEEN 3 AND 5 THEN 'Big-Company, Ltd.'
  ELSE concat('Company-', CAST(doc_id % 20 AS VARCHAR(20))) END""",
    "location": _PLACE,
    "snippet": "CASE doc_id % 4 WHEN 0 THEN 'hybrid work model' WHEN 1 THEN 'слід знати' WHEN 2 THEN '' END",
    "published_text": "CASE WHEN doc_id % 6 = 0 THEN ' ' WHEN doc_id % 6 = 1 THEN NULL ELSE '21 March 2026' END",
    "fetched_at": f"CASE WHEN doc_id % 17 = 0 THEN NULL ELSE {_CLOCK} END",
    "dt": _DAY,
    "page": "CAST(1 + doc_id % 5 AS BIGINT)",
    "meta_text": "CASE doc_id % 4 WHEN 0 THEN 'Kyiv • Remote' WHEN 1 THEN 'слід знати' WHEN 2 THEN '' END",
    "description_full": f"concat({_TECH}, text)",
    "skills_list": "CASE WHEN doc_id % 3 = 0 THEN 'Python,SQL' WHEN doc_id % 3 = 1 THEN 'Tableau' END",
}

_DETAIL = {
    "title": "concat('Data Engineer #', CAST(doc_id % 10 AS VARCHAR(20)))",
    "company": "concat('Detail-Co-', CAST(doc_id % 20 AS VARCHAR(20)))",
    "location": "CASE WHEN doc_id % 2 = 0 THEN 'Дистанційна робота' ELSE ' ' END",
    "published_text": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE '20 March 2026' END",
    "employment_type": "CASE WHEN doc_id % 2 = 0 THEN 'Повна зайнятість' END",
    "experience_text": _YEARS,
    "education_text": "CASE WHEN doc_id % 3 = 0 THEN 'Вища освіта' END",
    "description_full": f"concat({_TECH}, text)",
    "page_text": "concat('Posting ', text)",
    "dt": _DAY,
}


def cards_sql(source: str) -> dict[str, str]:
    """Card columns of one source as SQL expressions over documents."""
    url = f"CASE WHEN doc_id % 37 <> 0 THEN {_URLS[source]} END"
    return {"source": f"'{source}'", "job_url": url, **_CARD}


def details_sql(source: str) -> dict[str, str]:
    return {
        "source": f"'{source}'",
        "job_id": f"CASE WHEN {_N} % 12 <> 0 THEN {_IDS[source]} END",
        "job_url": f"CASE WHEN {_N} % 12 = 0 THEN '' ELSE {_URLS[source]} END",
        **_DETAIL,
    }


_ESCAPED_TEXT = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

# one rendered search card per document, 20 to a page
RENDERED = {
    "doc_id": "doc_id",
    "page": "CAST((doc_id - doc_id % 20) / 20 AS BIGINT)",
    "number": _NS,
    "has_link": "CASE WHEN doc_id % 29 <> 0 THEN 1 ELSE 0 END",
    "title": f"concat({_LEVEL}, 'Data & Engineer <', {_ID}, '>')",
    "company": "CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat('Company-', CAST(doc_id % 20 AS VARCHAR(20))) END",
    "location": "CASE doc_id % 3 WHEN 0 THEN 'Київ, Remote' WHEN 1 THEN 'Kyiv' ELSE '' END",
    "snippet": "text",
    "published": "concat(CAST(1 + doc_id % 28 AS VARCHAR(2)), ' March 2026')",
    "tags": "CASE doc_id % 3 WHEN 0 THEN 'Python|SQL' WHEN 1 THEN 'Airflow' ELSE '' END",
}
_TITLE_HTML = f"concat({_LEVEL}, 'Data &amp; Engineer &lt;', {_ID}, '&gt;')"
_COMPANY, _LOCATION, _PUBLISHED = RENDERED["company"], RENDERED["location"], RENDERED["published"]
CARD_HTML = {
    "workua": f"""concat('<div class="card card-hover job-link"><h2>',
  CASE WHEN doc_id % 29 <> 0 THEN concat('<a title="x" href="/jobs/', {_NS}, '/">') ELSE '<a href="/companies/1/">' END,
  {_TITLE_HTML}, '</a></h2><div class="mt-xs"><span class="strong-600">', {_COMPANY}, '</span>, ', {_LOCATION},
  '</div><p class="ellipsis">', {_ESCAPED_TEXT}, '</p><time>', {_PUBLISHED}, '</time></div>')""",
    "dou": f"""concat('<li class="l-vacancy __hot"><div class="date">', {_PUBLISHED}, '</div><div class="title">',
  CASE WHEN doc_id % 29 <> 0 THEN concat('<a class="vt" href="/companies/c-', {_NS}, '/vacancies/', {_NS}, '/">')
       ELSE '<a class="other">' END,
  {_TITLE_HTML}, '</a> <strong>at <a class="company" href="#">', {_COMPANY}, '</a></strong> <span class="cities">',
  {_LOCATION}, '</span></div><div class="sh-info">', {_ESCAPED_TEXT}, '</div></li>')""",
    "ithub": f"""concat('<div class="cardbox"><h2>',
  CASE WHEN doc_id % 29 <> 0 THEN concat('<a href="https://ithub.ua/jobs/data-engineer-', {_NS}, '">') ELSE '<a>' END,
  ' ', {_TITLE_HTML}, ' </a></h2><div class="base"><a>', {_COMPANY}, '</a></div><div class="jobscompanytype">Product',
  '</div><div class="eventinfo jobsinfo">', {_LOCATION}, '</div><div class="jobdate">', {_PUBLISHED},
  '</div><div class="cardboxdopinfo">', {_ESCAPED_TEXT}, '</div><ul class="eventmaintag">',
  CASE doc_id % 3 WHEN 0 THEN '<li>Python</li><li> </li><li>SQL</li>' WHEN 1 THEN '<li><b>Airflow</b></li>' ELSE '' END,
  '</ul></div>')""",
}
PAGE_FRAME = {
    "workua": ("<html><body><script>var x = '<div class=card>';</script>", "</body></html>"),
    "dou": ("<ul>", "</ul>"),
    "ithub": ('<div class="view-content">', "</div>"),
}

# one rendered posting page per document
DETAIL_HTML = {
    "workua": f"""concat('<html><head><style>p {{ margin: 0 }}</style></head><body><h1>', {_TITLE_HTML}, '</h1>',
  CASE WHEN doc_id % 2 = 0 THEN '<a href="/jobs/by-company/company/7/">Co &amp; Sons</a>'
       ELSE '<div class="text-default-7"><b></b><strong>Fallback Co</strong></div>' END,
  '<div id="job-description"><p>', {_ESCAPED_TEXT}, '</p></div><div>',
  CASE doc_id % 3 WHEN 0 THEN 'Дистанційна робота ' WHEN 1 THEN 'м. Львів ' ELSE '' END,
  CASE doc_id % 4 WHEN 0 THEN 'Досвід роботи від 2 років ' WHEN 1 THEN 'досвід роботи від  10 рокив ' ELSE '' END,
  CASE doc_id % 5 WHEN 0 THEN 'Вища освіта ' ELSE '' END,
  CASE doc_id % 2 WHEN 0 THEN 'Неповна зайнятість ' ELSE '' END,
  'Вакансія від ', {_PUBLISHED}, '</div></body></html>')""",
    "dou": f"""concat('<html><body><h1 class="g-h2">', {_TITLE_HTML}, '</h1>',
  CASE WHEN doc_id % 2 = 0 THEN '<div class="b-compinfo"><div class="l-n"><a>Co &amp; Sons</a> Всі вакансії компанії 5</div></div>'
       ELSE '<a href="/companies/7/">Link Co Всі вакансії компанії</a>' END,
  CASE WHEN doc_id % 3 = 0 THEN '<div class="sh-info">Kyiv</div>' WHEN doc_id % 3 = 1 THEN '<p>Львів</p>' ELSE '' END,
  CASE WHEN doc_id % 4 = 0 THEN concat('<div class="date">', {_PUBLISHED}, '</div>')
       ELSE concat('<p>', {_PUBLISHED}, '</p>') END,
  '<div class="b-typo vacancy-section"><p>', {_ESCAPED_TEXT}, '</p></div></body></html>')""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def cards_of(docs: DataFrame, source: str) -> DataFrame:
    rows = select(docs, {"doc_id": "doc_id", **cards_sql(source)})
    skills = F.expr("IF(skills_list IS NOT NULL, split(skills_list, ','), NULL)")
    return rows.withColumn("skills_raw", skills).drop("skills_list")


def details_of(docs: DataFrame, source: str) -> DataFrame:
    return select(docs, {"doc_id": "doc_id", **details_sql(source)})


def source_cards(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Cards of one source, one per document, with every column that some source has."""
    return cards_of(documents(spark, sf_dir), source)


def source_details(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return details_of(documents(spark, sf_dir), source)


Inputs = dict[str, tuple[DataFrame, DataFrame | None]]


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Cards and details of every source."""
    docs = documents(spark, sf_dir)
    return {s: (cards_of(docs, s), None if s == "ithub" else details_of(docs, s)) for s in SOURCES}


def silver(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return plans_silver.silver(*inputs(spark, sf_dir)[source], source)


def searchable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of all sources merged with details, before tagging, and the text that is searched."""
    found = inputs(spark, sf_dir)
    return union_sources(*[plans_silver.searchable_postings(*found[s], s) for s in SOURCES])


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean postings of all sources."""
    return plans_silver.silver_all(inputs(spark, sf_dir))


def search_pages(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Result pages of at most 20 cards each, rendered from the documents."""
    rendered = select(documents(spark, sf_dir), {"doc_id": "doc_id", "page": RENDERED["page"], "card": CARD_HTML[source]})
    head, tail = PAGE_FRAME[source]
    parts = F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "card"))), lambda c: c["card"])
    pages = rendered.groupBy("page").agg(F.concat(F.lit(head), F.array_join(parts, ""), F.lit(tail)).alias("html"))
    constants = {"query_name": "q", "query_text": "q q", "role_family": "r", "fetched_at": "f", "dt": "2026-03-14"}
    return pages.select("*", *[F.lit(v).alias(k) for k, v in constants.items()])


def detail_pages(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Posting pages, one per document: (path, html, dt)."""
    columns = {
        "path": f"concat('details_raw/job_', {_ID}, '.html')",
        "html": DETAIL_HTML[source],
        "dt": _DAY,
    }
    return select(documents(spark, sf_dir), columns)
