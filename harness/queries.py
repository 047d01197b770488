"""One query per operator, each with the DuckDB SQL that must give the same rows.

``QUERIES`` maps a name to a function (spark, sf_dir) → DataFrame, ``ORACLES`` to SQL over the same tables. Every query
runs over whole tables. Results use text, integers and doubles only, so that both engines hash them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import oracles as o
from harness import views
from harness.views import table
from hirelake.functions import rules, urls
from hirelake.functions.classify import skills_csv, sort_skill_list, tag_skills, with_classification
from hirelake.functions.text import collapse_space, html_to_text, normalize_name
from hirelake.operators import dedup, extract, incremental, joins, marts, project, quality
from hirelake.plans import details as plans_details
from hirelake.plans import gold
from hirelake.plans import silver as plans_silver
from hirelake.schemas import CARD_SCHEMAS, CLEAN_COLUMNS
from hirelake.session import fresh_dir, written_once
from hirelake.sources import lake, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

Query = Callable[[SparkSession, str], DataFrame]


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return register


def _all_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of every source, with the id that its source's rule gives."""
    docs = views.documents(spark, sf_dir)
    ids = {"workua": urls.job_id_workua, "dou": urls.job_id_dou, "ithub": urls.job_id_ithub}
    parts = [views.cards_of(docs, s).withColumn("job_id", ids[s](F.col("job_url"))) for s in rules.SOURCES]
    return joins.union_sources(*parts)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_classification(views.searchable(spark, sf_dir))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every card as a posting version: several days per uid."""
    cards = _all_cards(spark, sf_dir)
    uid = F.concat_ws("::", "source", F.coalesce("job_id", "job_url"))
    return cards.select(uid.alias("source_job_uid"), "job_url", "title", "source", "dt", "fetched_at")


_VERSIONS = [
    *o.all_cards_ctes(),
    """v AS (SELECT concat_ws('::', source, coalesce(job_id, job_url)) AS source_job_uid, job_url, title, source, dt,
  fetched_at FROM c)""",
]
_LATEST_V = """QUALIFY row_number() OVER (PARTITION BY source_job_uid
  ORDER BY fetched_at DESC NULLS LAST, dt DESC NULLS LAST, job_url DESC NULLS LAST) = 1"""


# --- projections and filters -------------------------------------------------------------------------------------

_PROJECTED = (
    "source, job_id, job_url, title, company, location, snippet, published_text, query_name, query_text, role_family, "
    "dt, fetched_at"
)


@query(
    o.sql(
        o.all_cards_ctes(),
        """SELECT source, CASE WHEN source <> 'dou' THEN job_id END AS job_id, job_url, title, company,
  CASE WHEN source <> 'ithub' THEN location END AS location,
  CASE WHEN source = 'ithub' THEN meta_text ELSE snippet END AS snippet, published_text,
  CASE WHEN source <> 'dou' THEN query_name END AS query_name,
  CASE WHEN source <> 'dou' THEN query_text END AS query_text, role_family, dt, fetched_at FROM c""",
    )
)
def q_project_clean(spark, sf_dir):
    parts = [project.project_cards(views.source_cards(spark, sf_dir, s), s) for s in rules.SOURCES]
    columns = [c.strip() for c in _PROJECTED.split(",")]
    full = [p if "job_id" in p.columns else p.withColumn("job_id", project.null_text()) for p in parts]
    return joins.union_sources(*[project.final_projection(p, columns) for p in full])


@query(
    o.sql(
        [o.details_cte("workua"), o.details_cte("dou")],
        """SELECT 'workua' AS board, job_id, job_url, title AS detail_title, company AS detail_company,
  location AS detail_location, published_text AS detail_published_text, md5(description_full) AS description_md5,
  employment_type, experience_text, education_text FROM details_workua
UNION ALL SELECT 'dou', job_id, nullif(job_url, ''), title, company, location, published_text, md5(description_full),
  NULL, NULL, NULL FROM details_dou""",
    )
)
def q_project_details(spark, sf_dir):
    parts = []
    for s in ("workua", "dou"):
        rows = project.project_details(views.source_details(spark, sf_dir, s), s)
        rows = rows.withColumn("board", F.lit(s)).withColumn("description_md5", F.md5("description_full"))
        for c in ("employment_type", "experience_text", "education_text"):
            if c not in rows.columns:
                rows = rows.withColumn(c, project.null_text())
        parts.append(rows.drop("description_full", "page_text"))
    return joins.union_sources(*parts)


@query(o.sql(o.all_cards_ctes(), """SELECT source, doc_id, title FROM c WHERE lower(title) LIKE '%data engineer%'"""))
def q_filter_title_keyword(spark, sf_dir):
    return project.filter_title_keyword(_all_cards(spark, sf_dir)).select("source", "doc_id", "title")


@query(
    o.sql(
        [*o.all_cards_ctes(), o.details_cte("workua"), o.details_cte("dou")],
        """SELECT 'card' AS kind, source, doc_id FROM c WHERE (CASE WHEN source = 'workua' THEN job_id ELSE job_url END) IS NOT NULL
UNION ALL SELECT 'detail', source, doc_id FROM details_workua WHERE job_id IS NOT NULL
UNION ALL SELECT 'detail', source, doc_id FROM details_dou WHERE job_url <> ''""",
    )
)
def q_filter_key_not_null(spark, sf_dir):
    parts = []
    for s in rules.SOURCES:
        key = plans_silver.JOIN_KEYS.get(s, "job_url")
        cards = _all_cards(spark, sf_dir).where(F.col("source") == s)
        parts.append(project.filter_key_not_null(cards, key).select(F.lit("card").alias("kind"), "source", "doc_id"))
        if s in plans_silver.JOIN_KEYS:
            details = views.source_details(spark, sf_dir, s).withColumn("job_url", F.nullif(F.col("job_url"), F.lit("")))
            kept = project.filter_key_not_null(details, key)
            parts.append(kept.select(F.lit("detail").alias("kind"), "source", "doc_id"))
    return joins.union_sources(*parts)


@query(o.sql(o.untagged_ctes(), "SELECT source, source_job_uid, job_id, title, company, location, published_text FROM j"))
def q_coalesce_nonblank(spark, sf_dir):
    columns = ["source", "source_job_uid", "job_id", "title", "company", "location", "published_text"]
    return views.searchable(spark, sf_dir).select(*columns)


@query(
    o.sql(
        o.untagged_ctes(),
        "SELECT source_job_uid, length(text_blob) AS blob_chars, md5(text_blob) AS blob_md5 FROM j",
    )
)
def q_text_blob(spark, sf_dir):
    blob = F.col("text_blob")
    rows = views.searchable(spark, sf_dir)
    return rows.select("source_job_uid", F.length(blob).cast("long").alias("blob_chars"), F.md5(blob).alias("blob_md5"))


@query(
    "SELECT page_id, "
    + ", ".join(f"{o.ID_SQL[s].replace('job_url', 'url')} AS id_{s}" for s in rules.SOURCES)
    + ", regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) AS url_path FROM pages"
)
def q_job_id_url(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.job_id_workua(url).alias("id_workua"),
        urls.job_id_dou(url).alias("id_dou"),
        urls.job_id_ithub(url).alias("id_ithub"),
        F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")).alias("url_path"),
    )


@query(o.sql(o.untagged_ctes(), "SELECT source, source_job_uid, job_id, job_url FROM j"))
def q_make_uid(spark, sf_dir):
    return views.searchable(spark, sf_dir).select("source", "source_job_uid", "job_id", "job_url")


@query(f"SELECT doc_id, md5({o.clean_space('text')}) AS clean_md5, length({o.clean_space('text')}) AS clean_chars FROM documents")
def q_clean_text(spark, sf_dir):
    rows = views.documents(spark, sf_dir).select("doc_id", collapse_space(F.col("text")).alias("t"))
    return rows.select("doc_id", F.md5("t").alias("clean_md5"), F.length("t").cast("long").alias("clean_chars"))


@query(
    o.sql(
        o.all_cards_ctes(),
        f"""SELECT source, doc_id, {o.NAME.format('title')} AS norm_title, {o.NAME.format('company')} AS norm_company
FROM c""",
    )
)
def q_normalize_name(spark, sf_dir):
    return _all_cards(spark, sf_dir).select(
        "source", "doc_id",
        normalize_name(F.col("title")).alias("norm_title"),
        normalize_name(F.col("company")).alias("norm_company"),
    )


# --- joins -------------------------------------------------------------------------------------------------------


@query(
    o.sql(
        [c for s in ("workua", "dou") for c in (o.cards_cte(s), o.details_cte(s), o.unique_cards_cte(s), o.unique_details_cte(s))],
        " UNION ALL ".join(
            f"""SELECT c.source, c.job_url, c.title, c.fetched_at, d.title AS detail_title, d.company AS detail_company
FROM unique_cards_{s} c LEFT JOIN unique_details_{s} d ON c.{k} = d.{k}"""
            for s, k in (("workua", "job_id"), ("dou", "job_url"))
        ),
    )
)
def q_join_details_left(spark, sf_dir):
    parts = []
    for s, key in plans_silver.JOIN_KEYS.items():
        cards = plans_silver.unique_cards(views.source_cards(spark, sf_dir, s), s)
        side = plans_silver.unique_details(views.source_details(spark, sf_dir, s), s)
        side = side.select(key, "detail_title", "detail_company")
        rows = joins.join_details_left(cards, side, key)
        parts.append(rows.select("source", "job_url", "title", "fetched_at", "detail_title", "detail_company"))
    return joins.union_sources(*parts)


@query(
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN (
  SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1)
ON c_custkey = o_custkey"""
)
def q_join_orders_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate", "o_totalprice")
    newest = ["o_orderdate DESC NULLS LAST", "o_orderkey DESC NULLS LAST"]
    latest = dedup.first_rank(orders, ["c_custkey"], newest).drop("o_orderdate")
    return joins.join_details_left(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), latest, "c_custkey")


@query(
    o.sql(
        [
            o.cards_cte("dou"),
            f"""ids AS (SELECT {o.ID_SQL['dou']} AS job_id, job_url FROM cards_dou WHERE coalesce(job_url, '') <> ''
  QUALIFY row_number() OVER (PARTITION BY 1 ORDER BY page DESC NULLS LAST, doc_id DESC NULLS LAST) = 1)""".replace(
                "PARTITION BY 1", f"PARTITION BY {o.ID_SQL['dou']}"
            ),
            "g AS (SELECT page_id, concat('companies_c-', page_id, '_vacancies_', page_id) AS job_id, url FROM pages)",
        ],
        "SELECT g.page_id, g.job_id, g.url, coalesce(ids.job_url, '') AS job_url FROM g LEFT JOIN ids ON g.job_id = ids.job_id",
    )
)
def q_lookup_url(spark, sf_dir):
    number = F.col("page_id").cast("string")
    job_id = F.concat(F.lit("companies_c-"), number, F.lit("_vacancies_"), number)
    pages = table(spark, sf_dir, "pages").select("page_id", job_id.alias("job_id"), "url")
    cards = views.source_cards(spark, sf_dir, "dou").select("job_url", "page", "doc_id")
    last = ["page DESC NULLS LAST", "doc_id DESC NULLS LAST"]
    return joins.lookup_url_by_job_id(pages, cards, urls.job_id_dou(F.col("job_url")), last)


# --- classification ----------------------------------------------------------------------------------------------

_LOW = """low AS (SELECT *, lower(text_blob) AS low, lower(coalesce(location, '')) AS loc, lower(coalesce(title, '')) AS tit,
  lower(coalesce(experience_text, '')) || ' ' || substr(lower(text_blob), 1, 800) AS years FROM j)"""


@query(o.sql([*o.untagged_ctes(), _LOW], f"SELECT source_job_uid, {o.tags_sql('low')} AS skills FROM low"))
def q_tag_skills(spark, sf_dir):
    return _classified(spark, sf_dir).select("source_job_uid", skills_csv(F.col("skills_array")).alias("skills"))


_PART_TAGS = {
    "metal": (r"\btin\b", r"\bnickel\b", r"\bbrass\b", r"\bsteel\b", r"\bcopper\b"),
    "finish": (r"polished", r"plated", r"burnished", r"anodized", r"brushed"),
    "short": (r"\bpart\b", r"1"),
}


@query(f"SELECT p_partkey, {o.tags_sql('''lower(concat_ws(' ', p_name, p_type, p_brand))''', _PART_TAGS)} AS tags FROM part")
def q_tag_parts(spark, sf_dir):
    tags = sort_skill_list(tag_skills("concat_ws(' ', p_name, p_type, p_brand)", _PART_TAGS))
    return table(spark, sf_dir, "part").select("p_partkey", skills_csv(tags).alias("tags"))


@query(
    o.sql(
        [*o.untagged_ctes(), _LOW],
        f"SELECT source_job_uid, {o.remote_sql('loc', 'substr(low, 1, 1500)')} AS remote_type FROM low",
    )
)
def q_classify_remote(spark, sf_dir):
    return _classified(spark, sf_dir).select("source_job_uid", "remote_type")


@query(
    o.sql(
        [*o.untagged_ctes(), _LOW],
        f"SELECT source_job_uid, {o.seniority_sql('tit', 'substr(low, 1, 1500)', 'years')} AS seniority FROM low",
    )
)
def q_classify_seniority(spark, sf_dir):
    return _classified(spark, sf_dir).select("source_job_uid", "seniority")


@query(o.sql(o.silver_ctes(), f"SELECT {', '.join(CLEAN_COLUMNS)} FROM p"))
def q_silver(spark, sf_dir):
    return views.postings(spark, sf_dir)


# --- deduplication and increments --------------------------------------------------------------------------------


@query(o.sql(_VERSIONS, f"SELECT * FROM v {_LATEST_V}"))
def q_latest_per_uid(spark, sf_dir):
    return dedup.latest_per_uid(_versions(spark, sf_dir))


@query(
    """SELECT user_id, event_id, event_type, CAST(ts AS VARCHAR) AS ts FROM events QUALIFY row_number() OVER (
  PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1"""
)
def q_latest_event_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    newest = ["ts DESC NULLS LAST", "event_id DESC NULLS LAST"]
    latest = dedup.first_rank(events, ["user_id"], newest)
    return latest.select("user_id", "event_id", "event_type", F.col("ts").cast("string").alias("ts"))


@query(
    o.sql(
        o.all_cards_ctes(),
        """SELECT source, job_url, query_name, page, doc_id FROM c QUALIFY row_number() OVER (PARTITION BY job_url
  ORDER BY query_name ASC NULLS LAST, page ASC NULLS LAST, doc_id ASC NULLS LAST, source ASC NULLS LAST) = 1""",
    )
)
def q_dedup_first_seen(spark, sf_dir):
    cards = _all_cards(spark, sf_dir).select("source", "job_url", "query_name", "page", "doc_id")
    return dedup.dedup_first_seen(cards, "job_url", ["query_name", "page", "doc_id", "source"])


@query(
    o.sql(
        [c for s in rules.SOURCES for c in (o.cards_cte(s), o.unique_cards_cte(s))],
        " UNION ALL ".join(
            f"SELECT source, job_url, title, fetched_at, dt FROM unique_cards_{s}" for s in rules.SOURCES
        ),
    )
)
def q_dedup_any_by_key(spark, sf_dir):
    parts = [plans_silver.unique_cards(views.source_cards(spark, sf_dir, s), s) for s in rules.SOURCES]
    return joins.union_sources(*[p.select("source", "job_url", "title", "fetched_at", "dt") for p in parts])


@query(
    o.sql(
        _VERSIONS,
        "SELECT * FROM v WHERE dt > (SELECT max(dt) FROM v WHERE dt < '2026-03-16')",
    )
)
def q_incremental_filter(spark, sf_dir):
    versions = _versions(spark, sf_dir)
    return incremental.incremental_filter(versions, versions.where(F.col("dt") < "2026-03-16"))


@query(
    o.sql(
        [*_VERSIONS, f"old AS (SELECT * FROM v WHERE dt < '2026-03-16' {_LATEST_V})",
         f"new AS (SELECT * FROM v WHERE dt >= '2026-03-16' {_LATEST_V})"],
        "SELECT * FROM old WHERE source_job_uid NOT IN (SELECT source_job_uid FROM new) UNION ALL SELECT * FROM new",
    )
)
def q_upsert_by_key(spark, sf_dir):
    versions = _versions(spark, sf_dir)
    old = dedup.latest_per_uid(versions.where(F.col("dt") < "2026-03-16"))
    new = dedup.latest_per_uid(versions.where(F.col("dt") >= "2026-03-16"))
    return incremental.upsert_by_key(old, new, "source_job_uid")


_BATCHES = {"early": "< '2026-03-15'", "mid": "= '2026-03-15'", "late": ">= '2026-03-16'"}


@query(
    o.sql(
        [*_VERSIONS, *[f"{name} AS (SELECT * FROM v WHERE dt {days} {_LATEST_V})" for name, days in _BATCHES.items()]],
        """SELECT * FROM late UNION ALL SELECT * FROM mid WHERE source_job_uid NOT IN (SELECT source_job_uid FROM late)
UNION ALL SELECT * FROM early WHERE source_job_uid NOT IN
  (SELECT source_job_uid FROM mid UNION ALL SELECT source_job_uid FROM late)""",
    )
)
def q_upsert_table(spark, sf_dir):
    """The same replacement in a stored table: three batches, each of which only adds files."""
    versions = _versions(spark, sf_dir)
    path = fresh_dir(spark, "upserted")
    for days in _BATCHES.values():
        tables.upsert_table(spark, path, dedup.latest_per_uid(versions.where(f"dt {days}")), "source_job_uid")
    return tables.read_upserted(spark, path)


@query(o.sql(o.untagged_ctes(), "SELECT source, source_job_uid, title FROM j"))
def q_union_sources(spark, sf_dir):
    return views.searchable(spark, sf_dir).select("source", "source_job_uid", "title")


# --- gold --------------------------------------------------------------------------------------------------------


@query(o.sql(o.silver_ctes(), f"SELECT source_job_uid, {o.KEY} AS cross_source_job_key FROM p"))
def q_cross_source_key(spark, sf_dir):
    key = dedup.cross_source_key(F.col("company"), F.col("title"), F.col("seniority"))
    return views.postings(spark, sf_dir).select("source_job_uid", key.alias("cross_source_job_key"))


_BEST = [
    "cross_source_job_key", "source_job_uid", "source", "title", "company", "remote_type", "seniority", "skills", "dt",
    "fetched_at",
]


@query(o.sql(o.best_ctes(), f"SELECT {', '.join(_BEST)}, md5(description_full) AS description_md5 FROM best"))
def q_best_per_key(spark, sf_dir):
    best = gold.deduped(views.postings(spark, sf_dir))
    return best.select(*_BEST, F.md5("description_full").alias("description_md5"))


@query(o.sql(o.best_ctes(), o.SKILL_COUNTS + " ORDER BY job_count DESC, skill ASC"))
def q_skill_demand(spark, sf_dir):
    best = gold.deduped(views.postings(spark, sf_dir))
    return marts.order_by_count_then_key(marts.skill_demand(best), "skill")


@query(o.sql(o.best_ctes(), o.SKILL_COUNTS + " ORDER BY job_count DESC, skill ASC LIMIT 10"))
def q_top_skills(spark, sf_dir):
    return marts.top_skills(gold.deduped(views.postings(spark, sf_dir)), 10)


def _share(df: DataFrame, column: str) -> DataFrame:
    share = marts.order_by_count_then_key(marts.category_share(df, column), column)
    return share.withColumn("share_pct", F.col("share_pct").cast("double"))


@query(o.share_sql(o.best_ctes(), "best", "seniority"))
def q_seniority_share(spark, sf_dir):
    return _share(gold.deduped(views.postings(spark, sf_dir)), "seniority")


@query(o.share_sql(o.best_ctes(), "best", "remote_type"))
def q_remote_share(spark, sf_dir):
    return _share(gold.deduped(views.postings(spark, sf_dir)), "remote_type")


@query(o.share_sql([], "orders", "o_orderpriority"))
def q_priority_share(spark, sf_dir):
    return _share(table(spark, sf_dir, "orders"), "o_orderpriority")


@query(o.sql(o.best_ctes(), "SELECT source, count(*) AS job_count FROM best GROUP BY source"))
def q_source_coverage(spark, sf_dir):
    return marts.source_coverage(gold.deduped(views.postings(spark, sf_dir)))


# --- data quality ------------------------------------------------------------------------------------------------


@query(
    o.sql(
        _VERSIONS,
        " UNION ALL ".join(
            f"""SELECT 'not_null' AS check_name, '{c}' AS column_name, 'error' AS severity,
  count(*) FILTER (WHERE {c} IS NULL) AS failed, count(*) FILTER (WHERE {c} IS NULL) = 0 AS ok FROM v"""
            for c in ("source_job_uid", "job_url", "title", "fetched_at")
        ),
    )
)
def q_expect_not_null(spark, sf_dir):
    checks = [quality.expect_not_null(c) for c in ("source_job_uid", "job_url", "title", "fetched_at")]
    return quality.run_expectations(_versions(spark, sf_dir), checks)


@query(
    o.sql(
        _VERSIONS,
        " UNION ALL ".join(
            f"""SELECT 'unique' AS check_name, '{c}' AS column_name, 'error' AS severity, count(*) AS failed, count(*) = 0 AS ok
FROM (SELECT {c} FROM v WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"""
            for c in ("source_job_uid", "title")
        )
        + """ UNION ALL SELECT 'unique', 'l_orderkey', 'error', count(*), count(*) = 0
FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'o_orderkey', 'error', count(*), count(*) = 0
FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)""",
    )
)
def q_expect_unique(spark, sf_dir):
    versions = [quality.expect_unique("source_job_uid"), quality.expect_unique("title")]
    return joins.union_sources(
        quality.run_expectations(_versions(spark, sf_dir), versions),
        quality.run_expectations(table(spark, sf_dir, "lineitem"), [quality.expect_unique("l_orderkey")]),
        quality.run_expectations(table(spark, sf_dir, "orders"), [quality.expect_unique("o_orderkey")]),
    )


@query(
    o.sql(
        _VERSIONS,
        """SELECT 'accepted_values' AS check_name, 'source' AS column_name, 'error' AS severity,
  count(*) FILTER (WHERE source NOT IN ('workua', 'dou')) AS failed,
  count(*) FILTER (WHERE source NOT IN ('workua', 'dou')) = 0 AS ok FROM v
UNION ALL SELECT 'accepted_values', 'title', 'warn',
  count(*) FILTER (WHERE title NOT IN ('Data Engineer')), count(*) FILTER (WHERE title NOT IN ('Data Engineer')) = 0 FROM v
UNION ALL SELECT 'accepted_values', 'o_orderstatus', 'error',
  count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F', 'P')), count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F', 'P')) = 0
FROM orders""",
    )
)
def q_expect_accepted(spark, sf_dir):
    checks = [
        quality.expect_accepted_values("source", ["workua", "dou"]),
        quality.expect_accepted_values("title", ["Data Engineer"], severity="warn"),
    ]
    return joins.union_sources(
        quality.run_expectations(_versions(spark, sf_dir), checks),
        quality.run_expectations(
            table(spark, sf_dir, "orders"), [quality.expect_accepted_values("o_orderstatus", ["O", "F", "P"])]
        ),
    )


@query(
    o.sql(
        [*o.all_cards_ctes(), o.details_cte("dou")],
        """SELECT 'relationship' AS check_name, 'l_orderkey' AS column_name, 'warn' AS severity, count(*) AS failed, count(*) = 0 AS ok
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'relationship', 'job_url', 'warn', count(*), count(*) = 0
FROM c WHERE job_url IS NOT NULL AND job_url NOT IN (SELECT job_url FROM details_dou)""",
    )
)
def q_orphan_check(spark, sf_dir):
    return joins.union_sources(
        quality.expect_relationship(table(spark, sf_dir, "lineitem"), "l_orderkey", table(spark, sf_dir, "orders"), "o_orderkey"),
        quality.expect_relationship(
            _all_cards(spark, sf_dir), "job_url", views.source_details(spark, sf_dir, "dou"), "job_url"
        ),
    )


_RATIO_SQL = {
    "unknown_remote_ratio": "remote_type = 'unknown'",
    "unknown_seniority_ratio": "seniority = 'unknown'",
    "empty_skills_ratio": "skills IS NULL OR trim(skills) = ''",
}
_RATIOS_CTE = "r AS (SELECT count(*) AS total_rows, " + ", ".join(
    f"round(count(*) FILTER (WHERE {c}) / count(*), 9) AS {n}" for n, c in _RATIO_SQL.items()
) + " FROM p)"


@query(
    o.sql(
        [*o.silver_ctes(), _RATIOS_CTE],
        " UNION ALL ".join(
            f"SELECT '{n}' AS check_name, {n} AS ratio, CAST(0.5 AS DOUBLE) AS max_ratio, {n} <= 0.5 AS ok, total_rows FROM r"
            for n in _RATIO_SQL
        ),
    )
)
def q_ratio_checks(spark, sf_dir):
    postings = views.postings(spark, sf_dir)
    quality.check_non_empty({"postings": postings})
    report = quality.check_ratio_max(postings, 0.5)
    return report.select(
        "check_name", F.round(F.col("ratio").cast("double"), 9).alias("ratio"),
        F.col("max_ratio").cast("double").alias("max_ratio"), "ok", "total_rows",
    )


_METRIC = "'2026-03-16' AS run_date, 'daily_postings' AS dag_id"


@query(
    o.sql(
        [*o.silver_ctes(), _RATIOS_CTE],
        " UNION ALL ".join(
            [
                f"""SELECT {_METRIC}, '{s}' AS source_name, 'silver' AS layer_name, 'row_count' AS metric_name,
  CAST(count(*) AS DOUBLE) AS metric_value FROM clean_{s}"""
                for s in rules.SOURCES
            ]
            + [f"SELECT {_METRIC}, 'all_sources', 'gold', 'row_count', CAST(total_rows AS DOUBLE) FROM r"]
            + [f"SELECT {_METRIC}, 'all_sources', 'quality', '{n}', {n} FROM r" for n in _RATIO_SQL]
        ),
    )
)
def q_run_metrics(spark, sf_dir):
    silver = {s: written_once(views.silver(spark, sf_dir, s), s) for s in rules.SOURCES}
    metrics = quality.run_metrics(silver, gold.unified(silver), date.fromisoformat(o.RUN_DATE), "daily_postings")
    path = fresh_dir(spark, "metrics")
    tables.append_run_metrics(metrics, path)
    return spark.read.parquet(path).select(
        F.col("run_date").cast("string").alias("run_date"), "dag_id", "source_name", "layer_name", "metric_name",
        F.round(F.col("metric_value").cast("double"), 9).alias("metric_value"),
    )


@query(
    o.sql(
        _VERSIONS,
        f"""SELECT CAST(max(epoch(CAST(fetched_at AS TIMESTAMPTZ))) AS BIGINT) AS newest_s,
  CAST(epoch(TIMESTAMPTZ '{o.CLOCK}') - max(epoch(CAST(fetched_at AS TIMESTAMPTZ))) AS BIGINT) AS age_seconds,
  CASE WHEN epoch(TIMESTAMPTZ '{o.CLOCK}') - max(epoch(CAST(fetched_at AS TIMESTAMPTZ))) > 3 * 86400 THEN 'error'
       WHEN epoch(TIMESTAMPTZ '{o.CLOCK}') - max(epoch(CAST(fetched_at AS TIMESTAMPTZ))) > 2 * 86400 THEN 'warn'
       ELSE 'pass' END AS status FROM v""",
    )
)
def q_freshness(spark, sf_dir):
    report = quality.freshness(_versions(spark, sf_dir), datetime.fromisoformat(o.CLOCK))
    return report.select(F.unix_seconds("max_loaded_at").alias("newest_s"), "age_seconds", "status")


# --- pages -------------------------------------------------------------------------------------------------------


@query(f"SELECT page_id, {o.page_text_sql('html')} AS page_text FROM pages")
def q_html_to_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", html_to_text(F.col("html")).alias("page_text"))


#: Pages cut off, with openers that nothing closes, closers that nothing opens, and runs of bare brackets.
_BROKEN = """concat('<script x ', repeat('<script ', CAST(page_id % 7 AS INT)), substring(html, 1, CAST(floor(length(html) * 2 / 3.0) AS INT)),
 repeat('<style>', CAST(page_id % 3 AS INT)), substring(html, 200, 900), repeat('<', CAST(page_id % 5 AS INT)), ' a > b </SCRIPT>',
 substring(html, 50, 400), '<style')"""


@query(f"SELECT page_id, {o.page_text_sql('h')} AS page_text FROM (SELECT page_id, {_BROKEN} AS h FROM pages)")
def q_html_to_text_broken(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.expr(_BROKEN).alias("html"))
    return pages.select("page_id", html_to_text(F.col("html")).alias("page_text"))


_ENTITIES = {"&copy;": "©", "&middot;": "·", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def _decoded(value: str) -> str:
    for entity, char in _ENTITIES.items():
        value = f"replace({value}, '{entity}', '{char}')"
    return value


@query(
    f"""SELECT page_id, {o.clean_space(_decoded("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"))} AS title,
  {o.clean_space(_decoded("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS head_title FROM pages"""
)
def q_page_title(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    found = extract.extract_fields(pages, {"t": extract.element("h1"), "h": extract.element("title")})
    return found.select(
        "page_id", extract.first_value(F.col("t")).alias("title"), extract.first_value(F.col("h")).alias("head_title")
    )


# Tags balance by name: a </p> closes the latest open <p>, </article> closes whatever is open inside it.
_PARAGRAPH_CTES = [
    r"""bare AS (SELECT page_id, html, regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '<x>', 'g') AS h
  FROM pages)""",
    r"""tok AS (SELECT page_id, unnest(k) AS t, generate_subscripts(k, 1) AS i
  FROM (SELECT page_id, regexp_extract_all(h, '<[^>]*>|(?:[^<]|<[^>]*\z)+') AS k FROM bare))""",
    f"""b AS (SELECT page_id, i, t, {o.clean_space(_decoded("t"))} AS piece, sum(CASE WHEN regexp_matches(t, '^<p[ >]') THEN 1
    WHEN t = '</p>' THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS depth FROM tok)""",
    """spans AS (SELECT s.page_id, s.i, (SELECT min(e.i) FROM b e WHERE e.page_id = s.page_id AND e.i > s.i AND (e.t = '</article>'
      OR CASE WHEN regexp_matches(s.t, '^<li') THEN e.t = '</li>' ELSE e.t = '</p>' AND e.depth = s.depth - 1 END)) AS j
  FROM b s WHERE regexp_matches(s.t, '^<(p|li)[ >]'))""",
    """para AS (SELECT s.page_id, s.i, string_agg(b.piece, ' ' ORDER BY b.i) AS text FROM spans s JOIN b ON b.page_id = s.page_id
    AND b.i > s.i AND b.i < coalesce(s.j, 1000000000) AND NOT regexp_matches(b.t, '^<[^>]*>$') AND b.piece <> '' GROUP BY ALL)""",
    "long AS (SELECT page_id, string_agg(text, ' ' ORDER BY i) AS text FROM para WHERE length(text) > 40 GROUP BY page_id)",
]


@query(
    o.sql(
        _PARAGRAPH_CTES,
        f"""SELECT p.page_id, coalesce(l.text, substr({o.page_text_sql('p.html')}, 1, 5000)) AS description
FROM pages p LEFT JOIN long l ON p.page_id = l.page_id""",
    )
)
def q_description_fallback(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    found = extract.extract_fields(pages, {"paragraphs": extract.PARAGRAPHS})
    text = extract.description_fallback(F.col("paragraphs"), html_to_text(F.col("html")))
    return found.select("page_id", text.alias("description"))


_META_SQL = {
    name: o.clean_space(f"regexp_extract(page_text, {o._quote('(?i)' + regex)}, 1)")
    for name, (regex, *_) in extract.META_FACTS.items()
}


def _detail_pages_cte(s: str) -> str:
    return f"""g AS (SELECT *, {o.page_text_sql('html')} AS page_text FROM (SELECT doc_id, text,
  CAST(doc_id AS VARCHAR) AS id, {views.RENDERED['title']} AS title, {views.RENDERED['published']} AS published, {views.DETAIL_HTML[s]} AS html FROM documents))"""


@query(o.sql([_detail_pages_cte("workua")], "SELECT doc_id, " + ", ".join(f"{v} AS {k}" for k, v in _META_SQL.items()) + " FROM g"))
def q_meta_regex(spark, sf_dir):
    html = F.expr(views.DETAIL_HTML["workua"])
    pages = views.documents(spark, sf_dir).select("doc_id", html_to_text(html).alias("page_text"))
    return pages.select("doc_id", *[v.alias(k) for k, v in extract.meta_regex_fields(F.col("page_text")).items()])


def _cards_sql(source: str, query: str) -> str:
    return o.sql([f"d AS (SELECT {o._cols(views.RENDERED)} FROM documents)"], query)


@query(
    _cards_sql(
        "dou",
        f"""SELECT page, concat('https://jobs.dou.ua/companies/c-', number, '/vacancies/', number, '/') AS job_url, title, company,
  trim(location) AS location, published AS published_text, {o.clean_space('snippet')} AS snippet, 'dou' AS source
FROM d WHERE has_link = 1""",
    )
)
def q_cards_a_roundtrip(spark, sf_dir):
    cards = extract.extract_cards_dou(views.search_pages(spark, sf_dir, "dou"))
    return cards.select("page", "job_url", "title", "company", "location", "published_text", "snippet", "source")


@query(
    _cards_sql(
        "workua",
        f"""SELECT page, number AS job_id, concat('https://www.work.ua/jobs/', number, '/') AS job_url, title, company,
  CASE WHEN company = '' THEN trim(concat(', ', location)) ELSE location END AS location, published AS published_text,
  {o.clean_space('snippet')} AS snippet, 'workua' AS source
FROM d WHERE has_link = 1 QUALIFY row_number() OVER (PARTITION BY page, number ORDER BY doc_id) = 1""",
    )
)
def q_cards_b_roundtrip(spark, sf_dir):
    cards = extract.extract_cards_workua(views.search_pages(spark, sf_dir, "workua"))
    columns = ["page", "job_id", "job_url", "title", "company", "location", "published_text", "snippet", "source"]
    return cards.select(*columns)


@query(
    _cards_sql(
        "ithub",
        f"""SELECT page, concat('https://ithub.ua/jobs/data-engineer-', number) AS job_url, title, company,
  'Product' AS company_type, trim(location) AS meta_text, published AS published_text,
  {o.clean_space('snippet')} AS description_full, replace(tags, '|', ',') AS skills, 'ithub' AS source
FROM d WHERE has_link = 1""",
    )
)
def q_cards_c_roundtrip(spark, sf_dir):
    cards = extract.extract_cards_ithub(views.search_pages(spark, sf_dir, "ithub"))
    columns = ["page", "job_url", "title", "company", "company_type", "meta_text", "published_text", "description_full"]
    return cards.select(*columns, F.concat_ws(",", "skills_raw").alias("skills"), "source")


def _description_sql(min_chars: int, shorter: str) -> str:
    text = o.clean_space("text")
    return f"CASE WHEN length({text}) > {min_chars} THEN {text} ELSE {shorter} END"


@query(
    o.sql(
        [_detail_pages_cte("dou")],
        f"""SELECT id AS job_id, title, CASE WHEN doc_id % 2 = 0 THEN 'Co & Sons' ELSE 'Link Co' END AS company,
  CASE WHEN doc_id % 3 = 0 THEN 'Kyiv'
       ELSE {o.clean_space(f"regexp_extract(substr(page_text, 1, 1000), {o._quote('(?i)' + '(' + '|'.join(extract.DOU_PLACES) + ')')}, 1)")}
  END AS location,
  published AS published_text, {_description_sql(400, f"CASE WHEN length({o.clean_space('text')}) > 40 THEN {o.clean_space('text')} ELSE substr(page_text, 1, 5000) END")} AS description_full,
  md5(page_text) AS page_md5 FROM g""",
    )
)
def q_detail_a_roundtrip(spark, sf_dir):
    pages = views.detail_pages(spark, sf_dir, "dou").withColumn("job_id", urls.job_id_from_filename(F.col("path")))
    details = extract.extract_detail_dou(pages.withColumn("job_url", F.lit("")))
    columns = ["job_id", "title", "company", "location", "published_text", "description_full"]
    return details.select(*columns, F.md5("page_text").alias("page_md5"))


@query(
    o.sql(
        [_detail_pages_cte("workua")],
        f"""SELECT id AS job_id, concat('https://www.work.ua/jobs/', id, '/') AS job_url, title,
  CASE WHEN doc_id % 2 = 0 THEN 'Co & Sons' ELSE 'Fallback Co' END AS company,
  CASE WHEN {_META_SQL['location']} <> '' THEN {_META_SQL['location']}
       ELSE {o.clean_space(f"regexp_extract(page_text, {o._quote('(?i)' + '(' + '|'.join(extract.WORKUA_PLACES) + ')')}, 1)")} END AS location,
  concat('Вакансія від ', published) AS published_text, {_META_SQL['employment_type']} AS employment_type,
  {_META_SQL['experience_text']} AS experience_text, {_META_SQL['education_text']} AS education_text,
  {_description_sql(300, f"CASE WHEN length({o.clean_space('text')}) > 40 THEN {o.clean_space('text')} ELSE substr(page_text, 1, 5000) END")} AS description_full,
  md5(page_text) AS page_md5 FROM g""",
    )
)
def q_detail_b_roundtrip(spark, sf_dir):
    pages = views.detail_pages(spark, sf_dir, "workua").withColumn("job_id", urls.job_id_from_filename(F.col("path")))
    details = plans_details.parse_details_workua(pages)
    columns = [
        "job_id", "job_url", "title", "company", "location", "published_text", "employment_type", "experience_text",
        "education_text", "description_full",
    ]
    return details.select(*columns, F.md5("page_text").alias("page_md5"))


# --- sources and sinks -------------------------------------------------------------------------------------------


@query(ORACLES["q_silver"])
def q_parquet_roundtrip(spark, sf_dir):
    parts = []
    root = fresh_dir(spark, "silver")
    for s in rules.SOURCES:
        path = tables.silver_path(root, s)
        tables.write_silver_parquet(views.silver(spark, sf_dir, s), path, balance=True)
        parts.append(tables.scan_clean(spark, path))
    return joins.union_sources(*parts)


@query(
    o.sql(
        [*o.all_cards_ctes(), o.details_cte("workua"), o.details_cte("dou")],
        """SELECT 'card' AS kind, source, job_url, title, company, dt, page,
  CASE WHEN source = 'ithub' THEN skills_list END AS skills FROM c
UNION ALL SELECT 'detail', source, job_url, title, company, dt, NULL, NULL FROM details_workua
UNION ALL SELECT 'detail', source, job_url, title, company, dt, NULL, NULL FROM details_dou""",
    )
)
def q_json_roundtrip(spark, sf_dir):
    """Cards and details through line-delimited JSON, read back under the declared schemas."""
    root = fresh_dir(spark, "bronze")
    parts = []
    for s in rules.SOURCES:
        columns = [c for c in CARD_SCHEMAS[s].fieldNames() if c not in ("job_id", "company_type", "position")]
        path = f"{root}/cards/{s}"
        views.source_cards(spark, sf_dir, s).select(*columns).write.json(path)
        cards = lake.read_cards(spark, root, s, "", lines=True, path=path)
        skills = F.col("skills_raw") if s == "ithub" else F.lit(None).cast("array<string>")
        parts.append(cards.withColumn("skills", skills).select(
            F.lit("card").alias("kind"), "source", "job_url", "title", "company", "dt", "page", "skills"))
    for s in ("workua", "dou"):
        lake.write_parsed_pages(views.source_details(spark, sf_dir, s).drop("doc_id"), root, s)
        details = lake.read_parsed_pages(spark, root, s)
        parts.append(details.select(
            F.lit("detail").alias("kind"), "source", "job_url", "title", "company", "dt",
            F.lit(None).cast("long").alias("page"), F.lit(None).cast("array<string>").alias("skills")))
    rows = joins.union_sources(*parts)
    return rows.withColumn("skills", F.when(F.col("skills").isNotNull(), skills_csv(F.col("skills"))))


@query(ORACLES["q_silver"])
def q_staged_replace(spark, sf_dir):
    """A name that shows one source's postings is switched to staged, partitioned files that hold all."""
    name = fresh_dir(spark, "t").rsplit("/", 1)[1].replace("-", "_")
    old, new = fresh_dir(spark, "staged"), fresh_dir(spark, "staged")
    tables.write_silver_parquet(views.silver(spark, sf_dir, "dou"), old)
    tables.write_silver_parquet(views.postings(spark, sf_dir), new)
    tables.promote_replace(spark, name, old)
    tables.promote_replace(spark, name, new)
    return spark.table(name)
