"""DuckDB SQL for every query that SQL can express.

Written for DuckDB on its own terms: RE2 has no Unicode word boundary, so boundaries are spelled out; percentages
are integer arithmetic, exact half up; every sort states where nulls go.
"""

from __future__ import annotations

from harness import views
from hirelake.functions import rules
from hirelake.schemas import CLEAN_COLUMNS

_NOT_WORD = r"[^\p{L}\p{N}_]"
_SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]+"

RUN_DATE = "2026-03-16"
CLOCK = "2026-03-18T12:00:00+00:00"


def _cols(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{sql} AS {name}" for name, sql in columns.items())


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _re2(pattern: str) -> str:
    if pattern.startswith(r"\b"):
        pattern = f"(^|{_NOT_WORD})" + pattern[2:]
    if pattern.endswith(r"\.\b"):
        return pattern[:-2] + r"[\p{L}\p{N}_]"
    if pattern.endswith(r"\b"):
        pattern = pattern[:-2] + f"($|{_NOT_WORD})"
    return pattern.replace(r"\s*", r"[\s\p{Z}]*")


def _mentions(text: str, patterns) -> str:
    return "(" + " OR ".join(f"regexp_matches({text}, {_quote(_re2(p))})" for p in patterns) + ")"


def tags_sql(text: str, tags=rules.TAG_PATTERNS) -> str:
    parts = ", ".join(f"CASE WHEN {_mentions(text, tags[t])} THEN {_quote(t)} END" for t in sorted(tags))
    return f"concat_ws(',', {parts})"


def remote_sql(location: str, head: str) -> str:
    whens = [
        f"WHEN {_mentions(value, patterns)} THEN '{label}'"
        for value in (location, head)
        for label, patterns in rules.REMOTE_PATTERNS.items()
    ]
    return f"CASE {' '.join(whens)} ELSE 'unknown' END"


def seniority_sql(title: str, head: str, years: str) -> str:
    whens = [
        f"WHEN {_mentions(value, patterns)} THEN '{label}'"
        for value in (title, head)
        for label, patterns in rules.SENIORITY_PATTERNS.items()
    ]
    whens += [f"WHEN regexp_matches({years}, {_quote(_re2(r))}) THEN '{label}'" for label, r in rules.EXPERIENCE_REGEXES]
    return f"CASE {' '.join(whens)} ELSE 'unknown' END"


def clean_space(value: str) -> str:
    return f"trim(regexp_replace(coalesce({value}, ''), '{_SPACE}', ' ', 'g'))"


def page_text_sql(html: str) -> str:
    bare = f"regexp_replace(coalesce({html}, ''), '(?is)<script.*?>.*?</script>', ' ', 'g')"
    bare = f"regexp_replace({bare}, '(?is)<style.*?>.*?</style>', ' ', 'g')"
    return clean_space(f"regexp_replace({bare}, '(?s)<[^>]+>', ' ', 'g')")


def nonblank(*values: str) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN length(trim({v})) > 0 THEN {v} END" for v in values) + ")"


def blob(*values: str) -> str:
    return " || ' ' || ".join(f"coalesce({v}, '')" for v in values)


ID_SQL = {
    "workua": r"nullif(regexp_extract(job_url, '/jobs/(\d+)/?', 1), '')",
    "dou": r"""CASE WHEN job_url IS NOT NULL THEN coalesce(nullif(regexp_replace(trim(regexp_replace(regexp_extract(job_url,
      '^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)', 3), ';[^/]*$', ''), '/'), '[^A-Za-z0-9_-]+', '_', 'g'), ''),
      'unknown') END""",
    "ithub": r"""nullif(regexp_replace(regexp_extract(job_url, 'https?://[^/]+/(.*?)/?$', 1),
      '[^A-Za-z0-9_-]+', '_', 'g'), '')""",
}


def cards_cte(s: str) -> str:
    return f"cards_{s} AS (SELECT doc_id, {_cols(views.cards_sql(s))} FROM documents)"


def details_cte(s: str) -> str:
    return f"details_{s} AS (SELECT doc_id, {_cols(views.details_sql(s))} FROM documents)"


def unique_cards_cte(s: str) -> str:
    key = "job_id" if s == "workua" else "job_url"
    return f"""unique_cards_{s} AS (
  SELECT * FROM (SELECT *, {ID_SQL[s]} AS job_id FROM cards_{s}) WHERE {key} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY fetched_at DESC NULLS LAST, title ASC NULLS LAST) = 1)"""


def unique_details_cte(s: str) -> str:
    key = "job_id" if s == "workua" else "job_url"
    return f"""unique_details_{s} AS (
  SELECT * FROM details_{s} WHERE nullif({key}, '') IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY title ASC NULLS LAST) = 1)"""


def joined_cte(s: str) -> str:
    """Card facts merged with detail facts, and the text that is searched."""
    if s == "ithub":
        return f"""joined_ithub AS (
  SELECT source, job_id, job_url, title, company, CAST(NULL AS VARCHAR) AS location, meta_text AS snippet,
    published_text, description_full, CAST(NULL AS VARCHAR) AS page_text, query_name, query_text, role_family, dt,
    fetched_at, CAST(NULL AS VARCHAR) AS experience_text, 'ithub::' || coalesce(job_id, job_url) AS source_job_uid,
    {blob("title", "meta_text", "description_full", "query_name", "query_text", "role_family",
          "replace(skills_list, ',', ' ')")} AS text_blob
  FROM unique_cards_ithub WHERE contains(lower(coalesce(title, '')), 'data engineer'))"""
    key = "job_id" if s == "workua" else "job_url"
    job_id = "c.job_id" if s == "workua" else "coalesce(d.job_id, c.job_url)"
    query = ("c.query_name", "c.query_text") if s == "workua" else ("CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)")
    extra = ["employment_type", "experience_text", "education_text"] if s == "workua" else []
    experience = "d.experience_text" if s == "workua" else "CAST(NULL AS VARCHAR)"
    return f"""joined_{s} AS (
  SELECT *, {blob("title", "snippet", "description_full", "page_text", *extra, "location", "published_text",
                  "query_name", "query_text", "role_family")} AS text_blob
  FROM (SELECT c.source, {job_id} AS job_id, c.job_url, coalesce(c.title, d.title) AS title,
      {nonblank("c.company", "d.company")} AS company, {nonblank("c.location", "d.location")} AS location, c.snippet,
      {nonblank("c.published_text", "d.published_text")} AS published_text, d.description_full, d.page_text,
      {query[0]} AS query_name, {query[1]} AS query_text, c.role_family, c.dt, c.fetched_at,
      d.employment_type, {experience} AS experience_text, d.education_text,
      '{s}::' || {job_id} AS source_job_uid
    FROM unique_cards_{s} c LEFT JOIN unique_details_{s} d ON c.{key} = d.{key}))"""


def clean_cte(s: str) -> str:
    return f"""clean_{s} AS (
  SELECT source_job_uid, job_id, job_url, title, company, location, snippet, published_text, description_full, page_text,
    source, query_name, query_text, role_family,
    {remote_sql("loc", "substr(low, 1, 1500)")} AS remote_type,
    {seniority_sql("tit", "substr(low, 1, 1500)", "years")} AS seniority,
    {tags_sql("low")} AS skills, dt, fetched_at
  FROM (SELECT *, lower(text_blob) AS low, lower(coalesce(location, '')) AS loc, lower(coalesce(title, '')) AS tit,
      lower(coalesce(experience_text, '')) || ' ' || substr(lower(text_blob), 1, 800) AS years FROM joined_{s}))"""


def _chain(s: str, *makers) -> list[str]:
    return [m(s) for m in makers if not (s == "ithub" and m in (details_cte, unique_details_cte))]


def joined_ctes(s: str) -> list[str]:
    return _chain(s, cards_cte, details_cte, unique_cards_cte, unique_details_cte, joined_cte)


def silver_ctes() -> list[str]:
    ctes = [c for s in rules.SOURCES for c in joined_ctes(s) + [clean_cte(s)]]
    return [*ctes, "p AS (" + " UNION ALL ".join(f"SELECT * FROM clean_{s}" for s in rules.SOURCES) + ")"]


def untagged_ctes() -> list[str]:
    """Joined postings of all sources without tags."""
    columns = "source, source_job_uid, job_id, job_url, title, company, location, snippet, published_text, "
    columns += "description_full, query_name, query_text, role_family, dt, fetched_at, experience_text, text_blob"
    ctes = [c for s in rules.SOURCES for c in joined_ctes(s)]
    return [*ctes, "j AS (" + " UNION ALL ".join(f"SELECT {columns} FROM joined_{s}" for s in rules.SOURCES) + ")"]


def all_cards_ctes() -> list[str]:
    ctes = [cards_cte(s) for s in rules.SOURCES]
    union = " UNION ALL ".join(f"SELECT *, {ID_SQL[s]} AS job_id FROM cards_{s}" for s in rules.SOURCES)
    return [*ctes, f"c AS ({union})"]


def sql(ctes: list[str], query: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + query


NAME = "lower(trim(regexp_replace(coalesce({}, ''), '[^a-zA-Zа-яА-ЯіїєґІЇЄҐ0-9]+', ' ', 'g')))"
KEY = f"md5({NAME.format('company')} || '|' || {NAME.format('title')} || '|' || coalesce(seniority, 'unknown'))"
BLANK_SKILLS = "coalesce(trim(skills), '') = ''"

LATEST = """SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY source_job_uid
  ORDER BY fetched_at DESC NULLS LAST, dt DESC NULLS LAST, job_url DESC NULLS LAST) = 1"""
BEST_CTE = f"""best AS (
  SELECT {KEY} AS cross_source_job_key, * FROM p QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY
    CASE WHEN {BLANK_SKILLS} THEN 0 ELSE 1 END DESC, length(coalesce(description_full, '')) DESC,
    CASE source WHEN 'dou' THEN 1 WHEN 'ithub' THEN 2 WHEN 'workua' THEN 3 ELSE 9 END ASC,
    fetched_at DESC NULLS LAST, dt DESC NULLS LAST, source_job_uid DESC NULLS FIRST) = 1)"""


def best_ctes() -> list[str]:
    return [*silver_ctes(), BEST_CTE]


def share_sql(ctes: list[str], table: str, column: str) -> str:
    return sql(
        [*ctes, f"n AS (SELECT coalesce({column}, 'unknown') AS {column}, count(*) AS job_count FROM {table} GROUP BY 1)",
         "t AS (SELECT CAST(sum(job_count) AS BIGINT) AS total FROM n)"],
        f"""SELECT {column}, job_count, ((20000 * job_count + total) // (2 * total)) / 100.0 AS share_pct
FROM n, t ORDER BY job_count DESC, {column} ASC""",
    )


SKILL_COUNTS = """SELECT skill, count(*) AS job_count FROM (
  SELECT DISTINCT cross_source_job_key, trim(unnest(string_split(skills, ','))) AS skill FROM best
  WHERE coalesce(trim(skills), '') <> '') WHERE skill <> '' GROUP BY skill"""
