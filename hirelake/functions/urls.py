"""Posting ids and absolute URLs as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Site roots against which relative links are resolved.
BASE_URLS = {
    "workua": "https://www.work.ua",
    "dou": "https://jobs.dou.ua",
    "ithub": "https://ithub.ua",
}

# Characters that may stay in an id built from a URL, and the id of a URL without a path.
ID_JUNK = "[^A-Za-z0-9_-]+"
NO_PATH_ID = "unknown"


def _empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def job_id_workua(url: Column) -> Column:
    """Digits after ``/jobs/``; null when there are none."""
    return _empty_to_null(F.regexp_extract(url, r"/jobs/(\d+)/?", 1))


def job_id_dou(url: Column) -> Column:
    """Path of the URL without outer slashes, other characters folded to '_'; 'unknown' for an empty path."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, ";[^/]*$", "")
    slug = F.regexp_replace(F.btrim(path, F.lit("/")), ID_JUNK, "_")
    return F.coalesce(_empty_to_null(slug), F.when(url.isNotNull(), F.lit(NO_PATH_ID)))


def job_id_ithub(url: Column) -> Column:
    """Everything after the host, query included, folded like above; null when nothing is left.

    Null (not '') lets the URL take over as the identity, so that such postings do not share one uid.
    """
    tail = F.regexp_extract(url, r"https?://[^/]+/(.*?)/?$", 1)
    return _empty_to_null(F.regexp_replace(tail, ID_JUNK, "_"))


def job_id_from_filename(path: Column) -> Column:
    """``.../job_<id>.html`` → ``<id>``."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.replace(F.replace(name, F.lit("job_"), F.lit("")), F.lit(".html"), F.lit(""))


def workua_url_from_id(job_id: Column) -> Column:
    """Posting URL rebuilt from an all-digit id, '' for any other id."""
    url = F.concat(F.lit(BASE_URLS["workua"] + "/jobs/"), job_id, F.lit("/"))
    return F.when(job_id.rlike(r"^\d+$"), url).otherwise("")


def absolute_url(href: Column, base: str) -> Column:
    """Resolve a link found on a page of ``base`` (a site root without a path)."""
    scheme = base.split("//")[0]
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(scheme), href))
        .when(href.rlike("^[/?#]"), F.concat(F.lit(base), href))
        .when(href == "", F.lit(base))
        .otherwise(F.concat(F.lit(base + "/"), href))
    )
