"""From raw HTML pages to cards and details.

Two generic operators, ``extract_cards`` and ``extract_fields``, find elements by selector; only the ``html``
column travels to Python, in Arrow batches that are bounded by bytes as well as by rows (``session.bound_batches``, in
any session), and there one page at a time; what was found goes back in pieces. So a worker holds one batch, one page
and one piece, however many pages there are. Every rule about the found texts (ids, links, fallbacks, what to skip) is a
native expression on top.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions.text import collapse_space, html_to_text, strip_space
from hirelake.functions.urls import BASE_URLS, absolute_url, job_id_workua
from hirelake.operators import html_elements
from hirelake.session import bound_batches

# workers receive the helper with the function, so it need not be installed on them
cloudpickle.register_pickle_by_value(html_elements)

#: Characters of pages whose elements go back from Python at once.
PIECE_CHARS = 4 << 20

# Search queries of the board that is crawled by query, in crawl order.
QUERIES = (
    {"query_name": "data_engineer", "query_text": "data engineer", "role_family": "data_engineer"},
    {"query_name": "inzhener_danykh", "query_text": "інженер даних", "role_family": "data_engineer"},
)
# What cards of the other boards carry.
ROLE_FAMILY = "data_engineer"
ITHUB_QUERY_NAME = "data_engineer"
ITHUB_QUERY_TEXT = "data engineer"

# Length limits of description texts, in characters.
MIN_PARAGRAPH_CHARS = 40
DESCRIPTION_FALLBACK_CHARS = 5000
MIN_DESCRIPTION_CHARS = {"workua": 300, "dou": 400}
DOU_LOCATION_HEAD_CHARS = 1000


@dataclass(frozen=True)
class Elements:
    """What to read below a root: the first match of every candidate selector, or every match of all of them.

    ``attribute`` reads an attribute instead of the text; ``within`` narrows the search to the first match of
    another selector; ``longer_than`` counts only texts of more characters (and takes the first such candidate);
    ``unless`` names an earlier field and reads this one only where that one found nothing.
    """

    selectors: tuple[str, ...]
    every: bool = False
    attribute: str | None = None
    within: str | None = None
    longer_than: int | None = None
    unless: str | None = None


def element(*selectors: str, **options) -> Elements:
    return Elements(selectors, **options)


def _elements_udf(root: str | None, fields: Mapping[str, Elements]):
    row = T.StructType([T.StructField(name, T.ArrayType(T.StringType())) for name in fields])
    arrow_type = pa.list_(pa.struct([(name, pa.list_(pa.string())) for name in fields]))
    plain = {name: asdict(f) for name, f in fields.items()}
    find, most = html_elements.page_elements, PIECE_CHARS

    def elements(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            found, chars = [], 0
            for page in pages:
                html = page.as_py()
                found.append(None if html is None else find(html, root, plain))
                chars += len(html or "")
                if chars >= most:
                    yield pa.array(found, type=arrow_type)
                    found, chars = [], 0
            if found:
                yield pa.array(found, type=arrow_type)

    return F.arrow_udf(elements, T.ArrayType(row))


def _may_hold(html: Column, selector: str) -> Column:
    """False only for pages that cannot hold an element of the root selector's classes.

    A class name stands literally in the page unless some class attribute is written with character references.
    """
    names = re.findall(r"\.([\w-]+)", selector)
    literal = reduce(lambda a, b: a & b, [html.contains(n) for n in names], F.lit(True))
    encoded = html.rlike(r"""(?i)class\s*=\s*(?:"[^"]*&|'[^']*&|[^\s>"']*&)""")
    return literal | encoded


def _called_once(pages: DataFrame, call: Column, name: str) -> DataFrame:
    """Add the call's result as a column. A generator of one row keeps later references from calling again, while
    filters on the pages' own columns pass below it, to the scan."""
    bound_batches(pages.sparkSession)
    return pages.select("*", F.explode_outer(F.array(call)).alias(name))


def extract_cards(pages: DataFrame, card_selector: str, fields: Mapping[str, Elements]) -> DataFrame:
    """Add ``cards``: one struct per matching element, in page order; the ``html`` column is dropped.

    Pages without the selector's class names never leave the JVM.
    """
    html = F.when(_may_hold(F.col("html"), card_selector), F.col("html"))
    return _called_once(pages, _elements_udf(card_selector, fields)(html), "cards").drop("html")


def extract_fields(pages: DataFrame, fields: Mapping[str, Elements]) -> DataFrame:
    """Add one array column per field, read from the whole page; ``html`` stays."""
    found = _called_once(pages, _elements_udf(None, fields)(F.coalesce(F.col("html"), F.lit(""))), "_page")
    return found.select(
        *pages.columns, *[F.col("_page")[0][name].alias(name) for name in fields]
    )


def first_value(values: Column) -> Column:
    """First candidate's text, '' when absent."""
    return F.coalesce(F.get(values, 0), F.lit(""))


def _one_row_per_card(found: DataFrame) -> DataFrame:
    # the outer form: the inner one makes Catalyst evaluate the array a second time to test its size
    rows = found.select("*", F.posexplode_outer("cards").alias("position", "card")).drop("cards")
    return rows.where(F.col("position").isNotNull()).select("*", "card.*").drop("card")



def extract_cards_workua(pages: DataFrame, base_url: str = BASE_URLS["workua"]) -> DataFrame:
    """Cards of pages(html, query_name, query_text, role_family, fetched_at, dt, page).

    Skips cards without a posting link, without a title, and repeats of an id within the page.
    """
    fields = {
        "href": element("h2 a[href^='/jobs/']", attribute="href"),
        "title": element("h2 a[href^='/jobs/']"),
        "company": element(".strong-600", within="div.mt-xs"),
        "block": element("div.mt-xs"),
        "snippet": element("p.ellipsis"),
        "published_text": element("time"),
    }
    found = extract_cards(pages, "div.card.job-link", fields)

    def valid_id(card: Column) -> Column:
        href = collapse_space(first_value(card["href"]))
        valid = href.rlike(r"^/jobs/\d+/?$") & (first_value(card["title"]) != "")
        return F.when(valid, job_id_workua(href))

    found = found.withColumn("_ids", F.transform("cards", valid_id))
    # array_position gives the first card of an id, so repeats fall out inside the row, without a shuffle
    kept = F.filter("cards", lambda c, i: F.array_position(F.col("_ids"), F.get(F.col("_ids"), i)) == i + 1)
    cards = _one_row_per_card(found.withColumn("cards", kept).drop("_ids"))

    href, company, block = collapse_space(first_value(F.col("href"))), first_value(F.col("company")), first_value(F.col("block"))
    rest = F.ltrim(F.substring(block, F.length(company) + 1, F.length(block)), F.lit(" ,"))
    has_company = (company != "") & block.startswith(company)
    url = absolute_url(href, base_url)
    return cards.select(
        F.lit("workua").alias("source"),
        "query_name", "query_text", "role_family",
        job_id_workua(url).alias("job_id"),
        url.alias("job_url"),
        first_value(F.col("title")).alias("title"),
        company.alias("company"),
        F.when(has_company, collapse_space(rest)).otherwise(block).alias("location"),
        first_value(F.col("snippet")).alias("snippet"),
        first_value(F.col("published_text")).alias("published_text"),
        "fetched_at", "dt", "page", "position",
    )


def extract_cards_dou(pages: DataFrame, base_url: str = BASE_URLS["dou"]) -> DataFrame:
    """Cards of pages(html, fetched_at, dt, page); cards without a link are skipped, repeats stay."""
    fields = {
        "href": element("a.vt", attribute="href"),
        "title": element("a.vt"),
        "company": element(".company"),
        "location": element(".cities"),
        "published_text": element(".date"),
        "snippet": element(".sh-info"),
    }
    cards = _one_row_per_card(extract_cards(pages, "li.l-vacancy", fields))
    href = strip_space(first_value(F.col("href")))
    return cards.where(href != "").select(
        F.lit("dou").alias("source"),
        F.lit(ROLE_FAMILY).alias("role_family"),
        absolute_url(href, base_url).alias("job_url"),
        *[first_value(F.col(c)).alias(c) for c in ("title", "company", "location", "published_text", "snippet")],
        "fetched_at", "dt", "page", "position",
    )


def extract_cards_ithub(pages: DataFrame, base_url: str = BASE_URLS["ithub"]) -> DataFrame:
    """Cards of pages(html, fetched_at, dt, page); cards without a link are skipped, repeats stay."""
    fields = {
        "href": element("h2 a", attribute="href"),
        "title": element("h2 a"),
        "company": element(".base a"),
        "company_type": element(".jobscompanytype"),
        "meta_text": element(".eventinfo.jobsinfo"),
        "published_text": element(".jobdate"),
        "description_full": element(".cardboxdopinfo"),
        "skills_raw": element(".eventmaintag li", every=True),
    }
    cards = _one_row_per_card(extract_cards(pages, "div.view-content > div.cardbox", fields))
    href = strip_space(first_value(F.col("href")))
    texts = ("title", "company", "company_type", "meta_text", "published_text", "description_full")
    return cards.where(href != "").select(
        absolute_url(href, base_url).alias("job_url"),
        *[first_value(F.col(c)).alias(c) for c in texts],
        F.array_remove("skills_raw", "").alias("skills_raw"),
        F.lit("ithub").alias("source"),
        F.lit(ITHUB_QUERY_NAME).alias("query_name"),
        F.lit(ITHUB_QUERY_TEXT).alias("query_text"),
        F.lit(ROLE_FAMILY).alias("role_family"),
        "dt", "page", "fetched_at", "position",
    )


PARAGRAPHS = element("p, li", every=True, longer_than=MIN_PARAGRAPH_CHARS)


def _or_else(value: Column, other: Column) -> Column:
    """``value`` unless it is null or '', else ``other``, which is evaluated only then."""
    return F.coalesce(F.nullif(value, F.lit("")), other)


def description_fallback(paragraphs: Column, page_text: Column) -> Column:
    """The longer paragraphs and list items, joined, else the head of the page text."""
    return _or_else(F.array_join(paragraphs, " "), F.substring(page_text, 1, DESCRIPTION_FALLBACK_CHARS))


def _description() -> Column:
    fallback = description_fallback(F.col("paragraphs"), F.col("page_text"))
    return F.coalesce(F.get(F.col("descriptions"), 0), fallback)


# Facts stated in the page text of a posting, matched without regard to case. Each entry is a regular
# expression, the words of which a match holds at least one, and how many characters of it may stand before the word.
META_FACTS = {
    "employment_type": (
        r"(Повна зайнятість|Неповна зайнятість|Стажування|Часткова зайнятість)", ("зайнятість", "Стажування"), 10,
    ),
    "experience_text": (r"(Досвід роботи від\s+\d+\s+рок(?:ів|и|у))", ("Досвід роботи від",)),
    "education_text": (r"(Вища освіта|Незакінчена вища освіта|Середня спеціальна освіта)", ("освіта",), 19),
    "location": (
        r"(Дистанційна робота|Віддалена робота|Гібридний формат роботи)",
        ("Дистанційна робота", "Віддалена робота", "Гібридний формат роботи"),
    ),
}
WORKUA_PLACES = (
    "Дистанційна робота", "Віддалена робота", "Гібридний формат роботи", "Київ", "Львів", "Дніпро", "Одеса", "Харків",
    "Івано-Франківськ", "Вся Україна", "за кордоном",
)
DOU_PLACES = ("віддалено", "за кордоном", "Київ", "Львів", "Дніпро", "Одеса", "Харків", "Івано-Франківськ")
WORKUA_DATE = (r"(Вакансія від\s+\d{1,2}\s+[A-Za-zА-Яа-яІіЇїЄєҐґ]+\s+\d{4})", ("Вакансія від",))
DOU_DATE_REGEX = r"(\d{1,2}\s+[а-яіїєґA-Za-z]+\s+\d{4})"
DOU_COMPANY_SUFFIX = "Всі вакансії компанії"


def _search(text: Column, lowered: Column, regex: str, words: Sequence[str], lead: int = 0) -> Column:
    """First match in any case, white space collapsed; '' without one.

    A match holds one of the words, with at most ``lead`` characters before it. The words are searched on the bytes of the
    lowered text; the case-blind expression runs only where one occurs, and from that place on.
    """
    held = [lowered.contains(w.lower()) for w in words]
    places = [F.when(h, F.instr(lowered, w.lower())) for h, w in zip(held, words, strict=True)]
    first = F.least(*places) if len(places) > 1 else places[0]
    # the places are those of the lowered text: the same ones, unless a character has a longer lower-case form
    start = F.when(F.length(lowered) == F.length(text), F.greatest(first - lead, F.lit(1))).otherwise(1)
    match = collapse_space(F.regexp_extract(F.substr(text, start), "(?iuU)" + regex, 1))
    return F.when(reduce(lambda a, b: a | b, held), match).otherwise("")


def _place(text: Column, lowered: Column, places: Sequence[str]) -> Column:
    return _search(text, lowered, f"({'|'.join(places)})", places)


def meta_regex_fields(page_text: Column, lowered: Column | None = None) -> dict[str, Column]:
    """Employment type, experience, education and work format stated in a page text; '' where not stated."""
    lowered = F.lower(page_text) if lowered is None else lowered
    return {name: _search(page_text, lowered, *fact) for name, fact in META_FACTS.items()}


def extract_detail_workua(pages: DataFrame) -> DataFrame:
    """Details of pages(job_id, job_url, html, dt)."""
    fields = {
        "title": element("h1"),
        "company": element(
            "a[href*='/company/']", "div.card a[href*='/company/']", ".text-default-7 a[title]",
            ".text-default-7 strong", ".text-default-7 b", "[data-testid='company-name']", longer_than=0,
        ),
        "descriptions": element(
            "div#job-description", "div[data-testid='job-description']", "div.wordwrap", "div.text-break",
            "div.overflow-wrap", longer_than=MIN_DESCRIPTION_CHARS["workua"],
        ),
        "paragraphs": replace(PARAGRAPHS, unless="descriptions"),
    }
    # the text and its lower-case form are each made once and then read as columns
    found = extract_fields(pages, fields).withColumn("page_text", html_to_text(F.col("html")))
    found = found.withColumn("_lowered", F.lower("page_text"))
    text, lowered = F.col("page_text"), F.col("_lowered")
    meta = meta_regex_fields(text, lowered)
    location = _or_else(meta["location"], _place(text, lowered, WORKUA_PLACES))
    return found.select(
        "job_id", "job_url",
        first_value(F.col("title")).alias("title"),
        first_value(F.col("company")).alias("company"),
        location.alias("location"),
        _search(text, lowered, *WORKUA_DATE).alias("published_text"),
        *[meta[c].alias(c) for c in ("employment_type", "experience_text", "education_text")],
        _description().alias("description_full"),
        "page_text",
        F.lit("workua").alias("source"),
        "dt",
    )


def extract_detail_dou(pages: DataFrame) -> DataFrame:
    """Details of pages(job_id, job_url, html, dt)."""
    fields = {
        "title": element("h1.g-h2, h1"),
        "company": element(".b-compinfo .l-n a, .b-compinfo .l-n, .b-vacancy-title .company"),
        "company_link": element("a[href*='/companies/']"),
        "location": element(".b-vacancy .sh-info, .sh-info"),
        "published_text": element(".date"),
        "descriptions": element(
            ".b-typo.vacancy-section", ".l-vacancy", ".b-vacancy .text", ".b-vacancy .vacancy-section", ".b-typo",
            longer_than=MIN_DESCRIPTION_CHARS["dou"],
        ),
        "paragraphs": replace(PARAGRAPHS, unless="descriptions"),
    }
    found = extract_fields(pages, fields).withColumn("page_text", html_to_text(F.col("html")))
    named = F.trim(F.regexp_replace(first_value(F.col("company")), rf"(?iu) {DOU_COMPANY_SUFFIX}.*$", ""))
    linked = F.trim(F.replace(first_value(F.col("company_link")), F.lit(DOU_COMPANY_SUFFIX), F.lit("")))
    location, published = first_value(F.col("location")), first_value(F.col("published_text"))
    head = F.substring("page_text", 1, DOU_LOCATION_HEAD_CHARS)
    return found.select(
        "job_id", "job_url",
        first_value(F.col("title")).alias("title"),
        _or_else(named, linked).alias("company"),
        _or_else(location, _place(head, F.lower(head), DOU_PLACES)).alias("location"),
        _or_else(published, collapse_space(F.regexp_extract("page_text", "(?U)" + DOU_DATE_REGEX, 1))).alias("published_text"),
        _description().alias("description_full"),
        "page_text",
        F.lit("dou").alias("source"),
        "dt",
    )
