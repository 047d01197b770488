import pytest
from pyspark.sql import functions as F

from hirelake.operators import extract
from hirelake.operators.html_elements import Page
from hirelake.plans.details import parse_details_dou, parse_details_workua

BROKEN = [None, "", "<<<no>>> markup", "<html><body><p>nothing here</p>", "<![bogus", "<div class='card job-link'"]


def texts(html, selector):
    page = Page(html)
    return [page.text(n) for n in page.select(selector)]


def test_element_text_is_stripped_joined_and_decoded():
    assert texts("<p> a\n <b>b</b>&amp;c<!-- x -->d </p>", "p") == ["a b &c d"]
    assert texts("<p>a<script>x</script><style>y</style>b</p>", "p") == ["a b"]


def test_unclosed_and_stray_tags():
    assert texts("<p>a<p>b</p>c", "p") == ["a b c", "b"]
    assert texts("</div><p>a<br>b<img src=x>c</p></p>", "p") == ["a b c"]
    assert texts("<ul><li>a<li>b</ul>c", "li") == ["a b", "b"]
    assert texts("<p/>a", "p") == [""]


def test_selectors():
    html = """<div class="x y" id="i"><a href="/jobs/1">one</a><span><a title="">two</a></span></div>
    <div class="y"><a data-t="v">three</a></div><a href="/company/2">four</a>"""
    assert texts(html, "div.y.x a") == ["one", "two"]
    assert texts(html, "div.x > a") == ["one"]
    assert texts(html, "div#i a[href^='/jobs/']") == ["one"]
    assert texts(html, "a[href*='/company/'], [data-t='v']") == ["three", "four"]
    assert texts(html, "a[title]") == ["two"]
    assert texts(html, "nav a") == []


def workua_pages(spark, *htmls):
    rows = [(h, "q", "query", "family", "t0", "2026-03-14", i + 1) for i, h in enumerate(htmls)]
    schema = "html string, query_name string, query_text string, role_family string, fetched_at string, dt string, page long"
    return spark.createDataFrame(rows, schema)


def test_cards_workua(spark):
    html = """
    <div class="card job-link"><h2><a href="/jobs/10/">Data &amp; ML</a></h2>
      <div class="mt-xs"><span class="strong-600">ACME</span>, Kyiv,  remote</div>
      <p class="ellipsis">short text</p><time>today</time></div>
    <div class="card job-link"><h2><a href="/jobs/11"> </a></h2></div>
    <div class="card job-link"><h2><a href="/jobs/11">Second</a></h2><div class="mt-xs">Lviv</div></div>
    <div class="card job-link"><h2><a href="/jobs/10/">Repeat</a></h2></div>
    <div class="card job-link"><h2><a href="/jobs/12/apply">Odd</a></h2></div>
    <div class="card"><h2><a href="/jobs/13/">Not a card</a></h2></div>"""
    rows = extract.extract_cards_workua(workua_pages(spark, html)).orderBy("position").collect()
    assert [(r.job_id, r.title, r.company, r.location) for r in rows] == [
        ("10", "Data & ML", "ACME", "Kyiv, remote"), ("11", "Second", "", "Lviv"),
    ]
    first = rows[0].asDict()
    assert first["job_url"] == "https://www.work.ua/jobs/10/" and first["source"] == "workua"
    assert (first["snippet"], first["published_text"], first["query_text"], first["page"]) == ("short text", "today", "query", 1)
    assert rows[1].snippet == "" and rows[1].published_text == ""


def test_repeats_on_other_pages_stay_until_dedup(spark):
    card = '<div class="card job-link"><h2><a href="/jobs/10/">T</a></h2></div>'
    assert extract.extract_cards_workua(workua_pages(spark, card, card + card)).count() == 2


def test_company_comes_from_the_first_block(spark):
    html = """<div class="card job-link"><h2><a href="/jobs/1/">T</a></h2><div class="mt-xs">Odesa</div>
      <div class="mt-xs"><b class="strong-600">Late</b></div></div>"""
    row = extract.extract_cards_workua(workua_pages(spark, html)).head()
    assert (row.company, row.location) == ("", "Odesa")


def test_cards_dou_and_ithub(spark):
    dou = """<ul><li class="l-vacancy"><a class="vt" href=" /vacancies/1/ ">One</a><span class="cities">Kyiv</span></li>
      <li class="l-vacancy"><a class="vt">no link</a></li><li class="l-vacancy"><a class="vt" href="/vacancies/1/"></a></li></ul>"""
    rows = extract.extract_cards_dou(workua_pages(spark, dou)).orderBy("position").collect()
    assert [(r.job_url, r.title, r.location, r.company) for r in rows] == [
        ("https://jobs.dou.ua/vacancies/1/", "One", "Kyiv", ""), ("https://jobs.dou.ua/vacancies/1/", "", "", ""),
    ]
    ithub = """<div class="view-content"><div class="cardbox"><h2><a href="/jobs/a"> A </a></h2><ul class="eventmaintag">
      <li>SQL</li><li> </li><li><i>dbt</i> core</li></ul><div class="eventinfo jobsinfo">Kyiv</div></div>
      <div class="cardbox"><h2>no link</h2></div><section><div class="cardbox"><h2><a href="/jobs/b">nested</a></h2></div></section></div>"""
    rows = extract.extract_cards_ithub(workua_pages(spark, ithub)).collect()
    assert [(r.job_url, r.title, r.skills_raw, r.meta_text) for r in rows] == [
        ("https://ithub.ua/jobs/a", "A", ["SQL", "dbt core"], "Kyiv"),
    ]
    assert rows[0].query_name == "data_engineer" and rows[0].page == 1


@pytest.mark.parametrize("f", [extract.extract_cards_workua, extract.extract_cards_dou, extract.extract_cards_ithub])
def test_broken_pages_give_no_cards(spark, f):
    assert f(workua_pages(spark, *BROKEN)).count() == 0


def test_encoded_class_names_are_still_found(spark):
    html = '<li class="l&#45;vacancy"><a class="vt" href="/x">T</a></li>'
    assert extract.extract_cards_dou(workua_pages(spark, html)).count() == 1


def detail_pages(spark, *htmls):
    rows = [(str(i), "", h, "2026-03-14") for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "job_id string, job_url string, html string, dt string")


def test_detail_workua(spark):
    long_text = "Build and run pipelines. " * 20
    html = f"""<h1>Engineer</h1><a href="/company/1"> </a><div class="text-default-7"><b>Named</b></div>
    <div class="wordwrap">short</div><div class="text-break">{long_text}</div>
    <p>повна зайнятість, Досвід роботи від 3 років. Вакансія від 5 березня 2026</p>"""
    row = extract.extract_detail_workua(detail_pages(spark, html)).head()
    assert (row.title, row.company, row.description_full) == ("Engineer", "Named", long_text.strip())
    assert (row.employment_type, row.experience_text) == ("повна зайнятість", "Досвід роботи від 3 років")
    assert (row.education_text, row.location, row.published_text) == ("", "", "Вакансія від 5 березня 2026")


def test_detail_dou_fallbacks(spark):
    paragraph = "A paragraph that is certainly longer than forty characters."
    html = f"""<h1>Other</h1><h1 class="g-h2">Second</h1><a href="/companies/1/">Firm Всі вакансії компанії</a>
    <p>м. Львів, 3 травня 2026</p><ul><li>{paragraph}</li></ul>"""
    row = extract.extract_detail_dou(detail_pages(spark, html)).head()
    assert (row.title, row.company, row.location, row.published_text) == ("Other", "Firm", "Львів", "3 травня 2026")
    assert row.description_full == paragraph


def test_company_suffix_is_cut(spark):
    html = '<div class="b-compinfo"><div class="l-n"><a>Firm</a> Всі Вакансії компанії 12</div></div>'
    assert extract.extract_detail_dou(detail_pages(spark, html)).head().company == "Firm Всі Вакансії компанії 12".split(" В")[0]


@pytest.mark.parametrize("f", [extract.extract_detail_workua, extract.extract_detail_dou])
def test_broken_pages_give_one_record_each(spark, f):
    rows = f(detail_pages(spark, *BROKEN)).orderBy("job_id").collect()
    assert len(rows) == len(BROKEN)
    assert all(r.title == "" and r.company == "" for r in rows)
    assert rows[0].description_full == "" and rows[1].description_full == ""


def test_description_falls_back_to_head_of_page_text(spark):
    html = "<div>" + "w " * 4000 + "</div>"
    row = extract.extract_detail_dou(detail_pages(spark, html)).head()
    assert row.description_full == ("w " * 4000).strip()[:5000] and len(row.page_text) == 7999


def test_parse_details_attach_urls(spark):
    pages = detail_pages(spark, "<h1>A</h1>", "<h1>B</h1>").drop("job_url")
    assert [r.job_url for r in parse_details_workua(pages).orderBy("job_id").collect()] == [
        "https://www.work.ua/jobs/0/", "https://www.work.ua/jobs/1/",
    ]
    cards = spark.createDataFrame(
        [("https://h/1?old", 1), ("https://h/1?new", 2), ("", 3), (None, 4)], "job_url string, page long"
    )
    rows = parse_details_dou(pages, cards).orderBy("job_id").collect()
    assert [r.job_url for r in rows] == ["", "https://h/1?new"]


def test_one_python_evaluation_per_page(spark):
    plan = extract.extract_cards_workua(workua_pages(spark, ""))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    plan = extract.extract_detail_workua(detail_pages(spark, ""))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_generic_cards(spark):
    df = spark.createDataFrame([("<i class='c'><b>x</b><b>y</b></i>",)], "html string")
    rows = extract.extract_cards(df, "i.c", {"b": extract.element("b", every=True)}).select(F.inline("cards")).collect()
    assert rows[0].b == ["x", "y"]


def test_candidates_by_length_and_unless(spark):
    fields = {
        "long": extract.element("i", "b", longer_than=3),
        "rest": extract.element("u", every=True, unless="long"),
    }
    df = spark.createDataFrame([("<i>abc</i><b>abcd</b><u>x</u>",), ("<i>abc</i><u>x</u><u>y</u>",)], "html string")
    rows = extract.extract_fields(df, fields).collect()
    assert [(r.long, r.rest) for r in rows] == [(["abcd"], []), ([], ["x", "y"])]


def test_many_unclosed_tags_stay_fast():
    page = Page("<b>x</i>" * 20_000 + "<p>y</p>")
    assert page.text(page.select("p")[0]) == "y" and len(page.tags) == 20_001


def test_facts_are_found_from_their_first_word_on(spark):
    texts = {
        "experience_text": ("досвід роботи від рік, Досвід  роботи від 3 роки", ""),
        "education_text": ("освіта потім середня спеціальна освіта", "середня спеціальна освіта"),
        "employment_type": ("İ" * 30 + "ЧАСТКОВА ЗАЙНЯТІСТЬ", "ЧАСТКОВА ЗАЙНЯТІСТЬ"),
        "location": ("x" * 5000 + " гібридний формат роботи та віддалена робота", "гібридний формат роботи"),
    }
    for name, (text, found) in texts.items():
        df = spark.createDataFrame([(text,)], "page_text string")
        assert df.select(extract.meta_regex_fields(F.col("page_text"))[name]).head()[0] == found, name


def test_batches_of_large_pages_are_bounded_by_bytes(spark):
    """Pages of 1 MB, with a bound of 4 MB: no batch that reaches Python holds more than the bound and one page."""
    import pyarrow as pa

    from hirelake.session import ARROW_BATCHES, DEFAULTS

    assert ARROW_BATCHES.items() <= DEFAULTS.items()
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(bound)
    spark.conf.set(bound, str(4 << 20))

    @F.arrow_udf("long")
    def batch_bytes(html: pa.Array) -> pa.Array:
        return pa.array([html.nbytes] * len(html))

    try:
        pages = spark.range(0, 40, 1, 1).select(F.concat(F.lit("<h1>T</h1>"), F.repeat(F.lit("x"), 1 << 20)).alias("html"))
        sizes = [r[0] for r in pages.select(batch_bytes("html")).collect()]
        assert len(sizes) == 40 and max(sizes) <= 6 << 20
        found = extract.extract_fields(pages, {"title": extract.element("h1")})
        assert [r.title for r in found.select("title").collect()] == [["T"]] * 40
    finally:
        spark.conf.set(bound, before)


def test_pages_reach_python_in_bounded_batches_in_any_session(spark):
    """A session without bounds of its own: the step lowers them, keeps tighter ones, and a worker reads page by page."""
    from hirelake.session import ARROW_BATCHES

    before = {key: spark.conf.get(key) for key in ARROW_BATCHES}
    tight = dict.fromkeys(ARROW_BATCHES, "500")
    try:
        for stated, wanted in (
            (dict(zip(ARROW_BATCHES, ("256MB", "10000"), strict=True)), ARROW_BATCHES),
            (dict(zip(ARROW_BATCHES, ("2147483647", "0"), strict=True)), ARROW_BATCHES), (tight, tight),
        ):
            for key, value in stated.items():
                spark.conf.set(key, value)
            pages = spark.range(0, 10, 1, 1).select(F.concat(F.lit("<h1>"), "id", F.lit("</h1>")).alias("html"))
            found = extract.extract_fields(pages, {"title": extract.element("h1")})
            assert {key: spark.conf.get(key) for key in ARROW_BATCHES} == wanted
            assert [r.title for r in found.collect()] == [[str(i)] for i in range(10)]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_elements_go_back_in_pieces(monkeypatch):
    """Of a batch of ten pages no more than a piece is held; nulls and order stay."""
    import pyarrow as pa

    monkeypatch.setattr(extract, "PIECE_CHARS", 20)
    step = extract._elements_udf("i", {"t": extract.element("b")}).func
    pages = pa.array([None if n == 4 else f"<i><b>{n}</b></i>" for n in range(10)], pa.string())
    pieces = list(step(iter([pages, pages[:0], pages[:3]])))
    assert max(map(len, pieces)) <= 3 and len(pieces) > 5
    found = [row for piece in pieces for row in piece.to_pylist()]
    one = lambda n: None if n == 4 else [{"t": [str(n)]}]
    assert found == [one(n) for n in (*range(10), *range(3))]
