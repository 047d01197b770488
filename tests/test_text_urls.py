import re
import time

from pyspark.sql import functions as F

from hirelake.functions import urls
from hirelake.functions.text import collapse_space, html_to_text, is_blank, normalize_name, strip_space


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_collapse_space(spark):
    values = [None, "", " a  b\n\tc ", "a b c", "\x1ca\x0bb\x85"]
    assert column(spark, values, collapse_space) == ["", "", "a b c", "a b c", "a b"]


def test_strip_space(spark):
    assert column(spark, [None, "\u00a0 a  b\n", "a"], strip_space) == ["", "a  b", "a"]


def test_is_blank_counts_spaces_only(spark):
    assert column(spark, [None, "", "  ", "\t", "x"], is_blank) == [True, True, True, False, False]


def test_html_to_text(spark):
    values = [
        None,
        "<p>a<b>b</b></p>\n c",
        "<SCRIPT>var x='<p>';</SCRIPT>x<style>\np{}</style>y",
        "1 &lt; 2 &amp; 3",
        "<<<broken>>>",
        "a <b\nclass='x'> c",
        "a" + "<br> \n" * 50_000 + "b < c",
    ]
    assert column(spark, values, html_to_text) == ["", "a b c", "x y", "1 &lt; 2 &amp; 3", ">>", "a c", "a b < c"]


def test_normalize_name(spark):
    values = [None, " Big-Company, Ltd. ", "Інженер (даних)!", "C++/C#", "---", "Müller"]
    assert column(spark, values, normalize_name) == ["", "big company ltd", "інженер даних", "c c", "", "m ller"]


def test_job_ids(spark):
    values = ["https://x.example/jobs/12/", "/jobs/7", "https://x.example/jobs/a1/", None, ""]
    assert column(spark, values, urls.job_id_workua) == ["12", "7", None, None, None]
    values = ["https://h/companies/a b/vacancies/1/?x=1#y", "https://h/", "https://h", "/rel/1;p", None, ""]
    expected = ["companies_a_b_vacancies_1", "unknown", "unknown", "rel_1", None, "unknown"]
    assert column(spark, values, urls.job_id_dou) == expected
    values = ["https://h/jobs/x-1", "https://h/jobs/x?p=1", "https://h/", "nothing", None]
    assert column(spark, values, urls.job_id_ithub) == ["jobs_x-1", "jobs_x_p_1", None, None, None]


def test_file_names_and_rebuilt_urls(spark):
    assert column(spark, ["a/b/job_12.html", "job_x-y.html"], urls.job_id_from_filename) == ["12", "x-y"]
    assert column(spark, ["12", "x", ""], urls.workua_url_from_id) == ["https://www.work.ua/jobs/12/", "", ""]


def test_absolute_url(spark):
    values = ["/a", "https://o/x", "//o/x", "?q=1", "rel", "mailto:x"]
    expected = ["https://h/a", "https://o/x", "https://o/x", "https://h?q=1", "https://h/rel", "mailto:x"]
    assert column(spark, values, lambda c: urls.absolute_url(c, "https://h")) == expected


def original(page):
    """The three rules as plain patterns, in their order."""
    page = re.sub(r"(?is)<script.*?>.*?</script>", " ", page, flags=re.A)
    page = re.sub(r"(?is)<style.*?>.*?</style>", " ", page, flags=re.A)
    return re.sub(r"[\s]+", " ", re.sub(r"<[^>]+>", " ", page)).strip(" ")


BROKEN = [
    "a<script>b</script>c", "a<script b</script>c", "a<script <script> x </script> y </script> z", "<script>a", "a</script>b",
    "<SCRIPT x>y</Script>z<style>q</STYLE>r<style>s", "a < b > c <d", "<<<>>><>", "x<script>1</script><script 2</script>3",
    "<style><script></style>t</script>u", "a <b> <c>  d<", "", "<scripty>q</scripty></script>w", "\n<p>a</p>\n\n<p>b",
]


def test_html_to_text_of_broken_pages(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(BROKEN)], "i int, p string")
    got = [r[0] for r in df.orderBy("i").select(html_to_text(F.col("p"))).collect()]
    assert got == [original(p) for p in BROKEN]


def test_html_to_text_is_linear(spark):
    size = 1_000_000
    pages = ["<script" * (size // 7), "<script>" * (size // 8), "<a" * (size // 2), "<" * size, "<script" * (size // 7) + "</script>",
             "<style>" * (size // 7) + "x", "<script></script>" * (size // 17), "</script>" * (size // 9), "<>" * (size // 2)]
    for page in pages:
        df = spark.createDataFrame([(page,)], "p string").select(F.length(html_to_text(F.col("p"))))
        start = time.perf_counter()
        df.collect()
        assert time.perf_counter() - start < 5, page[:20]
