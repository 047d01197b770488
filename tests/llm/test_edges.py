"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelake.llm import (
    chat, decontaminate, exact_dedup, language_id, packing, pii, sharding, simhash, toxicity, url_filter,
)

LONG = "word " * 30_000
ROWS = [(1, "one two three four"), (2, None), (3, ""), (4, LONG), (4, LONG), (5, " one  two three\tfour"), (None, "x"),
        (6, "\n"), (7, "one two three four")]


@pytest.fixture(scope="module")
def docs(make):
    return make(ROWS)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, "two three"), (1, "two three"), (2, None), (3, ""), (None, "four")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (7, None)], "doc_id long, toxic int")


def listed(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_exact_dedup(docs, empty):
    got = {(r[0], r[1], r[2], r[3]) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {(1, 5, 3, False), (5, 5, 3, True), (7, 5, 3, False), (2, 6, 3, False), (3, 6, 3, False), (6, 6, 3, True),
                   (4, 4, 2, True), (None, None, 1, True)}
    assert exact_dedup.exact_dedup(docs).count() == len(ROWS)
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "5", "6", "None"]
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.without_copies(empty).count() == 0


def test_simhash(docs, empty):
    got = {(r[0], r[2]) for r in simhash.near_dedup(docs).collect()}
    assert got == {(1, 1), (5, 1), (7, 1), (2, 2), (3, 2), (6, 2), (4, 4), (None, None)}
    assert sorted(str(r.doc_id) for r in simhash.one_per_component(docs).collect()) == ["1", "2", "4", "4", "None"]
    assert simhash.near_dedup(empty).count() == 0


def test_rows_that_share_an_id_are_told_apart_by_text(make):
    rows = make([(1, "a b"), (2, "a b"), (2, "own text"), (None, "a b"), (None, "only here"), (None, "only\there"), (3, "ab")])
    kept = exact_dedup.without_copies(rows)
    assert kept.columns == rows.columns
    got = sorted((str(r.doc_id), "".join(r.text.split())) for r in kept.collect())
    assert got == [("1", "ab"), ("2", "owntext"), ("None", "onlyhere")]
    near = simhash.one_per_component(make([(1, "a b c"), (2, "a b c"), (2, "own text"), (2, None), (None, "a b c")]))
    assert sorted((str(r.doc_id), str(r.text)) for r in near.collect()) == [
        ("1", "a b c"), ("2", "None"), ("2", "own text"), ("None", "a b c")]


def test_decontaminate(spark, docs, empty, bench):
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert [(s.first, s.end) for s in got[1].spans] == [(1, 4)] and got[1]["items"] == [1]
    assert got[2].n_words == 0 and got[4].n_words == 30_000 and not got[4].spans
    cut = {(r.doc_id, r.text, r.fp) for r in decontaminate.without_benchmark(docs, bench).collect() if r.doc_id != 4}
    assert cut == {(1, "one ", 7), (7, "one ", 7), (5, " one  ", 7), (2, None, 7), (3, "", 7), (6, "\n", 7), (None, "x", 7)}
    no_items = spark.createDataFrame([], bench.schema)
    assert decontaminate.contamination(docs, no_items).where("size(spans) > 0").count() == 0
    assert decontaminate.without_benchmark(docs, no_items).exceptAll(docs).count() == 0
    assert decontaminate.contamination(empty, bench).count() == 0


def test_a_cut_that_makes_an_occurrence_is_cut_again(make, spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    got = decontaminate.without_benchmark(make([(1, "x a a b b y"), (2, "a b"), (3, "b a")]), bench)
    assert listed(got.select("doc_id", "text"), "doc_id") == [(1, "x  y"), (3, "b a")]


@pytest.mark.parametrize("held", [1, 4])
def test_several_blocks_give_the_same(make, bench, docs, monkeypatch, held):
    monkeypatch.setattr(decontaminate, "PASSES", held)
    one = listed(decontaminate.contamination(docs, bench), "doc_id", "n_words")
    words = lambda df: sorted(str((r.doc_id, r.text and r.text.split())) for r in df.collect())
    cut = words(decontaminate.without_benchmark(docs, bench))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 1)
    assert listed(decontaminate.contamination(docs, bench), "doc_id", "n_words") == one
    assert words(decontaminate.without_benchmark(docs, bench)) == cut


def test_packing(docs, empty):
    got = packing.best_fit_packing(docs)
    assert got.agg(F.sum("length")).first()[0] == got.select("sequence_id", "offset", "length").distinct().agg(F.sum("length")).first()[0]
    assert {r.doc_id: r.length for r in got.where("doc_id in (2, 3)").collect()} == {2: 1, 3: 1}
    assert packing.best_fit_packing(empty).count() == 0


def test_sharding(docs, empty):
    got = sharding.shards(docs, 4)
    sizes = [r[1] for r in got.groupBy("shard").count().collect()]
    assert sum(sizes) == len(ROWS) and max(sizes) - min(sizes) <= 1
    assert sharding.shards(empty).count() == 0


def test_toxicity(docs, empty, labels, spark):
    got = toxicity.toxicity(docs, labels)
    assert got.count() == len(ROWS) and got.where("predicted <> 0 or score is null").count() == 0
    kept = toxicity.not_toxic(docs, spark.createDataFrame([], labels.schema))
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert toxicity.toxicity(empty, labels).count() == 0


def test_language(spark, docs, empty):
    names = docs.withColumn("lang", F.when(F.col("doc_id") < 6, "en"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.language_id(names).collect()}
    assert got[2] == got[3] == got[6] == ("und", 0.0) and got[1] == ("en", 1.0)
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.language_id(nothing).collect()} == {"und"}
    assert language_id.language_id(empty.withColumn("lang", F.lit("en"))).count() == 0


def test_pii(make, empty):
    text = "mail a@b.c_d@e.f now, 1.2.3.4.5, 1.2.3.256, +1 (22) 333-444, 4111 1111 1111 1111"
    docs = make([(1, text), (2, None), (3, ""), (4, "é" + text), (4, "é" + text), (5, "1 " * 20_000), (None, "q@r.st")])
    got = {r.doc_id: r for r in pii.counted(pii.personal_data(docs)).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (2, 1, 1, 1)
    assert got[1].spans == "email:5:10,email:10:16,ip:22:29,card:61:80,phone:44:59"
    assert got[2].spans == got[3].spans == got[5].spans == "" and got[None].spans == "email:0:6"
    shifted = [int(x.split(":")[1]) for x in got[4].spans.split(",")]
    assert shifted == [int(x.split(":")[1]) + 1 for x in got[1].spans.split(",")]
    assert pii.personal_data(empty).count() == 0


def test_pii_of_very_many_candidates(make, monkeypatch):
    """One text with 100,000 matches and candidates is that of its parts, each at its place."""
    monkeypatch.setattr(pii, "learn", lambda rows: ("c.x[0] / 20D", dict.fromkeys(("email", "phone"), 0.0)))
    unit, n = "é𝄞 mail a@b.cd (212) 555-1234 12 34 56 78 ", 25_000
    rows = pii.personal_data(make([(1, unit), (2, unit * n)])).orderBy("doc_id").collect()
    places = [{name: [(s.kind, s.start, s.end) for s in r[name]] for name in ("base", "added")} for r in rows]
    assert [unit[a:b] for _, a, b in places[0]["base"]] == ["a@b.cd"]
    assert [unit[a:b] for _, a, b in places[0]["added"]] == ["555-1234 12 34 56"]
    for name in ("base", "added"):
        (kind, a, b), = places[0][name]
        assert places[1][name] == [(kind, a + i * len(unit), b + i * len(unit)) for i in range(n)]


def test_pii_learns_from_all_documents(spark):
    """Addresses stand in the last hundredths by hash of the id alone, behind more than 20,000 other documents."""
    ids = spark.range(21_000).select(F.col("id").alias("doc_id"))
    last = F.xxhash64("doc_id") > int(2**63 * 0.94)
    number = F.col("doc_id").cast("string")
    docs = ids.select("doc_id", F.when(last, F.concat(F.lit("mail to u"), number, F.lit("@host.example now"))).otherwise(
        F.concat(F.lit("host 10.0.0.1 or 999.1.1."), number % 999)).alias("text"))
    assert docs.where(~last).count() > 20_000
    masked = [(-1, "mail to someone (at) host (dot) example now")]
    docs = docs.unionByName(spark.createDataFrame(masked, docs.schema))
    found = pii.personal_data(docs).where("doc_id = -1").collect()
    assert [tuple(s) for s in found[0].added] == [(0, 8, 39)]


def test_pii_weights_stand_for_repeats(spark):
    """Examples with a number count as so many, in leaves, trees and thresholds."""
    x = lambda digits: [float(digits)] + [0.0] * (len(pii.FEATURES) - 1)
    rows = [(x(1), 0.0, 4), (x(2), 1.0, 40), (x(3), 0.0, 6)]
    schema = "x array<double>, y double, n long"
    once = spark.createDataFrame(rows, schema)
    repeated = spark.createDataFrame([(v, y, 1) for v, y, n in rows for _ in range(n)], schema)
    points = once.select(F.struct("x").alias("c"))
    scores = [[r[0] for r in points.select(F.expr(pii.boosted(t))).collect()] for t in (once, repeated)]
    assert scores[0] == pytest.approx(scores[1])
    assert scores[0][0] == scores[0][1] > 0.5 > scores[0][2]  # four make no leaf, six do


def test_pii_selects_best_spans_first(spark):
    draw, rows = random.Random(5), []
    for _ in range(60):
        wide = draw.choice([10, 60, 400])
        starts = [draw.randrange(wide) for _ in range(draw.randrange(40))]
        rows.append([(draw.randrange(5) / 4, draw.randrange(4), a, a + draw.randrange(1, 9)) for a in starts])
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c array<struct<p:double,kind:int,start:int,end:int>>")
    got = {r.i: sorted(map(tuple, r.s)) for r in df.select("i", pii._best(F.col("c")).alias("s")).collect()}
    for i, row in enumerate(rows):
        kept = []
        for _, _, a, kind, b in sorted((-p, a - b, a, kind, b) for p, kind, a, b in row):
            if all(b <= x or y <= a for _, x, y in kept):
                kept.append((kind, a, b))
        assert got[i] == sorted(kept)


@pytest.mark.parametrize("rows", [0, 1])
def test_whole_pipeline_on_odd_tables(spark, tmp_path, rows):
    """Nulls, empty, long and repeated texts, no labels, and columns named as the operators' own."""
    own = ["dropped_id", "keep_id", "kept", "score", "spans", "items", "n_words", "fingerprint", "component_id", "piece"]
    data = [(None, None), (1, None), (2, ""), (3, "one two three"), (3, "one two three"), (4, LONG), (5, "x y z " * 9)] * rows
    docs = spark.createDataFrame(data, "doc_id long, text string").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.length("text").alias("n_chars"), *(F.lit(7).alias(c) for c in own))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces if r.length > 1} == ({3, 4, 5} if rows else set())
    assert sum(r.length == 1 for r in pieces) == rows  # of the texts without a word one stays


def test_url_filter(spark):
    rules = [("net", "/", "block"), ("a.net", "/en/", "allow"), ("a.net", "/en/", "allow"), ("b.net", "", "allow")]
    rules = spark.createDataFrame(rules, "host string, path string, action string")
    urls = [None, "no url", "http://", "http:///x", "HTTP://X.NET/y?z", "http://net", "http://a.net/en/1", "http://www.a.net/en",
            "http://ba.net/en/", "http://b.net#/q", "http://planet/", "http://a.net/en/1"]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id long, url string, key string")
    got = [(r.rule, r.verdict) for r in url_filter.url_verdicts(pages, rules).orderBy("page_id").collect()]
    net, en = ("net/", "block"), ("a.net/en/", "allow")
    assert got == [(None, "allow")] * 4 + [net, (None, "allow"), en, net, net, ("b.net", "allow"), (None, "allow"), en]
    assert url_filter.url_verdicts(pages.limit(0), rules).count() == 0
    none = url_filter.url_verdicts(pages, rules.limit(0), default="block")
    assert {(r.rule, r.verdict) for r in none.collect()} == {(None, "block")}
    with pytest.raises(ValueError, match="either block or allow"):
        url_filter.url_verdicts(pages, rules.union(spark.createDataFrame([("net", "/", "allow")], rules.schema)))


def test_cascade_in_segments(spark, monkeypatch):
    hosts = [f"h{i}.org" for i in range(500)]
    rules = spark.createDataFrame([(h, "/", "block" if i % 2 else "allow") for i, h in enumerate(hosts[:200])], "host string, path string, action string")
    pages = spark.createDataFrame([(i, f"http://w.{h}/p") for i, h in enumerate(hosts)], "page_id long, url string")
    monkeypatch.setattr(url_filter, "MAX_BYTES", 200)
    got = [(r.rule, r.verdict) for r in url_filter.url_verdicts(pages, rules).orderBy("page_id").collect()]
    assert got == [(f"{h}/", "block" if i % 2 else "allow") if i < 200 else (None, "allow") for i, h in enumerate(hosts)]


def test_chat(spark):
    rows = [(1, 2, "user", "late"), (1, 0, "user", "a<part/>\\"), (1, 0, "user", "a<part/>\\"), (1, 1, "assistant", "\\l</turn>\n"),
            (1, 1, "assistant", None), (2, None, None, "<turn user>"), (None, 0, "assistant", "x>")]
    df = spark.createDataFrame([(*r, "f") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.chat_format(df).select(
        "conv_id", "formatted", chat.read_back(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l"))
    got = {r.conv_id: (r.formatted, [tuple(t) for t in r.t], r.l) for r in out.collect()}
    assert got[1][1] == [("user", "a<part/>\\"), ("user", "a<part/>\\"), ("assistant", ""), ("assistant", "\\l</turn>\n"), ("user", "late")]
    assert got[1][2] == "\\l</turn>\n" and got[1][0].count("<turn ") == 3
    assert got[2][1] == [("", "<turn user>")] and got[2][2] == ""
    assert got[None] == ("<turn assistant>x\\g</turn>\n", [("assistant", "x>")], "x>")
    assert chat.chat_format(df.limit(0)).count() == 0


def test_a_conversation_of_very_many_turns(spark):
    """100,000 turns, learned ones adjacent now and then; texts with control strings and beyond the basic plane."""
    n = 100_000
    turns = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("</turn>\\é𝄞 "), F.col("id").cast("string")).alias("text"))
    out = chat.chat_format(turns).select(
        F.size("loss_spans").alias("n"), chat.read_back(F.col("formatted")).alias("t"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l")).first()
    expected = [("assistant" if i % 3 else "user", f"</turn>\\é𝄞 {i}") for i in range(n)]
    assert [tuple(t) for t in out.t] == expected
    learned = [x for role, x in expected if role == "assistant"]
    assert out.n == len(learned) and out.l == "".join(learned)


def test_url_filter_of_a_very_long_host(spark):
    """A host of a million labels and a path of a million parts have a key for each shape of rules, no more."""
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("a.net", "/en/", "allow")], "host string, path string, action string")
    host = "x." * 1_000_000 + "a.net"
    urls = [f"http://{host}/en/1", f"http://{host}/de", "http://a.org/" + "p/" * 1_000_000, "http://" + "." * 1_000_000 + "net/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = [(r.rule, r.verdict) for r in url_filter.url_verdicts(pages, rules).orderBy("page_id").collect()]
    assert got == [("a.net/en/", "allow"), ("net/", "block"), (None, "allow"), ("net/", "block")]
