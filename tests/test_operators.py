from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.operators import dedup, incremental, joins, marts, project, quality
from hirelake.schemas import CLEAN_COLUMNS


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def posting(**values):
    return tuple(values.get(c) for c in CLEAN_COLUMNS)


def postings(spark, *dicts):
    return spark.createDataFrame([posting(**d) for d in dicts], ", ".join(f"{c} string" for c in CLEAN_COLUMNS))


def test_projection_fills_typed_nulls(spark):
    dou = spark.sql("SELECT 'u' AS job_url, 't' AS title, 'dou' AS source, 'f' AS role_family")
    out = project.project_cards(dou, "dou")
    assert dict(out.dtypes)["query_name"] == "string" and out.head().query_name is None and "job_id" not in out.columns
    ithub = spark.sql("SELECT 'https://h/jobs/a' AS job_url, 'm' AS meta_text, array('x') AS skills_raw, 'here' AS location")
    row = project.project_cards(ithub, "ithub").head()
    assert (row.job_id, row.snippet, row.location, row.skills_raw) == ("jobs_a", "m", None, ["x"])


def test_blank_url_of_a_detail_is_no_key(spark):
    d = "'1' job_id, '' job_url, 't' title, 'c' company, 'l' location, 'p' published_text, 'd' description_full, 'x' page_text"
    row = project.project_details(spark.sql(f"SELECT {d}"), "dou").head()
    assert row.job_url is None and row.detail_title == "t"


def test_merging_rules(spark):
    df = spark.createDataFrame([(" ", "b"), (" a ", "b"), (None, " "), ("\t", "b")], "a string, b string")
    got = df.select(project.coalesce_nonblank(F.col("a"), F.col("b")), project.coalesce_first(F.col("a"), F.col("b")))
    assert [tuple(r) for r in got.collect()] == [("b", " "), (" a ", " a "), (None, " "), ("\t", "\t")]


def test_blob_keeps_separators(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(project.build_text_blob(["x", "y", "z"])).head()[0] == "a  c"
    empty = spark.sql("SELECT CAST(NULL AS array<string>) AS s")
    assert empty.select(project.flatten_raw_skills(F.col("s"))).head()[0] == ""


def test_title_filter(spark):
    df = spark.createDataFrame([("Big DATA Engineer",), ("data engineering",), ("analyst",), (None,)], "title string")
    assert project.filter_title_keyword(df).count() == 2


def test_dedup_is_deterministic_under_partitioning(spark):
    data = [(f"k{i % 7}", f"2026-03-{10 + i % 3}" if i % 4 else None, f"v{i:03}") for i in range(200)]
    df = spark.createDataFrame(data, "k string, fetched_at string, v string")
    first = rows(dedup.dedup_any_by_key(df, "k"))
    assert rows(dedup.dedup_any_by_key(df.repartition(13), "k")) == first
    again = spark.createDataFrame(first, "k string, fetched_at string, v string")
    assert rows(dedup.dedup_any_by_key(again, "k")) == first


def test_latest_per_uid_puts_nulls_last(spark):
    df = postings(
        spark,
        dict(source_job_uid="a", fetched_at=None, dt="2026-03-09", job_url="z"),
        dict(source_job_uid="a", fetched_at="2026-03-01", dt=None, job_url="y"),
        dict(source_job_uid="a", fetched_at="2026-03-01", dt="2026-03-01", job_url=None),
        dict(source_job_uid="a", fetched_at="2026-03-01", dt="2026-03-01", job_url="x"),
    )
    assert [r.job_url for r in dedup.latest_per_uid(df).collect()] == ["x"]


def test_best_per_key_order(spark):
    base = dict(company="Co.", title="Data-Engineer", seniority=None)
    cases = [
        dict(base, source_job_uid="1", source="workua", skills="", description_full="long long"),
        dict(base, source_job_uid="2", source="workua", skills="sql", description_full="ab"),
        dict(base, source_job_uid="3", source="ithub", skills="sql", description_full="ab"),
        dict(base, source_job_uid="4", source="dou", skills="sql", description_full="a"),
        dict(base, source_job_uid="5", source="ithub", skills="sql", description_full="ab", fetched_at="2026"),
        dict(base, source_job_uid="6", company="co", title="data engineer", seniority="unknown", source="ithub",
             skills="sql", description_full="ab", fetched_at="2026"),
        dict(base, source_job_uid="7", seniority="lead", skills=" "),
    ]
    best = dedup.best_per_cross_source_key(postings(spark, *cases))
    assert sorted(r.source_job_uid for r in best.collect()) == ["6", "7"]
    assert best.columns == ["cross_source_job_key", *CLEAN_COLUMNS]
    no_uid = postings(spark, dict(base, source_job_uid=None), dict(base, source_job_uid="9"))
    assert dedup.best_per_cross_source_key(no_uid).head().source_job_uid is None


def test_hot_key_is_cut_before_the_shuffle(spark):
    """Two thirds of the rows share one key; each map task must send one of them."""
    df = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).cast("string").alias("source_job_uid"),
        F.col("id").cast("string").alias("fetched_at"), F.lit("d").alias("dt"), F.lit("u").alias("job_url"),
    )
    out = dedup.latest_per_uid(df)
    assert out.count() == 10_001
    assert out.where("source_job_uid = '-1'").head().fetched_at == "9998"
    plan = out._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_left_join_needs_one_shuffle_per_side(spark):
    cards = spark.range(1000).select(F.col("id").cast("string").alias("job_url"), F.lit("x").alias("title"))
    details = spark.range(500).select(F.col("id").cast("string").alias("job_url"), F.lit("y").alias("t"))
    joined = joins.join_details_left(
        dedup.dedup_any_by_key(cards, "job_url").hint("merge"), dedup.dedup_any_by_key(details, "job_url"), "job_url"
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert joined.where("t IS NULL").count() == 500


def test_first_seen(spark):
    df = spark.createDataFrame([("u", "q1", 2, 0), ("u", "q1", 1, 5), ("u", "q0", 9, 9), ("w", "q1", 1, 1)], "url string, q string, page int, pos int")
    assert rows(dedup.dedup_first_seen(df, "url", ["q", "page", "pos"])) == [("u", "q0", 9, 9), ("w", "q1", 1, 1)]


def test_incremental_filter(spark):
    batch = spark.createDataFrame([("a", "2026-03-01"), ("b", "2026-03-02"), ("c", None)], "k string, dt string")
    target = batch.where("dt = '2026-03-01'")
    assert rows(incremental.incremental_filter(batch, target)) == [("b", "2026-03-02")]
    assert len(rows(incremental.incremental_filter(batch, target, inclusive=True))) == 2
    assert incremental.incremental_filter(batch, batch.limit(0)).count() == 3


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    batch = spark.createDataFrame([("b", 2), ("b", 3), ("c", 2), (None, 2)], "k string, v int")
    once = incremental.upsert_by_key(target, batch, "k")
    expected = sorted([("a", 1), ("b", 2), ("b", 3), ("c", 2), (None, 1), (None, 2)], key=repr)
    assert sorted(map(tuple, once.collect()), key=repr) == expected
    keyed = batch.where("k IS NOT NULL")
    once = incremental.upsert_by_key(target, keyed, "k")
    twice = incremental.upsert_by_key(once, keyed, "k")
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)


def test_skill_demand(spark):
    df = spark.createDataFrame(
        [("k1", "sql, python ,sql,"), ("k1", "sql"), ("k2", "sql"), ("k3", " "), ("k4", None), ("k5", ",,")],
        "cross_source_job_key string, skills string",
    )
    assert rows(marts.skill_demand(df)) == [("python", 1), ("sql", 2)]
    unique = df.where("cross_source_job_key <> 'k1' OR skills <> 'sql'")
    assert rows(marts.skill_demand(unique, keys_are_unique=True)) == [("python", 1), ("sql", 2)]
    assert [tuple(r) for r in marts.top_skills(df, 1).collect()] == [("sql", 2)]
    plan = marts.skill_demand(unique, keys_are_unique=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_shares(spark):
    df = spark.createDataFrame([("a",)] * 1 + [("b",)] * 799 + [(None,)] * 0, "c string")
    out = {r.c: r.share_pct for r in marts.category_share(df, "c").collect()}
    assert out == {"a": Decimal("0.13"), "b": Decimal("99.88")}  # 0.125 and 99.875, half away from zero
    nulls = spark.createDataFrame([(None,), ("lead",)], "c string")
    ordered = marts.order_by_count_then_key(marts.category_share(nulls, "c"), "c").collect()
    assert [(r.c, r.job_count, r.share_pct) for r in ordered] == [("lead", 1, Decimal("50.00")), ("unknown", 1, Decimal("50.00"))]
    assert marts.category_share(nulls.limit(0), "c").count() == 0
    assert spark.range(1).select(marts.share_pct(F.lit(1), F.lit(0))).head()[0] is None


def test_expectations(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), (None, "z")], "k string, v string")
    checks = [
        quality.expect_not_null("k"), quality.expect_unique("k"), quality.expect_unique("v"),
        quality.expect_accepted_values("v", ["x", "y"], severity="warn"),
    ]
    report = quality.run_expectations(df, checks)
    assert {(r.check_name, r.column_name): (r.failed, r.ok) for r in report.collect()} == {
        ("not_null", "k"): (2, False), ("unique", "k"): (1, False), ("unique", "v"): (0, True),
        ("accepted_values", "v"): (1, False),
    }
    with pytest.raises(quality.QualityError, match="not_null"):
        quality.require_ok(report)
    quality.require_ok(report.where("severity = 'warn'"))
    row_wise = quality.run_expectations(df, [quality.expect_not_null("k"), quality.expect_not_null("v")])
    assert row_wise._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_relationship(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    row = quality.expect_relationship(child, "k", parent, "p").head()
    assert (row.failed, row.ok, row.severity) == (2, False, "warn")
    assert quality.expect_relationship(parent, "p", child, "k").head().ok


def test_ratios(spark):
    df = postings(spark, dict(remote_type="unknown", seniority="lead", skills=" "), *[dict(remote_type="remote", seniority="unknown", skills="sql")] * 3)
    report = {r.check_name: (r.ratio, r.ok) for r in quality.check_ratio_max(df, 0.75).collect()}
    assert report["unknown_remote_ratio"] == (Decimal("0.25"), True)
    assert report["unknown_seniority_ratio"] == (Decimal("0.75"), True)  # the limit itself passes
    assert not {r.check_name: r.ok for r in quality.check_ratio_max(df, 0.74).collect()}["unknown_seniority_ratio"]
    empty = quality.check_ratio_max(df.limit(0)).collect()
    assert len(empty) == 3 and not any(r.ok for r in empty)
    with pytest.raises(quality.QualityError):
        quality.check_non_empty({"t": df.limit(0)})


def test_freshness(spark):
    def status(value, hour):
        df = spark.createDataFrame([(value,), (None,), ("junk",)], "fetched_at string")
        return quality.freshness(df, datetime(2026, 3, 18, hour, 0, tzinfo=timezone.utc)).head()

    assert status("2026-03-16T12:00:00+00:00", 12).status == "pass"
    assert status("2026-03-16T12:00:00+00:00", 13).status == "warn"
    assert status("2026-03-15T12:00:00+00:00", 12).status == "warn"
    assert status("2026-03-15T12:00:00+00:00", 13).status == "error"
    assert status(None, 12).status == "error"


def test_run_metrics(spark):
    silver = {s: postings(spark, *[dict(source=s, remote_type="unknown", seniority="lead", skills="x")] * n) for n, s in enumerate(rules.SOURCES)}
    out = quality.run_metrics(silver, joins.union_sources(*silver.values()), date(2026, 3, 16), "run").collect()
    assert [(r.source_name, r.layer_name, r.metric_name, r.metric_value) for r in out] == [
        ("workua", "silver", "row_count", 0), ("dou", "silver", "row_count", 1), ("ithub", "silver", "row_count", 2),
        ("all_sources", "gold", "row_count", 3), ("all_sources", "quality", "unknown_remote_ratio", 1),
        ("all_sources", "quality", "unknown_seniority_ratio", 0), ("all_sources", "quality", "empty_skills_ratio", 0),
    ]
    assert out[0].run_date == date(2026, 3, 16)
