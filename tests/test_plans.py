import os

import pytest
from pyspark.sql import functions as F

from harness import views
from hirelake.functions import rules
from hirelake.operators.extract import extract_detail_workua
from hirelake.operators.quality import QualityError
from hirelake.params import RunParams
from hirelake.plans import gold
from hirelake.plans.daily import run_day
from hirelake.plans.details import parse_details_dou, run_details
from hirelake.plans.silver import run_silver, silver_all
from hirelake.schemas import CLEAN_COLUMNS
from hirelake.sources import tables
from hirelake.sources.lake import read_cards
from tests.test_operators import postings
from tests.test_sources import put


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_has_no_python_and_one_shuffle_per_input(spark, sf_dir):
    plan = plan_of(views.postings(spark, sf_dir))
    assert not any(x in plan for x in ("EvalPython", "PythonUDF", "MapIn", "ScalaUDF"))
    assert plan.count("Exchange hashpartitioning") == 5  # three card tables, two detail tables
    assert plan.count("WindowGroupLimit") == 10
    assert "Exchange SinglePartition" not in plan and "CartesianProduct" not in plan


def test_each_text_is_lowered_once(spark):
    df = spark.sql("SELECT 'a' title, 'b' location, 'c' experience_text, 'd' text_blob, rand() r FROM range(3)")
    from hirelake.functions.classify import with_classification

    plan = with_classification(df.repartition(2))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(text_blob") <= 1


def test_page_text_names_the_page_once_and_compiles(spark, sf_dir):
    from harness.queries import QUERIES
    from hirelake.functions.text import html_to_text

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    one = pages.select(html_to_text(F.col("html")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert one.splitlines()[0].count("html") == 1
    conf = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    for key, value in conf.items():
        spark.conf.set(key, value)  # generated code that does not compile raises
    try:
        for name in ("q_html_to_text", "q_html_to_text_broken", "q_description_fallback", "q_detail_a_roundtrip", "q_detail_b_roundtrip"):
            df = QUERIES[name](spark, sf_dir)
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("html#") <= 10 and plan.count("<script(") <= 2, name
            df.write.format("noop").mode("overwrite").save()
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_marts_read_only_their_columns(spark, sf_dir, tmp_path):
    gold.deduped(views.postings(spark, sf_dir)).write.parquet(f"{tmp_path}/d")
    marts = gold.marts(spark.read.parquet(f"{tmp_path}/d"))
    assert "ReadSchema: struct<cross_source_job_key:string,skills:string>" in plan_of(marts["mart_skill_demand"]) or (
        "ReadSchema: struct<skills:string>" in plan_of(marts["mart_skill_demand"])
    )
    assert "ReadSchema: struct<seniority:string>" in plan_of(marts["mart_seniority_share"])
    assert sum(r.job_count for r in marts["mart_remote_share"].collect()) == spark.read.parquet(f"{tmp_path}/d").count()


def test_union_order_and_partitions_do_not_matter(spark, sf_dir):
    inputs = views.inputs(spark, sf_dir)
    forward = silver_all(inputs)
    backward = silver_all({s: inputs[s] for s in reversed(rules.SOURCES)})
    a, b = gold.deduped(forward), gold.deduped(backward.repartition(7))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert gold.deduped(a.select(*CLEAN_COLUMNS)).exceptAll(a).count() == 0


def test_staging_is_incremental(spark, tmp_path):
    path = f"{tmp_path}/staging"
    day1 = [dict(source_job_uid="a", dt="2026-03-14", title="old"), dict(source_job_uid="b", dt="2026-03-14")]
    day2 = [dict(source_job_uid="a", dt="2026-03-15", title="new"), dict(source_job_uid="c", dt="2026-03-14", title="late")]
    gold.stage(spark, postings(spark, *day1), path)
    staged = gold.stage(spark, postings(spark, *day1, *day2), path)
    assert sorted((r.source_job_uid, r.title or "") for r in staged.collect()) == [("a", "new"), ("b", "")]
    again = gold.stage(spark, postings(spark, *day1, *day2), path)
    assert again.count() == 2
    late = gold.stage(spark, postings(spark, dict(source_job_uid="d", dt="2026-03-15")), path, inclusive=True)
    assert late.count() == 3


DAY = "2026-03-14"


def lake_of_one_day(root, dt=DAY, title="Senior Data Engineer"):
    card = {"title": title, "company": "ACME", "location": "Remote", "snippet": "SQL", "published_text": "today",
            "role_family": "data_engineer", "fetched_at": f"{dt}T09:00:00+00:00", "dt": dt, "page": 1}
    put(f"{root}/jobs/source=workua/query=q/dt={dt}/parsed/search_results_page_1.json",
        [{**card, "source": "workua", "job_url": "https://www.work.ua/jobs/7/"}])
    put(f"{root}/jobs/source=dou/dt={dt}/parsed/search_results.json",
        [{**card, "source": "dou", "job_url": "https://jobs.dou.ua/vacancies/1/", "company": "Other"}])
    put(f"{root}/jobs/source=ithub/dt={dt}/parsed/search_results.json",
        [{**card, "source": "ithub", "job_url": "https://ithub.ua/jobs/x", "meta_text": "Kyiv", "skills_raw": ["Python"]},
         {**card, "source": "ithub", "job_url": "https://ithub.ua/jobs/y", "title": "Analyst"}])
    long = "Python and Airflow. " * 30
    put(f"{root}/jobs/source=workua/details_raw/dt={dt}/job_7.html",
        f"<h1>T</h1><div id='job-description'>{long}</div>Досвід роботи від 5 років")
    put(f"{root}/jobs/source=dou/details_raw/dt={dt}/job_vacancies_1.html", f"<h1>T</h1><div class='b-typo'>{long}</div>")


def parse_raw(spark, params):
    for source in ("workua", "dou"):
        run_details(spark, params, source)


def params_for(root, dt=DAY, **settings):
    base = {"DS": dt, "BRONZE_PATH": f"{root}/bronze", "SILVER_PATH": f"{root}/silver", "GOLD_PATH": f"{root}/gold"}
    return RunParams.from_settings({**base, **settings})


def test_whole_day(spark, tmp_path):
    root = str(tmp_path)
    params = params_for(root)
    lake_of_one_day(params.bronze)
    parse_raw(spark, params)
    out = run_day(spark, params)
    assert {r.source for r in out["unified"].collect()} == set(rules.SOURCES) and out["unified"].count() == 3
    dou = out["unified"].where("source = 'dou'").head()
    assert (dou.source_job_uid, dou.seniority, dou.remote_type) == ("dou::vacancies_1", "senior", "remote")
    assert dou.skills == "airflow,python,sql" and dou.description_full.startswith("Python and Airflow.")
    # workua and ithub show the same vacancy; the longer description wins
    best = {r.source for r in out["deduped"].collect()}
    assert best == {"workua", "dou"}
    assert {r.skill: r.job_count for r in out["mart_skill_demand"].collect()} == {"airflow": 2, "python": 2, "sql": 2}
    metrics = {(r.source_name, r.metric_name): r.metric_value for r in spark.read.parquet(f"{params.gold}/run_metrics").collect()}
    assert metrics[("all_sources", "row_count")] == 3 and metrics[("ithub", "row_count")] == 1

    next_day = params_for(root, "2026-03-15")
    lake_of_one_day(next_day.bronze, "2026-03-15", "Lead Data Engineer")
    parse_raw(spark, next_day)
    out = run_day(spark, next_day)
    assert {r.dt for r in out["unified"].collect()} == {"2026-03-15"} and out["unified"].count() == 3
    assert [r.seniority for r in out["mart_seniority_share"].collect()] == ["lead"]
    assert spark.read.parquet(f"{params.gold}/run_metrics").count() == 14
    assert tables.scan_clean(spark, tables.silver_path(params.silver, "dou")).count() == 2


def test_metrics_count_the_day_alone(spark, tmp_path):
    for dt in (DAY, "2026-03-15"):
        params = params_for(tmp_path, dt)
        lake_of_one_day(params.bronze, dt)
        parse_raw(spark, params)
        run_day(spark, params)
    rows = spark.read.parquet(f"{params.gold}/run_metrics").where("metric_name = 'row_count' and source_name <> 'all_sources'")
    assert {(str(r.run_date), r.source_name, int(r.metric_value)) for r in rows.collect()} == {
        (dt, s, 1) for dt in (DAY, "2026-03-15") for s in rules.SOURCES}


WORKUA = "<div class='card job-link'><h2><a href='/jobs/{0}/'>{1}</a></h2><div class='mt-xs'><span class='strong-600'>ACME</span>, Kyiv</div></div>"
DOU = "<li class='l-vacancy'><a class='vt' href='https://jobs.dou.ua/companies/c/vacancies/{0}/'>{1}</a></li>"
ITHUB = "<div class='view-content'><div class='cardbox'><h2><a href='/jobs/{0}'>{1}</a></h2></div></div>"


def test_day_from_raw_result_pages(spark, tmp_path):
    params = params_for(tmp_path, DQ_MAX_UNKNOWN_RATIO="1.0")
    lake_of_one_day(params.bronze)
    jobs = f"{params.bronze}/jobs"
    for file in ("source=workua/query=q", "source=dou", "source=ithub"):
        for name in os.listdir(f"{jobs}/{file}/dt={DAY}/parsed"):
            os.remove(f"{jobs}/{file}/dt={DAY}/parsed/{name}")

    def page(source, number, html):
        put(f"{jobs}/source={source}/dt={DAY}/raw/search_page_{number}.html", f"<html><body>{html}</body></html>")

    # the posting 7 is on two pages of the first query and, with another title, in the second query
    page("workua/query=inzhener_danykh", 1, WORKUA.format(7, "later query") + WORKUA.format(8, "Data Engineer"))
    page("workua/query=data_engineer", 1, WORKUA.format(7, "Senior Data Engineer"))
    page("workua/query=data_engineer", 2, WORKUA.format(7, "later page"))
    page("dou", 1, DOU.format(1, "Data Engineer") + DOU.format(1, "again"))
    page("dou", 10, DOU.format(1, "page ten") + DOU.format(2, "Data Engineer"))
    page("ithub", 1, ITHUB.format("x", "Data Engineer"))
    page("ithub", 2, ITHUB.format("x", "again"))
    out = run_day(spark, params, parse=True)
    titles = {(r.source, r.job_url.rstrip("/").rsplit("/", 1)[1]): r.title for r in out["unified"].collect()}
    assert titles == {("workua", "7"): "Senior Data Engineer", ("workua", "8"): "Data Engineer", ("dou", "1"): "Data Engineer",
                      ("dou", "2"): "Data Engineer", ("ithub", "x"): "Data Engineer"}
    cards = read_cards(spark, params.bronze, "workua", DAY)
    assert {(r.job_id, r.query_text, r.page, r.position) for r in cards.collect()} == {
        ("7", "data engineer", 1, 0), ("8", "інженер даних", 1, 1)}


def test_last_card_of_a_page_wins(spark, tmp_path):
    cards = [{"job_url": "https://jobs.dou.ua/vacancies/1/?from=z", "page": 1}, {"job_url": "https://jobs.dou.ua/vacancies/1/?from=a", "page": 1}]
    put(f"{tmp_path}/jobs/source=dou/dt={DAY}/parsed/search_results.json", cards)
    pages = spark.createDataFrame([("vacancies_1", "<h1>T</h1>", DAY, "dou")], "job_id string, html string, dt string, source string")
    found = parse_details_dou(pages, read_cards(spark, str(tmp_path), "dou", DAY)).collect()
    assert [r.job_url for r in found] == ["https://jobs.dou.ua/vacancies/1/?from=a"]


def test_filters_pass_the_extraction(spark, tmp_path):
    pages = spark.createDataFrame([("1", "u", "<h1>T</h1>", d) for d in (DAY, "2026-03-15")], "job_id string, job_url string, html string, dt string")
    pages.write.partitionBy("dt").parquet(f"{tmp_path}/p")
    stored = spark.read.parquet(f"{tmp_path}/p").withColumn("dt", F.col("dt").cast("string"))
    one = extract_detail_workua(stored).where(f"dt = '{DAY}'")
    plan = plan_of(one)
    assert plan.count("ArrowEvalPython") == 1
    assert "PartitionFilters: []" not in plan and "PartitionFilters: [" in plan
    assert [(r.title, r.dt) for r in one.collect()] == [("T", DAY)]
    whole = plan_of(extract_detail_workua(stored))
    assert whole.count("ArrowEvalPython") == 1


def test_shares_plan_their_input_once(spark, sf_dir):
    plan = plan_of(gold.marts(gold.deduped(views.postings(spark, sf_dir)))["mart_seniority_share"])
    assert plan.count("Exchange hashpartitioning(cross_source_job_key") <= 1 and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_empty_day_writes_nothing(spark, tmp_path):
    params = params_for(tmp_path)
    put(f"{params.bronze}/jobs/source=ithub/dt={DAY}/parsed/search_results.json", [])
    assert run_silver(spark, params, "ithub") is None
    assert not tables.exists(spark, tables.silver_path(params.silver, "ithub"))


def test_failed_check_stops_the_day(spark, tmp_path):
    params = params_for(tmp_path, DQ_MAX_UNKNOWN_RATIO="0.10")
    lake_of_one_day(params.bronze, title="Data Engineer")
    parse_raw(spark, params)
    with pytest.raises(QualityError, match="unknown_seniority_ratio"):
        run_day(spark, params)
    assert not tables.exists(spark, f"{params.gold}/run_metrics")


def test_row_wise_checks_add_no_scan(spark, sf_dir, tmp_path):
    from hirelake.operators.quality import Observed, run_expectations, unique_only

    views.silver(spark, sf_dir, "dou").write.parquet(f"{tmp_path}/in")
    stored = spark.read.parquet(f"{tmp_path}/in")
    checks = gold.staging_expectations("ithub")  # the wrong source, so one check fails on all rows
    expected = sorted(map(tuple, run_expectations(stored, [c for c in checks if c.check != "unique"]).collect()))
    watched = Observed(stored, checks)
    plan = plan_of(watched.frame)
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    watched.frame.write.parquet(f"{tmp_path}/out")
    report = sorted(map(tuple, watched.report().collect()))
    assert report == expected and any(r[3] == stored.count() for r in report)
    assert spark.read.parquet(f"{tmp_path}/out").count() == stored.count()
    assert all(c.check == "unique" for c in unique_only(checks))


def test_ratios_and_counts_are_read_from_the_metrics(spark, sf_dir):
    from datetime import date

    from hirelake.operators.quality import check_ratio_max, checked_metrics, run_metrics

    rows = views.postings(spark, sf_dir)
    metrics = run_metrics({"dou": rows}, rows, date(2026, 3, 14), "r")
    columns = ["check_name", "ratio", "max_ratio", "ok"]
    assert sorted(map(tuple, checked_metrics(metrics, 0.05).select(*columns).collect())) == sorted(
        map(tuple, check_ratio_max(rows, 0.05).select(*columns).collect()))
    empty = run_metrics({"dou": rows.limit(0)}, rows, date(2026, 3, 14), "r")
    with pytest.raises(QualityError, match="dou"):
        checked_metrics(empty)


def test_stale_postings_are_reported(spark, tmp_path, caplog):
    params = params_for(tmp_path, RUN_DATE="2026-03-17")
    lake_of_one_day(params.bronze)
    parse_raw(spark, params)
    with caplog.at_level("WARNING", logger="hirelake.plans.daily"):
        run_day(spark, params)
    assert "freshness of postings on 2026-03-14: error" in caplog.text


def shuffled_bytes(spark, make):
    """Result rows, and the bytes of all shuffles behind them, as the executed plans count them."""
    frame = make()
    rows = sorted(map(repr, frame.collect()))
    plan = frame._jdf.queryExecution().executedPlan()
    total, pending = 0, [plan]
    while pending:
        node = pending.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            pending.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            pending.append(node.plan())
        else:
            if name == "Exchange":
                total += node.metrics().apply("dataSize").value()
            children = node.children()
            pending += [children.apply(i) for i in range(children.size())]
    return rows, total


@pytest.mark.parametrize("repeats", [1, 20])
def test_long_texts_are_not_shuffled_to_rank_stored_rows(spark, tmp_path, repeats, monkeypatch):
    from hirelake.operators import dedup

    long = F.concat_ws(" ", *[F.md5(F.concat("id", F.lit(i)).cast("string")) for i in range(60)])
    uid = F.concat(F.lit("dou::"), (F.col("id") / repeats).cast("int").cast("string"))
    rows = spark.range(2000).select("id", *[
        {"source_job_uid": uid, "page_text": long, "fetched_at": F.lpad((F.col("id") % 97).cast("string"), 2, "0"),
         "company": uid, "title": uid}.get(c, F.lit("x")).alias(c) for c in CLEAN_COLUMNS]).drop("id")
    path = f"{tmp_path}/s"
    tables.write_silver_parquet(rows, path)
    losing, writes = [], dedup.written_once
    monkeypatch.setattr(dedup, "written_once", lambda df, label: losing.append(df) or writes(df, label))
    for operator in (dedup.latest_per_uid, dedup.best_per_cross_source_key):
        losing.clear()
        plain, whole = shuffled_bytes(spark, lambda: operator(tables.scan_clean(spark, path)))
        late, narrow = shuffled_bytes(spark, lambda: operator(tables.scan_clean(spark, path, row_ids=True)))
        narrow += shuffled_bytes(spark, lambda: losing[0])[1]
        assert late == plain
        assert narrow < whole / 2, (operator.__name__, narrow, whole)
    ranked = tables.scan_clean(spark, path, row_ids=True)
    ways = [sorted(map(repr, dedup.first_rank_of_stored(ranked, *dedup._LATEST, limit=n).collect())) for n in (2000, 1999, 0)]
    assert ways[0] == ways[1] == ways[2]  # by the first rows, by the others, and by ranking whole rows
