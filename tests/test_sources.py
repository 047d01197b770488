import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hirelake.params import JdbcTarget, RunParams
from hirelake.schemas import CLEAN_COLUMNS
from hirelake.session import fresh_dir, scale_conf, shared_dir, written_once
from hirelake.sources import files, lake, manifest, tables, warehouse
from tests.test_operators import postings


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False))


def test_read_cards_globs_queries_and_pages(spark, tmp_path):
    root = str(tmp_path)
    for query, page in (("a", 1), ("a", 2), ("b", 1)):
        put(f"{root}/jobs/source=workua/query={query}/dt=2026-03-14/parsed/search_results_page_{page}.json",
            [{"job_url": f"{query}{page}", "dt": "2026-03-14", "page": page}, {"job_url": None, "extra": 1}])
    cards = lake.read_cards(spark, root, "workua", "2026-03-14")
    assert cards.count() == 6 and {r.job_url for r in cards.collect()} == {"a1", "a2", "b1", None}
    assert cards.where("snippet IS NOT NULL").count() == 0


def test_positions_do_not_depend_on_splits(spark, tmp_path):
    """Line-delimited files of several splits and lists of several files: places in the file, own positions stay."""
    lines = [[{"job_url": f"{f}/{i}", "snippet": "x" * 50, **({"position": 7} if i == 3 else {})} for i in range(n)]
             for f, n in enumerate((500, 90, 2000))]
    for f, cards in enumerate(lines):
        put(f"{tmp_path}/lines/{f}.json", "\n".join(map(json.dumps, cards)) + "\n")
        put(f"{tmp_path}/lists/{f}.json", cards)
    expected = {c["job_url"]: c.get("position", i) for cards in lines for i, c in enumerate(cards)}
    sizes = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("4096", "30000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
            for form in ("lines", "lists"):
                cards = lake.read_cards(spark, "", "workua", "", lines=form == "lines", path=f"{tmp_path}/{form}")
                assert {r.job_url: r.position for r in cards.collect()} == expected
                assert cards.count() == len(expected)
                assert "Join" not in cards.select("job_url")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for key, value in sizes.items():
            spark.conf.set(key, value)


def test_empty_list_and_missing_array_column(spark, tmp_path):
    path = f"{tmp_path}/jobs/source=ithub/dt=2026-03-14/parsed/search_results.json"
    put(path, [])
    cards = lake.read_cards(spark, str(tmp_path), "ithub", "2026-03-14")
    assert not lake.has_rows(cards) and dict(cards.dtypes)["skills_raw"] == "array<string>"
    put(path, [{"job_url": "u"}])
    cards = lake.read_cards(spark, str(tmp_path), "ithub", "2026-03-14")
    assert cards.head().skills_raw is None and lake.has_rows(cards) and not lake.has_rows(cards, cards.limit(0))


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        lake.read_details(spark, str(tmp_path), "dou", "2026-03-14")


def test_html_pages(spark, tmp_path):
    root = str(tmp_path)
    for name in ("12", "companies_x_vacancies_1"):
        put(f"{root}/jobs/source=dou/details_raw/dt=2026-03-14/job_{name}.html", f"<h1>{name}</h1>\n<p>ї</p>\n")
    pages = lake.read_html_pages(spark, root, "dou", "2026-03-14").orderBy("job_id").collect()
    assert [r.job_id for r in pages] == ["12", "companies_x_vacancies_1"]
    assert pages[0].html == "<h1>12</h1>\n<p>ї</p>\n" and pages[0].dt == "2026-03-14"


def test_parsed_pages_replace_only_their_day(spark, tmp_path):
    root = str(tmp_path)

    def write(dt, title):
        row = spark.createDataFrame([("1", title, "dou", dt)], "job_id string, title string, source string, dt string")
        lake.write_parsed_pages(row, root, "dou")

    write("2026-03-14", "a")
    write("2026-03-15", "b")
    write("2026-03-15", "c")
    rows = lake.read_parsed_pages(spark, root, "dou").orderBy("dt").collect()
    assert [(r.dt, r.title) for r in rows] == [("2026-03-14", "a"), ("2026-03-15", "c")]
    one = lake.read_parsed_pages(spark, root, "dou").where("dt = '2026-03-15'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull" in one._jdf.queryExecution().executedPlan().toString()
    day = lake.read_details(spark, root, "dou", "2026-03-15").collect()
    assert [(r.job_id, r.title, r.source, r.dt) for r in day] == [("1", "c", "dou", "2026-03-15")]


def test_details_as_one_object_per_file(spark, tmp_path):
    for i in (1, 2):
        path = f"{tmp_path}/jobs/source=workua/details_parsed/dt=2026-03-14/job_{i}.json"
        put(path, json.dumps({"job_id": str(i), "experience_text": "x", "dt": "2026-03-14"}, indent=2))
    details = lake.read_details(spark, str(tmp_path), "workua", "2026-03-14").orderBy("job_id").collect()
    assert [(r.job_id, r.experience_text, r.dt, r.title) for r in details] == [
        ("1", "x", "2026-03-14", None), ("2", "x", "2026-03-14", None),
    ]


def test_silver_partitions(spark, tmp_path):
    path = tables.silver_path(str(tmp_path), "dou")
    tables.write_silver_parquet(postings(spark, dict(source_job_uid="a", dt="2026-03-14")), path)
    tables.write_silver_parquet(postings(spark, dict(source_job_uid="b", dt="2026-03-15")), path)
    tables.write_silver_parquet(postings(spark, dict(source_job_uid="c", dt="2026-03-15")), path, balance=True)
    assert sorted(r.source_job_uid for r in tables.scan_clean(spark, path).collect()) == ["a", "c"]
    one = tables.scan_clean(spark, path, "2026-03-14")
    assert one.columns == CLEAN_COLUMNS and {t for _, t in one.dtypes} == {"string"} and one.head().dt == "2026-03-14"
    assert "PartitionFilters: [" in one._jdf.queryExecution().executedPlan().toString()
    narrow = one.select("skills")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<skills:string>" in narrow


def test_promote_replace(spark, tmp_path):
    good = postings(spark, dict(source_job_uid="a"))
    good.write.parquet(f"{tmp_path}/v1")
    postings(spark, dict(source_job_uid="b")).write.parquet(f"{tmp_path}/v2")
    good.drop("skills").write.parquet(f"{tmp_path}/wrong")
    good.limit(0).write.parquet(f"{tmp_path}/empty")
    tables.promote_replace(spark, "promoted", f"{tmp_path}/v1")
    tables.promote_replace(spark, "promoted", f"{tmp_path}/v2")
    assert [r.source_job_uid for r in spark.table("promoted").collect()] == ["b"]
    tables.write_silver_parquet(good.withColumn("dt", F.lit("2026-03-14")), f"{tmp_path}/days")
    tables.promote_replace(spark, "promoted", f"{tmp_path}/days")  # the versioned layout
    assert spark.table("promoted").columns == CLEAN_COLUMNS
    assert [(r.source_job_uid, r.dt) for r in spark.table("promoted").collect()] == [("a", "2026-03-14")]
    tables.promote_replace(spark, "promoted", f"{tmp_path}/v2")
    for bad in ("wrong", "empty", "v2"):  # the last is no fresh path
        with pytest.raises(ValueError):
            tables.promote_replace(spark, "promoted", f"{tmp_path}/{bad}")
    assert [r.source_job_uid for r in spark.table("promoted").collect()] == ["b"]
    spark.sql("DROP VIEW promoted")


def test_upsert_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.upsert_table(spark, path, spark.createDataFrame([(f"k{i}", 1) for i in range(50)], "k string, v int"), "k")
    batch = spark.createDataFrame([("k3", 2), ("new", 2)], "k string, v int")
    before = files_of(path)
    tables.upsert_table(spark, path, batch, "k")
    assert before == {f: t for f, t in files_of(path).items() if f in before}  # no older file is rewritten
    first = sorted(map(tuple, tables.read_upserted(spark, path).collect()))
    assert len(first) == 51 and ("k3", 2) in first and ("k3", 1) not in first
    tables.upsert_table(spark, path, batch, "k")
    assert sorted(map(tuple, tables.read_upserted(spark, path).collect())) == first
    before = files_of(path)
    tables.compact_table(spark, path)
    assert before.items() <= files_of(path).items() and tables.stored_batches(spark, path) == 1
    assert sorted(map(tuple, tables.read_upserted(spark, path).collect())) == first
    batch.write.parquet(f"{path}/batch={manifest.new_version()}")  # a run that stopped before its commit
    assert sorted(map(tuple, tables.read_upserted(spark, path).collect())) == first
    with pytest.raises(ValueError, match="key is k"):
        tables.upsert_table(spark, path, batch, "v")


def files_of(path):
    found = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part")]
    return {f: os.stat(f).st_mtime_ns for f in found}


def test_a_day_keeps_all_its_rows_and_touches_no_other(spark, tmp_path):
    path = f"{tmp_path}/s"
    tables.write_silver_day(postings(spark, dict(source_job_uid="old", dt="2026-03-14")), path, "2026-03-14")
    mixed = [dict(source_job_uid="a", dt=None), dict(source_job_uid="b", dt="2026-03-14"), dict(source_job_uid="c", dt="2026-03-15")]
    tables.write_silver_day(postings(spark, *mixed), path, "2026-03-15")
    assert sorted(r.source_job_uid for r in tables.scan_clean(spark, path, "2026-03-15").collect()) == ["a", "b", "c"]
    assert [r.source_job_uid for r in tables.scan_clean(spark, path, "2026-03-14").collect()] == ["old"]
    assert {r.posting_dt for r in tables.read_days(spark, path, "2026-03-15").collect()} == {None, "2026-03-14", "2026-03-15"}


def test_a_broken_write_leaves_the_old_day_readable(spark, tmp_path):
    path = f"{tmp_path}/s"
    tables.write_silver_day(postings(spark, dict(source_job_uid="old")), path, "2026-03-14")
    reader = tables.scan_clean(spark, path, "2026-03-14")
    rows = postings(spark, *[dict(source_job_uid=f"n{i}") for i in range(40)]).repartition(8)
    broken = rows.withColumn("title", F.expr("IF(source_job_uid = 'n39', raise_error('lost'), title)"))
    for write in (
        lambda: tables.write_silver_day(broken, path, "2026-03-14"),
        lambda: tables.write_silver_parquet(broken.withColumn("dt", F.lit("2026-03-14")), path),
    ):
        with pytest.raises(Exception, match="lost"):
            write()
        assert [r.source_job_uid for r in tables.scan_clean(spark, path, "2026-03-14").collect()] == ["old"]
    tables.write_silver_day(rows, path, "2026-03-14")
    assert tables.scan_clean(spark, path, "2026-03-14").count() == 40
    assert [r.source_job_uid for r in reader.collect()] == ["old"]  # a reader that began before keeps its files


def test_interleaved_writers_lose_no_row(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    frame = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    tables.upsert_table(spark, path, frame(("a", 1), (None, 1)), "k")
    create, others = files.create_absent, [("b", 2), ("c", 3)]

    def late(spark, target, text):
        """Another writer commits between this one's look at the table and its own commit."""
        if others:
            tables_row = others.pop()
            tables.upsert_table(spark, path, frame(tables_row), "k")
        return create(spark, target, text)

    monkeypatch.setattr(files, "create_absent", late)
    tables.upsert_table(spark, path, frame(("a", 9), (None, 9)), "k")
    monkeypatch.undo()
    got = sorted(map(tuple, tables.read_upserted(spark, path).collect()), key=repr)
    assert got == sorted([("a", 9), ("b", 2), ("c", 3), (None, 1), (None, 9)], key=repr)

    def meanwhile(spark, target, text):
        monkeypatch.undo()
        tables.upsert_table(spark, path, frame(("b", 7)), "k")
        return create(spark, target, text)

    monkeypatch.setattr(files, "create_absent", meanwhile)
    tables.compact_table(spark, path)  # a batch arrives while the others are compacted
    assert tables.stored_batches(spark, path) == 2
    got = sorted(map(tuple, tables.read_upserted(spark, path).collect()), key=repr)
    assert got == sorted([("a", 9), ("b", 7), ("c", 3), (None, 1), (None, 9)], key=repr)


def test_writers_at_the_same_time(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = f"{tmp_path}/t"
    write = lambda i: tables.upsert_table(spark, path, spark.createDataFrame([(f"k{i}", i), ("all", i)], "k string, v int"), "k")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write, range(12)))
    assert tables.stored_batches(spark, path) == 12
    rows = {r.k: r.v for r in tables.read_upserted(spark, path).collect()}
    last = tables.read_upserted(spark, path).where("k = 'all'").count()
    assert set(rows) == {f"k{i}" for i in range(12)} | {"all"} and last == 1


def test_clear_removes_old_generations_and_no_shown_one(spark, tmp_path):
    path, upserted = f"{tmp_path}/s", f"{tmp_path}/u"
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    for uid in ("first", "second", "third"):
        tables.write_silver_day(postings(spark, dict(source_job_uid=uid)), path, "2026-03-14")
        if uid == "first":
            tables.promote_replace(spark, "kept.shown", tables.day_folders(spark, path)[0])
    for v in (1, 2):
        tables.upsert_table(spark, upserted, spark.createDataFrame([("a", v)], "k string, v int"), "k")
    tables.compact_table(spark, upserted)
    texts = tables.shown_by_views(spark, "kept")
    assert tables.clear_table(spark, path, 3600, texts) == [] and tables.clear_table(spark, upserted, 3600) == []  # too young
    assert len(tables.clear_table(spark, path, -1, texts)) == 1  # the second; the first is shown by a name
    assert len(tables.clear_table(spark, upserted, -1)) == 2
    assert [r.source_job_uid for r in spark.table("kept.shown").collect()] == ["first"]
    assert [r.source_job_uid for r in tables.scan_clean(spark, path).collect()] == ["third"]
    assert [tuple(r) for r in tables.read_upserted(spark, upserted).collect()] == [("a", 2)]
    tables.promote_replace(spark, "kept.shown", path)
    assert len(tables.clear_table(spark, path, -1, tables.shown_by_views(spark, "kept"))) == 1
    assert [r.source_job_uid for r in spark.table("kept.shown").collect()] == ["third"]
    spark.sql("DROP DATABASE kept CASCADE")


def test_clear_removes_old_intermediate_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "shared_dir", lambda spark: str(tmp_path))
    names = [f"deduped-{'0' * 31}{i}" for i in (1, 2)] + ["someone-elses"]
    for n in names:
        os.makedirs(f"{tmp_path}/{n}")
    assert tables.clear_intermediate(spark, 3600) == []
    assert tables.clear_intermediate(spark, -1, f"SELECT 1 FROM parquet.`{tmp_path}/{names[0]}`") == [names[1]]
    assert sorted(os.listdir(tmp_path)) == sorted([names[0], names[2]])


def test_malformed_json_raises(spark, tmp_path):
    folder = f"{tmp_path}/jobs/source=dou/dt=2026-03-14/parsed"
    os.makedirs(folder)
    with open(f"{folder}/search_results.json", "w") as f:
        f.write('[{"job_url": "u"}, {"job_url": ')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        lake.read_cards(spark, str(tmp_path), "dou", "2026-03-14").collect()


def test_sizes_come_from_the_days_own_files(spark, tmp_path):
    def day(dt, kb):
        put(f"{tmp_path}/jobs/source=dou/dt={dt}/parsed/search_results.json", "x" * 1024 * kb)
        put(f"{tmp_path}/jobs/source=dou/dt={dt}/raw/search_page_1.html", "x" * 1024)
        put(f"{tmp_path}/jobs/source=dou/details_raw/dt={dt}/job_1.html", "x" * 1024)
        put(f"{tmp_path}/jobs/source=dou/details_parsed/dt={dt}/part-1.json", "x" * 1024)
        put(f"{tmp_path}/jobs/source=workua/query=q/dt={dt}/parsed/search_1.json", "x" * 1024)
        put(f"{tmp_path}/jobs/source=workua/query=r/dt={dt}/raw/search_page_1.html", "x" * 1024)

    def size():
        return files.size_of(spark, *[g for s in ("dou", "workua") for g in lake.day_inputs(str(tmp_path), s, "2026-03-14")])

    day("2026-03-14", 2)
    before = size()
    assert before == 7 * 1024
    patterns = lake.day_inputs(str(tmp_path), "dou", "2026-03-14")
    assert all("dt=2026-03-14" in p for p in patterns)  # nothing above the day is listed
    for older in ("2026-03-12", "2026-03-13"):
        day(older, 500)
    assert size() == before
    assert files.size_of(spark, f"{tmp_path}/nothing/*") == 0


def test_a_local_folder_is_refused_on_a_cluster(spark):
    class Other:
        def __init__(self, master, warehouse, configured=None):
            self.conf = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": configured}
            self.sparkContext = self
            self.master = master

        def getCheckpointDir(self):
            return None

    assert shared_dir(Other("local[8]", "/w")) == shared_dir(Other("local", "/w/")) == "/w/_intermediate"
    assert shared_dir(Other("spark://h:1", "hdfs://n/w")) == "hdfs://n/w/_intermediate"
    assert shared_dir(Other("yarn", "/w", "hdfs://n/c/")) == "hdfs://n/c"
    for master, warehouse in (("yarn", "file:/w"), ("local-cluster[2,1,1024]", "/w")):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Other(master, warehouse))


def test_materialize_and_metrics(spark, tmp_path):
    df = spark.range(3)
    tables.materialize(df, "a_view")
    tables.materialize(df, "a_table", "table")
    assert spark.table("a_view").count() == spark.table("a_table").count() == 3
    tables.materialize(df.limit(1), "a_table", "table")
    assert spark.table("a_table").count() == 1
    with pytest.raises(ValueError):
        tables.materialize(df, "x", "cube")
    spark.sql("DROP TABLE a_table")
    tables.append_run_metrics(df, f"{tmp_path}/m")
    tables.append_run_metrics(df, f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/m").count() == 6


def test_jdbc_options_keep_the_table_definition():
    target = JdbcTarget("jdbc:postgresql://h:5432/d", "u", "secret")
    options = warehouse.jdbc_options(target, "dou_jobs_clean__staging", 4)
    assert options["truncate"] == "true" and options["dbtable"] == "public.dou_jobs_clean__staging"
    assert options["numPartitions"] == "4" and "secret" not in repr(target)


class FakeJvm:
    """Stands in for the JVM's driver manager and records what a promotion does."""

    def __init__(self, fail=False):
        self.calls, self.fail = [], fail
        self._jvm = self.java = self.sql = self.DriverManager = self
        self.org = self.apache = self.spark = self.execution = self.datasources = self.jdbc = self.DriverRegistry = self

    def register(self, driver):
        self.calls.append(f"register {driver}")

    def getConnection(self, *args):
        return self

    def createStatement(self):
        return self

    def setAutoCommit(self, on):
        self.calls.append(f"auto={on}")

    def execute(self, sql):
        self.calls.append(sql.split(" (")[0])
        if self.fail and sql.startswith("INSERT"):
            raise RuntimeError("no")

    def __getattr__(self, name):
        return lambda: self.calls.append(name)


def test_promotion_is_one_transaction():
    target = JdbcTarget("url", "u", "p")
    ok, broken = FakeJvm(), FakeJvm(fail=True)
    warehouse.promote_in_warehouse(ok, target, "t", "t__staging")
    assert ok.calls == ["register org.postgresql.Driver", "auto=False", "TRUNCATE TABLE public.t", "INSERT INTO public.t", "commit", "close"]
    with pytest.raises(RuntimeError):
        warehouse.promote_in_warehouse(broken, target, "t", "t__staging")
    assert broken.calls[-2:] == ["rollback", "close"] and "commit" not in broken.calls


def test_params():
    settings = {"DS": "2026-03-14", "BRONZE_PATH": "b", "SILVER_PATH": "s", "GOLD_PATH": "g"}
    params = RunParams.from_settings(settings)
    assert params.max_unknown_ratio == 0.80 and params.run_date.isoformat() == "2026-03-14" and params.jdbc is None
    with pytest.raises(ValueError, match="GOLD_PATH"):
        RunParams.from_settings({k: v for k, v in settings.items() if k != "GOLD_PATH"})
    full = RunParams.from_settings(
        {**settings, "S3_ENDPOINT": "http://s3", "S3_ACCESS_KEY": "a", "S3_SECRET_KEY": "k", "PG_HOST": "h", "PG_DB": "d",
         "PG_USER": "u", "PG_PASSWORD": "p", "DQ_MAX_UNKNOWN_RATIO": "0.5"}
    )
    assert full.spark_conf["spark.hadoop.fs.s3a.endpoint"] == "http://s3" and full.max_unknown_ratio == 0.5
    assert full.jdbc.url == "jdbc:postgresql://h:5432/d" and full.jdbc.table("t") == "public.t"


def test_sizes_follow_the_input():
    sizes = [[int(v) for v in scale_conf(b).values()] for b in (10**9, 10**12, 10**14)]
    assert sizes == [[134217728, 200], [134217728, 3726], [500000000, 100_000]]
    params = RunParams.from_settings({"DS": "2026-03-14", "BRONZE_PATH": "b", "SILVER_PATH": "s", "GOLD_PATH": "g", "INPUT_BYTES": "1000"})
    assert params.spark_conf["spark.sql.shuffle.partitions"] == "200"


def test_shared_folder_and_written_once(spark):
    assert fresh_dir(spark, "x").startswith(shared_dir(spark)) and fresh_dir(spark, "x") != fresh_dir(spark, "x")
    stored = written_once(spark.range(5).selectExpr("id", "id * 2 AS d"), "once")
    assert stored.count() == 5 and "ReadSchema: struct<id:bigint>" in stored.select("id")._jdf.queryExecution().executedPlan().toString()
