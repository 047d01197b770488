"""Silver and gold tables: versioned days, promotion, keyed upsert, retention, metrics log.

Files are never changed once a manifest names them::

    <silver table>/version=<v>/dt=<day>/    a day as one write left it; the manifest names each day's version
    <upserted table>/batch=<v>/             a batch; the manifest names the batches in order
"""

from __future__ import annotations

import re
import time
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators.project import final_projection
from hirelake.schemas import CLEAN_COLUMNS, CLEAN_SCHEMA
from hirelake.session import shared_dir
from hirelake.sources import files, manifest


def silver_path(root: str, source: str) -> str:
    return f"{root}/{source}_jobs_clean"


def write_silver_parquet(postings: DataFrame, path: str, *, balance: bool = False) -> None:
    """Replace the days present in ``postings``, all in one step; other days stay, and until then so do the old ones.

    The write runs as wide as the plan that feeds it. ``balance=True`` adds a rebalancing shuffle by day first, for
    backfills of many days: few files per day, and a day that holds most rows is split over several tasks.
    """
    rows, version = final_projection(postings), manifest.new_version()
    if balance:
        rows = rows.hint("rebalance", "dt")
    rows.write.partitionBy("dt").parquet(f"{path}/version={version}")
    _show_days(postings.sparkSession, path, version)


def write_silver_day(postings: DataFrame, path: str, day: str) -> None:
    """Replace the run day's postings, whatever day their own ``dt`` names (kept as ``posting_dt``); no other day is
    touched and no row is lost."""
    rows, version = final_projection(postings).withColumnRenamed("dt", "posting_dt"), manifest.new_version()
    rows.write.parquet(f"{path}/version={version}/dt={day}")
    _show_days(postings.sparkSession, path, version)


def _show_days(spark: SparkSession, path: str, version: str) -> None:
    written = [name for name in files.children(spark, f"{path}/version={version}") if name.startswith("dt=")]
    manifest.change(spark, path, lambda state: {**state, **dict.fromkeys(written, version)})


def day_folders(spark: SparkSession, path: str, dt: str | None = None) -> list[str]:
    """The folders that make up a silver table, or one of its days."""
    days = manifest.current(spark, path)
    return [f"{path}/version={v}/{day}" for day, v in sorted(days.items()) if dt is None or day == f"dt={dt}"]


def read_days(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    """The stored rows of a silver table with their ``dt``; with ``dt`` only that day's folder is listed and read.

    A folder without manifest is read as it is, so files of other writers can be scanned too.
    """
    folders = day_folders(spark, path, dt)
    if folders:
        rows = spark.read.option("basePath", path).parquet(*folders).drop("version")
    elif manifest.current(spark, path):
        rows = spark.createDataFrame([], CLEAN_SCHEMA)
    else:
        rows = spark.read.parquet(path)
    return rows if dt is None else rows.where(F.col("dt").cast("string") == dt)


def scan_clean(spark: SparkSession, path: str, dt: str | None = None, *, row_ids: bool = False) -> DataFrame:
    """A silver table with its 19 columns as text; ``dt`` prunes to one day, ``row_ids`` names each row by file and number."""
    rows = read_days(spark, path, dt)
    if not row_ids:
        return final_projection(rows)
    return final_projection(with_row_ids(rows), [*CLEAN_COLUMNS, "_file", "_row"])


def with_row_ids(rows: DataFrame) -> DataFrame:
    """Rows read from parquet files with the file and the number that name each (``dedup.ROW_IDS``)."""
    return rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def promote_replace(spark: SparkSession, table: str, staged_path: str) -> None:
    """Make staged files the content of a catalog name in one step.

    The name is a view over the files: a folder of them, a stored day (``…/dt=<day>``), or a silver table as its manifest
    shows it now. Replacing it is one change in the catalog, so readers see the old content or the new, and no byte is
    copied whatever the size. The staged columns must be the 19, in any order (``posting_dt`` may stand beside them),
    and the path must not be the one that the name shows already.
    """
    folders = day_folders(spark, staged_path) or [staged_path]
    parts = []
    for folder in folders:
        staged = spark.read.parquet(folder)
        own_day = re.search(r"/dt=([^/]*)/*$", folder) if "dt" not in staged.columns else None
        columns = {*staged.columns, *(["dt"] if own_day else [])} - {"posting_dt"}
        if columns != set(CLEAN_COLUMNS):
            raise ValueError(f"staged columns differ from the table's: {staged.columns}")
        named = {c: f"CAST({c} AS STRING) AS {c}" for c in CLEAN_COLUMNS}
        if own_day:
            day = unquote(own_day.group(1))
            named["dt"] = "CAST(NULL AS STRING) AS dt" if day == "__HIVE_DEFAULT_PARTITION__" else f"'{day}' AS dt"
        parts.append(f"SELECT {', '.join(named.values())} FROM parquet.`{folder}`")
    # enough to see one row of one folder
    if all(spark.read.parquet(folder).isEmpty() for folder in folders):
        raise ValueError(f"nothing staged at {staged_path}")
    if all(f"parquet.`{folder}`" in _view_text(spark, table) for folder in folders):
        raise ValueError(f"{staged_path} is what {table} shows already; stage to a new path")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS {' UNION ALL '.join(parts)}")


def _view_text(spark: SparkSession, name: str) -> str:
    if not spark.catalog.tableExists(name):
        return ""
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()
    return row["data_type"] if row else ""


# --- keyed upsert: immutable batches ----------------------------------------------------------------------------


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, key: str) -> None:
    """Add a batch whose rows replace all earlier rows of their keys. Writes the batch and nothing else.

    Any number of writers may add batches at a time: each batch is shown, and of one key the batch shown last counts.
    """
    _check_key(manifest.current(spark, path), key)
    name = manifest.new_version()
    batch.write.parquet(f"{path}/batch={name}")

    def added(state: dict) -> dict:
        _check_key(state, key)
        return {"key": key, "batches": [*state.get("batches", []), name]}

    manifest.change(spark, path, added)


def _check_key(state: dict, key: str) -> None:
    if state and state["key"] != key:
        raise ValueError(f"the table's key is {state['key']}, not {key}")


def _latest(spark: SparkSession, path: str, state: dict, row_ids: bool = False) -> DataFrame:
    key, batches = state["key"], state["batches"]
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch={b}" for b in batches])
    if row_ids:
        rows = with_row_ids(rows)
    if len(batches) == 1:
        return rows.drop("batch")
    rows = rows.withColumn("_place", F.array_position(F.array(*map(F.lit, batches)), F.col("batch")))
    ranked = rows.where(F.col(key).isNotNull()).withColumn("_rank", F.expr(f"rank() OVER (PARTITION BY {key} ORDER BY _place DESC)"))
    # no key, no replacement: such rows are not the same row, and they meet in no task
    unkeyed = rows.where(F.col(key).isNull())
    return ranked.where("_rank = 1").drop("_rank").unionByName(unkeyed).drop("_place", "batch")


def read_upserted(spark: SparkSession, path: str, *, row_ids: bool = False) -> DataFrame:
    """For each key the rows of its latest batch, and all rows without key; ``row_ids`` names each row by file and number."""
    return _latest(spark, path, manifest.current(spark, path), row_ids)


def compact_table(spark: SparkSession, path: str) -> None:
    """Store the current rows as one batch in place of theirs. Batches added meanwhile stay behind it."""
    state = manifest.current(spark, path)
    old = state.get("batches", [])
    if len(old) < 2:
        return
    name = manifest.new_version()
    _latest(spark, path, state).write.parquet(f"{path}/batch={name}")

    def swapped(now: dict) -> dict | None:
        if now["batches"][: len(old)] != old:
            return None  # another compaction was first
        return {**now, "batches": [name, *now["batches"][len(old):]]}

    manifest.change(spark, path, swapped)


def stored_batches(spark: SparkSession, path: str) -> int:
    return len(manifest.current(spark, path).get("batches", []))


# --- retention ---------------------------------------------------------------------------------------------------


def shown_by_views(spark: SparkSession, database: str | None) -> str:
    """The texts of all views of a database, in which the folders that they show are named."""
    if database is None:
        return ""
    found = spark.catalog.listTables(database)
    names = [t.name for t in found if t.tableType == "VIEW" and not t.isTemporary]
    return "\n".join(_view_text(spark, f"{database}.{n}") for n in names)


def clear_table(spark: SparkSession, path: str, keep_seconds: float, view_texts: str = "") -> list[str]:
    """Delete generations of a silver or upserted table that neither a recent manifest nor a view shows."""
    named = {n for n in files.children(spark, path) if f"{path}/{n}/" in view_texts or f"{path}/{n}`" in view_texts}

    def shown(state: dict) -> set[str]:
        if "batches" in state:
            return {f"batch={b}" for b in state["batches"]}
        return {f"version={v}" for v in state.values()}

    return manifest.clear(spark, path, shown, keep_seconds, named)


def clear_intermediate(spark: SparkSession, keep_seconds: float, view_texts: str = "") -> list[str]:
    """Delete intermediate tables of the shared folder that are older than that and that no view shows.

    Only names that :func:`~hirelake.session.fresh_dir` makes are touched. ``keep_seconds`` must exceed the longest run.
    """
    folder, limit = shared_dir(spark), time.time() - keep_seconds
    gone = [
        name for name, changed in files.children(spark, folder).items()
        if re.fullmatch(r"[a-z0-9_-]+-[0-9a-f]{32}", name) and changed <= limit and f"{folder}/{name}" not in view_texts
    ]
    for name in gone:
        files.delete(spark, f"{folder}/{name}")
    return gone


def materialize(df: DataFrame, name: str, kind: str = "view") -> None:
    """A named view (evaluated by its readers) or a stored table (evaluated now)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"unknown kind: {kind}")


def append_run_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)
