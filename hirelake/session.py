"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

#: What a batch of pages may hold on its way to Python: a batch ends at either bound, so large pages make short batches.
#: A page beyond the byte bound is a batch of its own.
ARROW_BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    **ARROW_BATCHES,
}


_MIB = 1 << 20


def _bytes(stated: str) -> int:
    """A size as Spark states it: a number, with or without a unit."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([bkmgtp]?)b?\s*", stated.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's bounds of Arrow batches to ARROW_BATCHES, if they are wider or none; tighter ones stay.

    Spark takes these bounds from the session alone, so a step that sends whole pages to Python needs them there.
    """
    for key, most in ARROW_BATCHES.items():
        if not 0 < _bytes(spark.conf.get(key)) <= int(most):
            spark.conf.set(key, most)


def scale_conf(input_bytes: int) -> dict[str, str]:
    """Split and shuffle sizes for an input of so many bytes.

    Scans stay near 200,000 tasks (splits of 128 MiB to 1 GiB), shuffles start from 256 MiB per partition (200 to 100,000
    partitions, so that map times reduce blocks stay countable); AQE merges what turns out small. Beyond 24 TiB the
    number of partitions stays and they grow, to 1 GiB at 100 TiB; nothing else changes and no row is left out.
    """
    split = min(max(input_bytes // 200_000, 128 * _MIB), 1024 * _MIB)
    reducers = min(max(-(-input_bytes // (256 * _MIB)), 200), 100_000)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(reducers),
    }


def build_session(name: str, conf: Mapping[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` as the session states it.

    Where it is unset, a folder in the warehouse. A warehouse on a local disk will do for a local session alone: on a
    cluster each machine would write to a disk of its own, so there the setting is demanded.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    on_cluster = not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    if on_cluster and (urlparse(warehouse).scheme or "file") == "file":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/_intermediate"


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, label: str) -> DataFrame:
    """Store a frame as parquet in the shared folder and read it back.

    Cuts the lineage so that several outputs reuse one computation, survives the loss of executors, and keeps
    column pruning: a reader of two columns reads two columns.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def size_to_input(spark: SparkSession, input_bytes: int) -> None:
    """Set split and shuffle sizes for an input of so many bytes."""
    for key, value in scale_conf(input_bytes).items():
        spark.conf.set(key, value)
