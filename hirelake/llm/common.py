"""What the operators of this subpackage share: reading columns, size-checked joins, stable row orders."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.session import written_once

#: Rows of narrow keys that a broadcast may hold (about 64 MB as a hash table); more rows are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, as ``doc_id`` (long) and ``text``; other columns cannot clash."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no further than that."""
    return df.limit(limit + 1).count() <= limit


def without_ids(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``dropped`` (stored, one column ``dropped_id``).

    Few ids are broadcast, so no text moves; beyond :data:`BROADCAST_ROWS` both sides are shuffled. Null ids compare
    as equal.
    """
    ids = dropped.select("dropped_id").distinct()
    right = F.broadcast(ids) if small(dropped) else ids
    return docs.join(right, docs[id_col].eqNullSafe(right["dropped_id"]), "left_anti")


def shared_ids(result: DataFrame) -> DataFrame:
    """Ids (null included) that several rows of ``result`` bear, as stored ``dropped_id``; none where ids are a key."""
    twice = result.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return written_once(twice.select(F.col("doc_id").alias("dropped_id")), "shared-ids")


def with_ids(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is in ``wanted`` (stored, one column ``dropped_id``), null ids included."""
    right = F.broadcast(wanted) if small(wanted) else wanted
    return docs.join(right, docs[id_col].eqNullSafe(right["dropped_id"]), "left_semi")


def spread(column: Column, buckets: int, salt: int = 0) -> Column:
    """An even bucket number for any value, null included."""
    return F.pmod(F.xxhash64(column, F.lit(salt)), F.lit(buckets)).cast("int")


def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and UTF-8 texts of each Arrow batch; a null text is empty."""
    for batch in batches:
        yield batch.column(0).to_pylist(), utf8(batch.column(1))


def utf8(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
