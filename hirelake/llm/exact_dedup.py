"""Exact duplicates by counting quotient filters, merged by sorted remainders, then verified byte by byte.

1. One pass over the texts takes a 64-bit fingerprint of each normalised text (narrow rows, stored).
2. Each task builds counting quotient filters of its fingerprints: the high bits (quotient) choose a slot, the low bits
   are kept as a sorted list of remainders with a counter each. A fingerprint is one entry of its task's filter, however
   many copies there are, so a hot text costs a reducer one entry for each task.
3. Slots of all filters merge by quotient: sorted remainders are joined and counters added, which loses nothing.
4. Only documents whose fingerprint counts above one go to verification, which groups by the normalised bytes
   themselves, with partial groups before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import (
    BROADCAST_ROWS, id_and_text, run_starts, shared_ids, small, utf8, with_ids, without_ids,
)
from hirelake.session import written_once

#: White space that the comparison ignores: space and U+0009 to U+000D.
WHITE_SPACE = b" \t\n\x0b\x0c\r"
#: Entries of one filter; a task with more fingerprints emits several filters, which merge like those of several tasks.
FILTER_ENTRIES = 4_000_000
#: Fingerprints that one merged slot holds on average.
SLOT_ENTRIES = 1 << 12

_PRINTS = "doc_id long, n_points long, fingerprint long, text_sha256 string"
_SLOTS = "quotient long, remainders binary, counts binary"


def normalised(text: bytes) -> bytes:
    return text.translate(None, WHITE_SPACE)


def _prints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = utf8(batch.column(1))
        short = [normalised(t) for t in raw]
        yield pa.record_batch({
            "doc_id": batch.column(0),
            "n_points": pa.array([len(t.decode()) for t in raw], pa.int64()),
            "fingerprint": pa.array(np.array([xxhash.xxh64_intdigest(t) for t in short], np.uint64).view(np.int64)),
            "text_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in short], pa.string()),
        })


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_points`` (code points of the text), ``fingerprint``, ``text_sha256`` (of the normalised text)."""
    return docs.mapInArrow(_prints, _PRINTS)


def _filter_slots(prints: np.ndarray, bits: int) -> pa.RecordBatch:
    """A counting quotient filter as rows: one per occupied slot, remainders ascending, a counter for each."""
    entries, counts = np.unique(prints.view(np.uint64), return_counts=True)
    quotients = entries >> np.uint64(64 - bits)
    remainders = entries & np.uint64((1 << (64 - bits)) - 1)
    starts = run_starts(quotients)
    ends = np.append(starts[1:], len(entries))
    cut = lambda values: [values[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    return pa.record_batch({
        "quotient": pa.array(quotients[starts].astype(np.int64)),
        "remainders": pa.array(cut(remainders), pa.binary()),
        "counts": pa.array(cut(counts.astype(np.int64)), pa.binary()),
    })


def partition_filters(prints: DataFrame, bits: int) -> DataFrame:
    """The filters of all tasks, built over the column ``fingerprint``."""

    def build(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            n += len(held[-1])
            if n >= FILTER_ENTRIES:
                yield _filter_slots(np.concatenate(held), bits)
                held, n = [], 0
        if n:
            yield _filter_slots(np.concatenate(held), bits)

    return prints.select("fingerprint").mapInArrow(build, _SLOTS)


def merged(filters: DataFrame, bits: int) -> DataFrame:
    """All filters as one: ``fingerprint, copies`` for each entry, by merging a slot's sorted remainders."""

    def merge(slot: pd.DataFrame) -> pd.DataFrame:
        remainders = np.frombuffer(b"".join(slot["remainders"]), np.uint64)
        counts = np.frombuffer(b"".join(slot["counts"]), np.int64)
        order = np.argsort(remainders, kind="stable")  # runs are sorted already, so this is a merge
        remainders, counts = remainders[order], counts[order]
        starts = run_starts(remainders)
        quotient = np.uint64(slot["quotient"].iloc[0]) << np.uint64(64 - bits)
        return pd.DataFrame({
            "fingerprint": (remainders[starts] | quotient).view(np.int64),
            "copies": np.add.reduceat(counts, starts),
        })

    return filters.groupBy("quotient").applyInPandas(merge, "fingerprint long, copies long")


def _only(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Normalised bytes of the documents whose fingerprint is in ``repeated`` (stored).

    Up to BROADCAST_ROWS fingerprints are broadcast by Spark (64 MB at most), so that texts are sifted where they are
    read; beyond that, texts and fingerprints are joined by a shuffle.
    """

    def keyed(batches):
        for batch in batches:
            raw = utf8(batch.column(1))
            short = [normalised(t) for t in raw]
            yield pa.record_batch({
                "fingerprint": pa.array(np.array([xxhash.xxh64_intdigest(t) for t in short], np.uint64).view(np.int64)),
                "bytes": pa.array(short, pa.binary()),
                "doc_id": batch.column(0),
                "n_points": pa.array([len(t.decode()) for t in raw], pa.int64()),
            })

    rows = docs.mapInArrow(keyed, "fingerprint long, bytes binary, doc_id long, n_points long")
    wanted = repeated.select("fingerprint")
    return rows.join(F.broadcast(wanted) if small(repeated) else wanted, "fingerprint", "left_semi")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row for each row of ``docs``.

    Texts are equal when identical without white space. Of equal texts the longest original stays, then the smallest
    id. A null text is empty, and all empty texts are one group. A null id loses against any other; a group that has
    no other keeps null. Rows repeated under one id are all marked as kept if that id stays
    (:func:`without_copies` leaves one). An empty table gives no rows.
    """
    docs = id_and_text(docs, id_col, text_col)
    prints = written_once(fingerprints(docs), "dedup-prints")
    rows = prints.count()
    bits = min(32, max(8, (rows // SLOT_ENTRIES).bit_length()))
    counted = merged(partition_filters(prints, bits), bits)
    repeated = written_once(counted.where("copies > 1").select("fingerprint"), "dedup-repeated")
    groups = (
        _only(docs, repeated)
        .groupBy("fingerprint", "bytes")
        .agg(F.count(F.lit(1)).alias("group_size"),
             F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("reversed"))).alias("first"))
        .where("group_size > 1")
        .select(
            F.sha2("bytes", 256).alias("text_sha256"), "group_size",
            F.bitwise_not("first.reversed").alias("keep_id"), F.lit(True).alias("grouped"),
        )
    )
    groups = written_once(groups, "dedup-groups")
    alone = F.col("grouped").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return prints.join(groups, "text_sha256", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    Where several rows share an id, or have none, id and text together tell which rows go; of rows that agree in both
    the longest stays.
    """
    result = written_once(exact_dedup(docs, id_col, text_col), "dedup-result")
    shared = shared_ids(result)
    dropped = result.where("not kept").select(F.col("doc_id").alias("dropped_id"))
    if shared.isEmpty():
        return without_ids(docs, dropped, id_col)
    left = without_ids(docs, written_once(dropped.unionAll(shared), "dedup-dropped"), id_col)
    stays = with_ids(result.where("kept"), shared).select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_text")).distinct()
    digest = F.sha2(F.translate(F.coalesce(docs[text_col].cast("string"), F.lit("")), WHITE_SPACE.decode(), "").cast("binary"), 256)
    rows = with_ids(docs, shared, id_col).select(F.struct(*docs.columns).alias("row"), digest.alias("digest"))
    size = F.length(F.col("row")[text_col].cast("string"))
    rows = rows.join(stays, rows["row"][id_col].cast("long").eqNullSafe(stays["kept_id"]) & (rows["digest"] == stays["kept_text"]))
    once = rows.groupBy("kept_id", "kept_text").agg(F.max_by("row", F.coalesce(size, F.lit(0))).alias("row"))
    return left.unionByName(once.select("row.*"))


__all__ = ["BROADCAST_ROWS", "exact_dedup", "fingerprints", "merged", "partition_filters", "without_copies"]
