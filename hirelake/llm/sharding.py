"""Balanced label propagation: documents linked by equal texts move towards their neighbours' shards under quotas.

1. One pass gives narrow rows (id, size, checksum, digest of the text); only these travel.
2. Linked documents start in shards by hash. In each round, (group, shard) counts, partly summed before their shuffle, tell
   each block of a group which shard holds most of its links and still has room; a join carries that to the documents.
   Requests are counted by target, gain class and a hash bucket (a table of fixed size); the highest gains are accepted
   as far as the target's quota has room. So a round never overfills a shard, cut links only fall, and a group that
   is larger than a shard fills whole shards and leaves one remainder.
3. Documents without links fill what the quotas leave, by distributed ranks: counts come out at most one apart.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import spread
from hirelake.session import written_once

SHARDS = 8
#: Hash buckets in which requests of one gain class are accepted, and powers of two that tell gain classes.
BUCKETS, CLASSES = 512, 48
#: Rows that are ranked together, and the least number of such parts.
RANKED, PARTS = 1_000_000, 512


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``uid`` (row number without meaning), ``doc_id, size, text_crc32, digest``; equal digests are equal texts."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    return docs.select(
        F.monotonically_increasing_id().alias("uid"), docs[id_col].cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("digest"))


def quotas(rows: int, shards: int) -> np.ndarray:
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], np.int64)


def accepted_buckets(requests: list, free: np.ndarray) -> list[int]:
    """For each (target, class) how many hash buckets go through: highest class first while the target has room."""
    counts = np.zeros((len(free), CLASSES, BUCKETS), np.int64)
    for target, gain, bucket, n in requests:
        counts[target, gain, bucket] = n
    out = np.zeros((len(free), CLASSES), np.int64)
    for target, room in enumerate(free):
        for gain in range(CLASSES - 1, -1, -1):
            fits = np.cumsum(counts[target, gain]) <= room
            out[target, gain] = BUCKETS if fits.all() else int(np.argmin(fits))
            room -= int(counts[target, gain, : out[target, gain]].sum())
            if not fits.all():
                break
    return out.ravel().tolist()


def _targets(blocks: DataFrame, free: np.ndarray) -> DataFrame:
    """``digest, shard, target, gain`` for each block that has more links in another shard with room.

    Of equal blocks one has the higher rank by hash and the other asks. A block in a full shard asks also those that only
    equal it: none of them can come to it.
    """
    room = F.array(*(F.lit(bool(f > 0)) for f in free))
    order = F.struct("n", F.xxhash64("digest", "shard"), "shard")
    open_ = F.when(F.get(room, F.col("shard")), order)
    best = F.max(open_).over(Window.partitionBy("digest"))
    rows = blocks.select("digest", "shard", order.alias("own"), best.alias("best"))
    leaves = ~F.get(room, F.col("shard")) & (F.col("best.n") >= F.col("own.n"))
    return rows.where((F.col("best") > F.col("own")) | leaves).select(
        "digest", "shard", F.col("best.shard").alias("target"),
        F.floor(F.log2(F.col("best.n").cast("double"))).cast("int").alias("gain"))


def cut_edges(placed: DataFrame) -> DataFrame:
    """``digest, cut_edges``: a group's links form a chain through its shards, so one less than its shards are cut."""
    blocks = placed.groupBy("digest", "shard").agg(F.lit(1).alias("one")).groupBy("digest")
    return blocks.agg((F.count(F.lit(1)) - 1).alias("cut_edges"))


def propagate(linked: DataFrame, quota: np.ndarray) -> DataFrame:
    """``uid, shard`` of linked documents (``uid, digest``), after rounds of moves; stored.

    Rounds end when no document asks to move, or when no request fits into the room that is left. A move joins a block
    that has more links than its own, so the largest blocks only grow and the rounds come to an end.
    """
    shards = len(quota)
    state = linked.select("uid", "digest", spread(F.col("uid"), shards).alias("shard"))
    state = written_once(state, "shards")
    for number in itertools.count():
        blocks = state.groupBy("digest", "shard").agg(F.count(F.lit(1)).alias("n"))
        load = np.zeros(shards, np.int64)
        for shard, n in state.groupBy("shard").count().collect():
            load[shard] = n
        free = quota - load
        # stored, so that the join has a plain shuffle of its own, of which Spark can split a hot group
        targets = written_once(_targets(blocks, free), "shard-targets")
        wishes = state.join(targets, ["digest", "shard"], "left").select(
            "uid", "digest", "shard", "target", "gain", spread(F.col("uid"), BUCKETS, number + 1).alias("bucket"))
        wishes = written_once(wishes, "shard-wishes")
        asked = wishes.where("target is not null").groupBy("target", "gain", "bucket").count().collect()
        if not asked:
            break
        accepted = accepted_buckets([tuple(r) for r in asked], free)
        if not any(r["bucket"] < accepted[r["target"] * CLASSES + r["gain"]] for r in asked):
            break
        through = F.array(*map(F.lit, accepted))
        allowed = F.get(through, F.col("target") * CLASSES + F.col("gain"))
        moves = F.col("target").isNotNull() & (F.col("bucket") < allowed)
        new = wishes.select("uid", "digest", F.when(moves, F.col("target")).otherwise(F.col("shard")).alias("shard"))
        state = written_once(new, "shards")
    return state.select("uid", "shard")


def ranked(rows: DataFrame, keys: int, total: int, key: Column) -> DataFrame:
    """``rows`` with ``rank`` from 0 without gaps inside each ``key`` (0 to keys - 1), in parts of bounded size."""
    parts = max(PARTS, -(-total // (keys * RANKED)))
    rows = rows.withColumn("_key", key).withColumn("_part", spread(F.col("uid"), parts, 99))
    sizes = rows.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_key", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_key", "_part").orderBy("uid")) - 1
    own = rows.withColumn("_at", inside)
    return own.join(starts, ["_key", "_part"]).withColumn("rank", (F.col("_start") + F.col("_at")).cast("long")).drop(
        "_key", "_part", "_at", "_start")


def shards(
    docs: DataFrame, number: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, cut_edges``, one row per row of ``docs``.

    The law is ``rows``: shards differ by at most one row. Equal texts are linked and share a shard as far as quotas
    allow; ``cut_edges`` says how many links of the document's group join two shards (0 without links). A null text is
    an empty one, a very long one counts by its size and travels as a digest. Repeated rows are documents of their own,
    and other columns, whatever their names, are not read. An empty table gives no rows.
    """
    rows = written_once(documents(docs, id_col, text_col), "shard-documents")
    total = rows.count()
    quota = quotas(total, number)
    groups = rows.groupBy("digest").count().where("count > 1").select("digest", F.lit(True).alias("linked"))
    groups = written_once(groups, "shard-groups")  # likewise
    rows = written_once(rows.join(groups, "digest", "left"), "shard-linked")
    linked = rows.where("linked")
    placed = propagate(linked, quota)
    placed = ranked(placed, number, total, F.col("shard"))
    limit = F.array(*map(F.lit, quota.tolist()))
    # only a start that overfilled a shard can be beyond its quota
    placed = written_once(placed.where(F.col("rank") < F.get(limit, F.col("shard"))), "shard-placed")
    held = np.zeros(number, np.int64)
    for shard, n in placed.groupBy("shard").count().collect():
        held[shard] = n
    rest = rows.join(placed.select("uid"), "uid", "left_anti").select("uid")
    rest = ranked(rest, 1, total, F.lit(0))
    ends = np.cumsum(quota - held).tolist()
    shard = F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= F.col("rank")))
    first = F.get(F.array(*map(F.lit, (np.array([0, *ends[:-1]]) - held).tolist())), F.col("shard"))
    rest = rest.withColumn("shard", shard).withColumn("rank", F.col("rank") - first)
    both = placed.select("uid", "shard", "rank").unionByName(rest.select("uid", "shard", "rank"))
    both = written_once(rows.join(both, "uid"), "shard-rows")
    cut = written_once(cut_edges(both.where("linked")).where("cut_edges > 0"), "shard-cuts")
    return both.join(cut, "digest", "left").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("rank").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.coalesce("cut_edges", F.lit(0)).cast("long").alias("cut_edges"))
