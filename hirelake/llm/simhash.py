"""Near-duplicates by SimHash fingerprints, found with the generalised pigeonhole principle.

Fingerprints within ``distance`` bits are linked; a document's component is all that is reachable over links.

1. One pass over the texts makes the 64-bit fingerprints; equal fingerprints are one class from there on, so copies are
   never expanded into pairs.
2. A bounded sample of classes estimates how bits correlate. Correlated bits go into the same partition, which leaves the
   others selective. If the partitions' thresholds add up to ``distance - partitions + 1``, two linked fingerprints
   agree within the threshold in at least one partition. Dynamic programming chooses the thresholds (-1 skips a
   partition) with the least estimated signatures and candidates. The sample steers cost alone: every choice is exact.
3. Signatures: the bits of a partition, with every choice of ``threshold`` of them masked. Equal signatures are candidates.
4. A signature with more than BUCKET classes is divided anew over the bits that it leaves free. Distinct fingerprints that
   agree on all but k bits are at most 2^k, so this ends with small buckets without dropping any pair.
5. Candidates are verified by popcount; each task returns a spanning forest of its links, and rounds of large-star and
   small-star joins make components of the forests.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import id_and_text, run_starts, shared_ids, small, utf8, with_ids, without_ids
from hirelake.session import written_once

BITS = 64
SEED = 42
#: Classes whose bits are looked at to choose partitions and thresholds.
SAMPLE = 5_000
#: Most classes that one signature may hold before it is divided; also bounds a task's comparisons per class.
BUCKET = 512
#: Cost of making and shuffling a signature, in comparisons.
SIGNATURE_COST = 500


# --- fingerprints -----------------------------------------------------------------------------------------------


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash over the XXH64 of word shingles; a bit is set if it is in over half of them. No words: zero."""
    words = text.lower().split()  # on bytes: A-Z only, and white space is U+0009 to U+000D and space
    if not words:
        return 0
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    runs = zip(*(words[i:] for i in range(size)), strict=False)
    hashes = np.array([digest(b" ".join(run), SEED) for run in runs], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a bounded bit matrix, whatever the length of the text
        part = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) of columns ``doc_id, text``."""

    def prints(batches):
        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in utf8(batch.column(1))], np.uint64)
            yield pa.record_batch({"doc_id": batch.column(0), "fp": pa.array(values.view(np.int64))})

    return docs.mapInArrow(prints, "doc_id long, fp long")


# --- partitions and thresholds ----------------------------------------------------------------------------------


def correlated_partitions(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bit numbers in ``parts`` sets of nearly equal size; each grows by the bits most correlated with it."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    centred = bits - bits.mean(axis=0)
    norms = np.sqrt((centred**2).sum(axis=0))
    norms[norms == 0] = 1
    strength = np.abs((centred / norms).T @ (centred / norms))
    np.fill_diagonal(strength, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        size = (len(left) + parts - k - 1) // (parts - k)
        rest = sorted(left)
        own = [max(rest, key=lambda b: (strength[b, rest].sum(), -b))]
        left.remove(own[0])
        while len(own) < size:
            best = max(sorted(left), key=lambda b: (strength[b, own].sum(), -b))
            own.append(best)
            left.remove(best)
        out.append(sorted(own))
    return out


def masks(bits: list[int], threshold: int) -> np.ndarray:
    """What a signature looks at: the partition's bits but for each choice of ``threshold`` of them."""
    whole = sum(1 << b for b in bits)
    return np.array([whole - sum(1 << b for b in out) for out in combinations(bits, threshold)], np.uint64)


def _collisions(sample: np.ndarray, looked_at: np.ndarray) -> float:
    total = 0
    for mask in looked_at:
        n = np.unique(sample & mask, return_counts=True)[1]
        total += int((n * (n - 1) // 2).sum())
    return total


def plan(sample: np.ndarray, classes: int, distance: int) -> list[np.ndarray]:
    """The masks of each used partition, by the cheapest partition number and thresholds."""
    best: tuple[float, list[np.ndarray]] | None = None
    scale = (classes / max(len(sample), 1)) ** 2
    for parts in range(1, distance + 2):
        sets = correlated_partitions(sample, parts)
        goal = distance - parts + 1
        costs = []
        for own in sets:
            row = {-1: 0.0}
            for t in range(0, min(goal + parts - 1, len(own)) + 1):
                if comb(len(own), t) > 512:  # dearer than any plan with more partitions
                    break
                row[t] = SIGNATURE_COST * classes * comb(len(own), t) + _collisions(sample, masks(own, t)) * scale
            costs.append(row)
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for row in costs:
            step: dict[int, tuple[float, tuple[int, ...]]] = {}
            for total, (cost, chosen) in table.items():
                for t, more in row.items():
                    new = (cost + more, (*chosen, t))
                    if total + t not in step or new < step[total + t]:
                        step[total + t] = new
            table = step
        if goal in table and (best is None or table[goal][0] < best[0]):
            chosen = table[goal][1]
            best = (table[goal][0], [masks(s, t) for s, t in zip(sets, chosen, strict=True) if t >= 0])
    return best[1]


# --- candidates and links ---------------------------------------------------------------------------------------

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mixed(values: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    """A 64-bit mixing step; a chance collision only adds a candidate, which verification refuses."""
    with np.errstate(over="ignore"):
        x = values ^ (np.asarray(salt, np.uint64) * _M1)
        x = (x ^ (x >> np.uint64(33))) * _M2
        return x ^ (x >> np.uint64(29))


_SIGNATURES = "key long, fp long, free long"


def _signature_batch(keys, prints, free):
    return pa.record_batch({
        n: pa.array(np.concatenate(v).view(np.int64)) for n, v in (("key", keys), ("fp", prints), ("free", free))
    })


def signatures(classes: DataFrame, looked_at: list[np.ndarray]) -> DataFrame:
    flat = np.concatenate(looked_at)

    def make(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(flat), 64):
                some = list(enumerate(flat[at : at + 64], at + 1))
                yield _signature_batch(
                    [_mixed(fp & m, k) for k, m in some], [fp] * len(some), [np.full(len(fp), ~m) for _, m in some]
                )

    return classes.select("fp").mapInArrow(make, _SIGNATURES)


def _divided(rows: DataFrame, distance: int) -> DataFrame:
    """Signatures over the free bits of each row, in ``distance + 1`` parts: two linked rows agree in one part."""

    def make(batches):
        parts = distance + 1
        for batch in batches:
            key, fp, free = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            keys, rest = [], []
            bits = np.unpackbits(free.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            order = np.cumsum(bits, axis=1)
            total = order[:, -1:]
            for k in range(parts):
                own = bits & (order > total * k // parts) & (order <= total * (k + 1) // parts)
                mask = np.packbits(own.astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
                keys.append(_mixed(_mixed(fp & mask, key), k + 1))
                rest.append(free & ~mask)
            yield _signature_batch(keys, [fp] * parts, rest)

    return rows.select("key", "fp", "free").mapInArrow(make, _SIGNATURES)


def bounded_buckets(rows: DataFrame, distance: int) -> list[DataFrame]:
    """Stored signature rows whose keys hold at most BUCKET classes each, or agree on all but a few bits."""
    out, level = [], written_once(rows, "simhash-signatures")
    while True:
        sizes = level.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.bit_count("free")).alias("k"))
        large = sizes.where((F.col("n") > BUCKET) & (F.pow(F.lit(2.0), "k") > BUCKET)).select("key")
        large = written_once(large, "simhash-large")
        if large.isEmpty():
            return [*out, level]
        side = F.broadcast(large) if small(large) else large
        out.append(level.join(side, "key", "left_anti"))
        level = written_once(_divided(level.join(side, "key", "left_semi"), distance), "simhash-signatures")


class _Forest:
    """Union by smaller value, over the rows of one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _linked_pairs(key: np.ndarray, fp: np.ndarray, distance: int):
    """Verified pairs of equal keys in arrays sorted by key, by rows that are 1, 2, 3 ... apart."""
    starts = run_starts(key)
    lengths = np.diff(np.append(starts, len(key)))
    left = np.repeat(starts + lengths, lengths) - np.arange(len(key))  # rows to the end of the run, itself included
    at = np.flatnonzero(left > 1)
    apart = 1
    while len(at):
        a, b = fp[at], fp[at + apart]
        near = (np.bitwise_count(a ^ b) <= distance) & (a != b)
        yield a[near].view(np.int64), b[near].view(np.int64)
        apart += 1
        at = at[left[at] > apart]


def links(buckets: list[DataFrame], distance: int) -> DataFrame:
    """Links ``u > v`` between fingerprints: forests that connect what the verified pairs connect."""

    def verify(batches):
        forest = _Forest()
        key_left, fp_left = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def settle(key, fp):
            for a, b in _linked_pairs(key, fp, distance):
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    forest.join(x, y)

        for batch in batches:
            key = np.concatenate((key_left, batch.column(0).to_numpy()))
            fp = np.concatenate((fp_left, batch.column(1).to_numpy().view(np.uint64)))
            last = np.searchsorted(key, key[-1]) if len(key) else 0  # the last run may go on in the next batch
            settle(key[:last], fp[:last])
            key_left, fp_left = key[last:], fp[last:]
            if len(forest.up) > 2_000_000:  # a bounded forest; the parts are joined later
                yield _edges(forest)
                forest = _Forest()
        settle(key_left, fp_left)
        yield _edges(forest)

    found = None
    for rows in buckets:
        dealt = rows.select("key", "fp").repartition("key").sortWithinPartitions("key")
        some = dealt.mapInArrow(verify, "u long, v long")
        found = some if found is None else found.unionAll(some)
    return found


def _edges(forest: _Forest) -> pa.RecordBatch:
    u = list(forest.up)
    return pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array([forest.root(x) for x in u], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (its smallest reachable node) for every node of ``edges`` (u, v) that is not its own root.

    Large-star and small-star rounds: every round joins nodes with the least neighbour, so a chain of any length takes
    a logarithmic number of rounds. Each round is stored in the shared folder, which cuts the lineage.
    """
    state, seen = written_once(edges.where("u <> v").distinct(), "star"), None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if not mark[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if mark == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        both = state.select("u", "v").unionAll(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # stored before the join, so the rows of a hub are no longer bound to one task by its aggregate and can be split
        least = written_once(
            both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "star-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        down = written_once(down, "star-large")
        least = written_once(down.groupBy("u").agg(F.min("v").alias("m")), "star-least")
        across = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        state = written_once(across.unionAll(own).distinct(), "star")


# --- the operator -----------------------------------------------------------------------------------------------


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable), a row per row of ``docs``.

    A null or empty text, or one of white space only, has fingerprint zero and links like any other; fewer words than
    ``shingle`` are one shingle. Repeated rows get equal results. Null ids are no component's name unless a component
    has no other. An empty table gives no rows.
    """
    prints = written_once(fingerprints(id_and_text(docs, id_col, text_col), shingle), "simhash-prints")
    classes = written_once(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    n = classes.count()
    if n < 2:
        named = classes.select("fp", F.col("least_id").alias("component_id"))
    else:
        chosen = classes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
        sample = np.array([r[0] for r in chosen], np.int64).view(np.uint64)
        rows = signatures(classes, plan(sample, n, distance))
        roots = components(links(bounded_buckets(rows, distance), distance))
        rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
            "fp", "least_id", F.coalesce("root", "fp").alias("root"))
        rooted = written_once(rooted, "simhash-rooted")
        names = written_once(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-names")
        named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_component(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """``docs`` with the document of the smallest id of each component, all columns as they were.

    Where several rows share an id, id and fingerprint together tell which rows go. Rows without id stay, for no id
    can name one of them.
    """
    result = written_once(near_dedup(docs, id_col, text_col, shingle, distance), "simhash-result")
    shared = shared_ids(result.where("doc_id is not null"))
    dropped = result.where("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id"))
    if shared.isEmpty():
        return without_ids(docs, dropped, id_col)
    left = without_ids(docs, written_once(dropped.unionAll(shared), "simhash-dropped"), id_col)
    stays = with_ids(result.where("doc_id = component_id"), shared).select(
        F.col("doc_id").alias("kept_id"), F.col("fingerprint").alias("kept_print")).distinct()

    @F.pandas_udf("string")
    def printed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: f"{fingerprint((t or '').encode(), shingle):016x}")

    own = printed(docs[text_col].cast("string"))
    rows = with_ids(docs, shared, id_col).select(F.struct(*docs.columns).alias("row"), own.alias("print"))
    rows = rows.join(stays, (rows["row"][id_col].cast("long") == stays["kept_id"]) & (rows["print"] == stays["kept_print"]),
                     "left_semi")
    return left.unionByName(rows.select("row.*"))
