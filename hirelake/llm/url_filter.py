"""URL filters by a cascade of Bloom filters: exact verdicts without joining pages and rules.

A rule is a host and a path prefix with an action. The keys that could be listed are, for each page, its host's label
suffixes with its path's prefixes, of the label counts and lengths that rules have; together they are the corpus's
complete key universe. Level 1 of a cascade encodes the
listed keys; level 2 the keys of the universe that level 1 takes wrongly; level 3 the listed keys that level 2
takes wrongly; and so on until a level takes nothing wrongly. A key's first refusing level then tells exactly whether it is
listed, for every key of the universe. One cascade encodes the blocked keys, one the allowed keys.

Levels are built by grouping bit numbers into words, level by level, from stored keys; only the finished filters reach the
driver and are broadcast. Their size follows from the number of rules, not of pages, and is checked: a cascade beyond
MAX_BYTES is built in segments by key hash, and pages meet one segment after the other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.session import written_once

#: Bytes of filters that one broadcast may hold.
MAX_BYTES = 64 << 20
ACTIONS = ("block", "allow")
#: Between host and path in a key; a host never holds it.
_GAP = "/"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- urls and candidate keys ------------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(_after(url), r"(?s)\A[^/?#]*", 0)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_after(url), r"(?s)\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys that a rule for this url could have: for each shape (labels of the host, length of the path) of some rule, the
    host's last labels with the path's beginning; the longest key first, of equally long ones the longer host.

    No other key can be listed, so a host of any number of labels has at most one key for each shape.
    """
    labels = F.size(F.split(host, r"\.", -1))
    size = F.length(path)
    listed = F.array(*(F.struct(F.lit(d).alias("labels"), F.lit(n).alias("length")) for d, n in shapes))
    one = lambda s: F.call_function("substring_index", host, F.lit("."), -s["labels"])
    fitting = F.filter(listed, lambda s: (s["labels"] <= labels) & (s["length"] <= size))
    pairs = F.transform(fitting, lambda s: F.struct(
        (F.length(one(s)) + s["length"]).alias("size"), F.length(one(s)).alias("host_size"),
        F.concat_ws(_GAP, one(s), F.substring(path, F.lit(1), s["length"])).alias("key")))
    keys = F.transform(F.reverse(F.array_sort(pairs)), lambda p: p["key"])
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


# --- cascades ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Level:
    size: int  # bits
    hashes: int
    words: np.ndarray

    def takes(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.ones(len(first), bool)
        with np.errstate(over="ignore"):
            for i in range(self.hashes):
                bit = (first + np.uint64(i) * second) % np.uint64(self.size)
                out &= ((self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)) > 0
        return out


def _hashes(key: Column, level: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1)).bitwiseOR(F.lit(1))]


def _parameters(entries: int, others: int, level: int) -> tuple[int, int]:
    """Bits and hash functions: level 1 leaves about as many wrong keys as are listed, later levels half of theirs."""
    rate = 0.5 if level else min(0.5, math.sqrt(0.5) * max(entries, 1) / max(others, 1))
    size = max(64, math.ceil(max(entries, 1) * -math.log(rate) / math.log(2) ** 2))
    return size, max(1, round(-math.log2(rate)))


def _taken(keys: DataFrame, level: Level, number: int) -> DataFrame:
    """The keys that a level takes."""
    held = keys.sparkSession.sparkContext.broadcast(level)

    def pick(batches):
        for batch in batches:
            first, second = (batch.column(i).to_numpy().view(np.uint64) for i in (1, 2))
            yield pa.record_batch({"key": batch.column(0).filter(pa.array(held.value.takes(first, second)))})

    return keys.select("key", *_hashes(F.col("key"), number)).mapInArrow(pick, "key string")


def _level(keys: DataFrame, entries: int, others: int, number: int) -> Level:
    size, hashes = _parameters(entries, others, number)
    first, second = _hashes(F.col("key"), number)

    def bits(batches):
        for batch in batches:
            a, b = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            with np.errstate(over="ignore"):
                at = np.concatenate([(a + np.uint64(i) * b) % np.uint64(size) for i in range(hashes)])
            word = (at >> np.uint64(6)).astype(np.int64)
            mask = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.record_batch({"word": pa.array(word), "mask": pa.array(mask)})

    rows = keys.select(first, second).mapInArrow(bits, "word long, mask long")
    words = np.zeros((size >> 6) + 1, np.uint64)
    # at most size / 64 rows, which MAX_BYTES bounds for a segment
    for word, mask in rows.groupBy("word").agg(F.expr("bit_or(mask)").alias("mask")).toLocalIterator():
        words[word] = np.uint64(mask & 0xFFFFFFFFFFFFFFFF)
    return Level(size, hashes, words)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, hashes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Exact for keys of the universe; ``hashes`` has a pair of arrays for each level."""
        out = np.zeros(len(hashes[0][0]), bool)
        open_ = np.arange(len(out))
        for number, level in enumerate(self.levels):
            takes = level.takes(*(h[open_] for h in hashes[number]))
            out[open_[~takes]] = number % 2 == 1  # refused by a level of wrong keys: it is listed
            open_ = open_[takes]
        out[open_] = len(self.levels) % 2 == 1
        return out


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """``listed`` and ``universe`` hold distinct keys; keys of the universe that are listed are no wrong keys."""
    listed = written_once(listed, "cascade-listed")
    rest = universe.join(listed, "key", "left_anti")
    inside, outside = listed, rest
    n_in = listed.count()
    if not n_in:
        return Cascade(())
    n_out, levels = universe.count(), []
    while n_in:
        level = _level(inside, n_in, n_out, len(levels))
        wrong = written_once(_taken(outside, level, len(levels)), "cascade-wrong")
        levels.append(level)
        inside, outside = wrong, inside
        n_in, n_out = wrong.count(), n_in
    return Cascade(tuple(levels))


# --- the operator -----------------------------------------------------------------------------------------------


def checked_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules ``key, labels, length, action``. A rule listed with both actions is refused."""
    rows = rules.select(
        F.translate(F.col("host"), _UPPER, _LOWER).alias("host"), F.col("path"), F.col("action"),
    ).where("host is not null and path is not null").distinct()
    rows = written_once(rows.select(F.concat_ws(_GAP, "host", "path").alias("key"),
                                    F.size(F.split("host", r"\.", -1)).alias("labels"),
                                    F.length("path").alias("length"), "action"), "url-rules")
    wrong = rows.where(~F.col("action").isin(*ACTIONS)).limit(1).collect()
    twice = rows.groupBy("key").count().where("count > 1").limit(1).collect()
    if wrong or twice:
        raise ValueError(f"rules must either block or allow: {(wrong or twice)[0]}")
    return rows


def _probe(cascades: dict[str, Cascade], segment: int, segments: int, depth: int):
    def probe(batches):
        for batch in batches:
            rows = batch.column(1)
            sizes = np.diff(rows.offsets.to_numpy())
            keys = rows.flatten()
            hashes = batch.column(2).flatten().to_numpy().view(np.uint64).reshape(-1, 2 * depth + 1)
            pairs = [(hashes[:, 2 * k], hashes[:, 2 * k + 1]) for k in range(depth)]
            own = hashes[:, -1] % np.uint64(segments) == segment
            action = np.zeros(len(keys), np.int8)
            for number, name in enumerate(ACTIONS, 1):
                if len(keys) and cascades[name].levels:
                    action[own & cascades[name].contains(pairs)] = number
            yield _first_matches(batch, sizes, keys, action)

    return probe


def _first_matches(batch, sizes, keys, action):
    """The first listed candidate of each row, unless an earlier segment found an earlier one."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hit = np.flatnonzero(action)
    rows, first = np.unique(row[hit], return_index=True)
    best, found, names = (batch.column(i).to_pylist() for i in (3, 4, 5))
    for r, at in zip(rows.tolist(), hit[first].tolist(), strict=True):
        if best[r] is None or place[at] < best[r]:
            best[r], found[r], names[r] = int(place[at]), keys[at].as_py(), ACTIONS[action[at] - 1]
    return pa.record_batch([*(batch.column(i) for i in range(3)), pa.array(best, pa.int32()),
                            pa.array(found, pa.string()), pa.array(names, pa.string())], names=batch.schema.names)


def url_verdicts(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """``page_id, host, path, rule, verdict``, one row per row of ``pages``.

    ``rules`` has ``host, path, action`` (block or allow). A rule fits its host and all subdomains if the url's path
    starts with its path. The longest rule (host and path together) decides, of equally long ones that with the longer
    host; without a rule the verdict is ``default``, as the cascades list no key of the url. A null url, one without
    ``://`` and one with an empty host have no rule. Repeated rows are judged each; an empty rule list leaves all to
    ``default``; an empty table gives no rows. A url of any length, with any number of labels, costs one key for each
    shape of rules. Other columns of ``pages`` are not read and may have any name.
    """
    listed = checked_rules(rules)
    # bounded by the most labels times the longest path of any rule
    shapes = [tuple(r) for r in listed.select("labels", "length").distinct().collect()]
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), shapes or [(1, 0)]))
    universe = written_once(rows.select(F.explode("keys").alias("key")).distinct(), "url-universe")
    entries, keys = listed.count(), universe.count()
    bits = entries * (2 * math.log2(max(2, keys / max(1, entries))) + 8)  # all levels, generously
    segments = max(1, math.ceil(bits / 8 / MAX_BYTES))
    place = lambda c: F.pmod(F.xxhash64(c, F.lit(-1)), F.lit(segments))
    rows = rows.select(
        F.struct("page_id", "host", "path").alias("page"), "keys", F.lit(None).cast("array<bigint>").alias("hashes"),
        F.lit(None).cast("int").alias("best"), F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("action"))
    for segment in range(segments):
        own = lambda df: df.where(place(F.col("key")) == segment)  # noqa: B023, E731
        cascades = {a: build_cascade(own(listed.where(F.col("action") == a).select("key")), own(universe))
                    for a in ACTIONS}
        depth = max((len(c.levels) for c in cascades.values()), default=0)
        each = lambda k: F.array(*(h for i in range(depth) for h in _hashes(k, i)), place(k))  # noqa: B023, E731
        rows = rows.withColumn("hashes", F.flatten(F.transform("keys", each)))
        rows = rows.mapInArrow(_probe(cascades, segment, segments, depth), rows.schema)
    rule = F.concat(F.substring_index("rule", _GAP, 1), F.expr(f"substring(rule, instr(rule, '{_GAP}') + 1)"))
    return rows.select(
        "page.page_id", "page.host", "page.path", rule.alias("rule"), F.coalesce("action", F.lit(default)).alias("verdict"))


__all__ = ["build_cascade", "candidate_keys", "host_of", "path_of", "url_verdicts"]
