"""Benchmark decontamination: an FM-index per training shard, searched for every window of the benchmark's items.

The benchmark is the stated query set: it is taken in blocks of a bounded number of words, and each block meets all
documents where they are read, so no document is shuffled. A shard is a bounded run of a task's documents. Its index
holds the words that can be part of an occurrence: a word that no window of the block has stands in none, and a run of
other words shorter than the shortest window holds none; both leave the result as it is. Windows are found by backward
search through wavelet ranks, located by sampled suffix positions, and merged into removal spans.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import id_and_text, utf8
from hirelake.llm.fm_index import FMIndex
from hirelake.session import written_once

#: Words: A-Z lower-cased, then runs of digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 10
#: Words of one block of items, which bounds what is broadcast.
BLOCK_WORDS = 200_000
#: Symbols of one shard's index.
SHARD_SYMBOLS = 1_000_000
#: Blocks that one task passes its texts through, each in a Python worker of its own with the block in memory.
PASSES = 4

_SPANS = "array<struct<first:int,end:int>>"


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


@dataclass
class Block:
    """Windows of some items: word numbers, phrases by length, and which items each phrase stands for."""

    window: int = WINDOW
    numbers: dict[bytes, int] = field(default_factory=dict)
    phrases: dict[tuple[int, ...], set] = field(default_factory=dict)

    def add(self, item_id: int | None, item: list[bytes]) -> None:
        ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in item]
        for at in range(max(1, len(ids) - self.window + 1) if ids else 0):
            self.phrases.setdefault(tuple(ids[at : at + self.window]), set()).add(item_id)

    def ready(self) -> Block:
        self.shortest = min(map(len, self.phrases), default=1)
        self.by_length = {}
        for n in sorted({len(p) for p in self.phrases}):
            own = [p for p in self.phrases if len(p) == n]
            self.by_length[n] = (np.array(own, np.int64), [self.phrases[p] for p in own])
        self.longest = max(self.by_length, default=1)
        return self


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> Iterator[Block]:
    """The items in blocks of about BLOCK_WORDS words, one at a time. Items without words are none; a repeated id is one item."""
    items = benchmark.select(
        benchmark[id_col].cast("long").alias("item_id"), benchmark[text_col].cast("binary").alias("text")
    ).where("text is not null")
    now, held = Block(window), 0
    for item_id, text in items.toLocalIterator():  # one partition of the benchmark at a time
        own = words(bytes(text))
        now.add(item_id, own)
        held += len(own)
        if held >= BLOCK_WORDS:
            yield now.ready()
            now, held = Block(window), 0
    if now.phrases:
        yield now.ready()


def sent(spark: SparkSession, found: Iterator[Block]) -> list[Broadcast]:
    """Each block is sent out as it is made: the driver's Python holds one block, the session its serialised bytes on disk."""
    return [spark.sparkContext.broadcast(b) for b in found]


def passes(rows: DataFrame, held: list[Broadcast], step: Callable[[Broadcast], Callable], schema: T.StructType) -> DataFrame:
    """``rows`` through ``step`` of every block. Rows are stored after each PASSES blocks, so a task has no more workers."""
    for k, block in enumerate(held):
        if k and k % PASSES == 0:
            rows = written_once(rows, "decontamination-pass")
        rows = rows.mapInArrow(step(block), schema)
    return rows


@dataclass
class Found:
    n_words: int
    spans: list[tuple[int, int]] = field(default_factory=list)
    items: set = field(default_factory=set)


class Shard:
    """Runs of candidate words of some documents, and the search over their index."""

    def __init__(self, block: Block):
        self.block, self.parts, self.owner, self.first, self.size = block, [], [], [], 0

    def add(self, document: int, text_words: list[bytes]) -> None:
        n = len(text_words)
        get = self.block.numbers.get
        ids = np.fromiter(map(get, text_words, [0] * n), np.int64, n)
        inside = np.diff(np.concatenate(([0], (ids > 0).astype(np.int8), [0])))
        for a, b in zip(np.flatnonzero(inside == 1), np.flatnonzero(inside == -1), strict=True):
            if b - a >= self.block.shortest:
                self.parts += [ids[a:b], np.zeros(1, np.int64)]
                self.owner.append(document)
                self.first.append(int(a))
                self.size += int(b - a) + 1

    def search(self, found: list[Found]) -> None:
        """Adds hit words and items to ``found`` by document, then forgets the runs."""
        if not self.parts:
            return
        symbols = np.concatenate(self.parts)
        starts = np.concatenate(([0], np.flatnonzero(symbols == 0)[:-1] + 1))
        index = FMIndex(symbols, len(self.block.numbers))
        edge = np.zeros(len(symbols) + 1, np.int64)
        for length, (phrases, owners) in self.block.by_length.items():
            low, high = index.search(phrases)
            number = high - low
            which = np.repeat(np.arange(len(phrases)), number)
            rows = np.repeat(low - np.concatenate(([0], np.cumsum(number)[:-1])), number) + np.arange(number.sum())
            at = index.positions(rows)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length, -1)
            run = np.searchsorted(starts, at, side="right") - 1
            for pair in np.unique(run * len(phrases) + which):
                found[self.owner[pair // len(phrases)]].items |= owners[pair % len(phrases)]
        hit = np.diff(np.concatenate(([0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0])))
        for a, b in zip(np.flatnonzero(hit == 1), np.flatnonzero(hit == -1), strict=True):
            run = int(np.searchsorted(starts, a, side="right")) - 1
            shift = self.first[run] - int(starts[run])
            found[self.owner[run]].spans.append((int(a) + shift, int(b) + shift))
        self.__init__(self.block)


def search_texts(texts: list[bytes], block: Block) -> list[Found]:
    """Merged hit spans (word numbers, end exclusive) and items of each text."""
    found, shard = [], Shard(block)
    for k, text in enumerate(texts):
        own = words(text)
        found.append(Found(len(own)))
        if block.phrases:
            shard.add(k, own)
            if shard.size >= SHARD_SYMBOLS:
                shard.search(found)
    if shard.size:
        shard.search(found)
    return found


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``doc_id, n_words, spans`` (hit words, merged, end exclusive), ``items`` (ids, ascending), a row per row of docs.

    A window is ``window`` consecutive words of an item, or all of a shorter item. Null and empty texts have no words
    and no hits; an empty benchmark hits nothing. An item without id marks hits but is not listed. Texts of any length are
    searched whole, a run of a text never being divided between indexes; other columns, whatever their names, are not read.
    """
    rows = id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    held = sent(spark, blocks(benchmark, item_col, item_text, window)) or sent(spark, iter([Block(window).ready()]))
    rows = rows.select("doc_id", "text", F.lit(0).cast("long").alias("n_words"),
                       F.array().cast(_SPANS).alias("spans"), F.array().cast("array<bigint>").alias("items"))
    return passes(rows, held, _find, rows.schema).drop("text")


def _find(block):
    def find(batches):
        for batch in batches:
            found = search_texts(utf8(batch.column(1)), block.value)
            spans, items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for f, s, i in zip(found, spans, items, strict=True):
                s[:] = _merged([(x["first"], x["end"]) for x in s] + f.spans)
                i[:] = sorted({*i, *f.items} - {None})
            named = [[{"first": a, "end": b} for a, b in s] for s in spans]
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array([f.n_words for f in found], pa.int64()),
                pa.array(named, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                pa.array(items, pa.list_(pa.int64())),
            ], names=batch.schema.names)

    return find


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the bytes from the first to the last word of each span."""
    at = [m.span() for m in WORD.finditer(text.lower())]
    kept, last = [], 0
    for first, end in spans:
        kept.append(text[last : at[first][0]])
        last = at[end - 1][1]
    return b"".join([*kept, text[last:]])


def _remove(block, text_at: int, chars_at: int | None):
    def remove(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            raw = utf8(batch.column(text_at))
            open_, empty = list(range(len(raw))), set()
            while open_:  # what a cut brings together may be an occurrence again
                found = search_texts([raw[i] for i in open_], block.value)
                open_ = [(i, f.spans) for i, f in zip(open_, found, strict=True) if f.spans]
                for i, spans in open_:
                    raw[i] = cut(raw[i], spans)
                    texts[i] = raw[i].decode()
                open_ = [i for i, _ in open_]
                empty |= {i for i in open_ if not WORD.search(raw[i].lower())}
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, batch.schema.types[text_at])
            if chars_at is not None:
                old = batch.column(chars_at).to_pylist()
                new = [len(t) if t is not None and o is not None else o for t, o in zip(texts, old, strict=True)]
                columns[chars_at] = pa.array(new, batch.schema.types[chars_at])
            out = pa.record_batch(columns, names=batch.schema.names)
            yield out.filter(pa.array([i not in empty for i in range(len(raw))], pa.bool_()))

    return remove


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``docs`` with every occurrence cut from its text, and ``chars_col`` counted anew where it is a column.

    Clean rows keep their text byte by byte. A row of which no word is left is dropped. With several blocks the passes
    are repeated until none of them finds anything.
    """
    spark = docs.sparkSession
    held = sent(spark, blocks(benchmark, item_col, item_text, window))
    text_at = docs.columns.index(text_col)
    chars_at = docs.columns.index(chars_col) if chars_col in docs.columns else None
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    while True:
        rows = passes(docs, held, lambda block: _remove(block, text_at, chars_at), schema)
        if len(held) < 2:
            return rows
        docs = written_once(rows, "decontaminated")
        rest = contamination(docs.select(F.lit(0).alias("doc_id"), docs[text_col].alias("text")), benchmark,
                             item_col=item_col, item_text=item_text, window=window)
        if rest.where(F.size("spans") > 0).isEmpty():
            return docs
