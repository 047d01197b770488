"""Best-fit packing of tokenised documents into sequences, improved by swap-based local search.

1. One pass tokenises whole texts and cuts them into pieces; a piece is a narrow row (ids only on demand). Only pieces
   travel from there on.
2. Each task packs bounded groups of its pieces: best fit, largest first, then local search on the underfull bins. A
   document moves from the emptiest bin to another, or is exchanged one for one or two for one, whenever that increases
   the sum of squared fills, until bins are empty. Groups follow the order in which rows come, so no key can be hot.
3. Full bins are final. The pieces of underfull bins of all groups meet in the next round in fewer groups, until one
   bounded group is left or their bins are within one a group of the least number possible. Where meeting gains little,
   the fuller ones become final and the emptier ones meet.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import id_and_text
from hirelake.session import written_once

CAPACITY = 1024
#: The id that follows each document.
END_ID = 2
#: Pieces that are packed together.
GROUP = 50_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", sequence_id long, offset long"


class Encoder:
    """Byte-level BPE from a public vocabulary of ranks; special strings are ordinary text."""

    def __init__(self, vocabulary: str, pattern: str):
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        return self._encoding.encode_to_numpy(text, disallowed_special=())


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str | None = None, pattern: str | None = None) -> Encoder:
    """One encoder per worker. By default the installed vocabulary whose ids are those of ``byte_bpe_50k.json``."""
    if vocabulary is None or pattern is None:
        import public_tokenizers

        vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    if (vocabulary, pattern) not in _ENCODERS:
        _ENCODERS[vocabulary, pattern] = Encoder(vocabulary, pattern)
    return _ENCODERS[vocabulary, pattern]


def cut_points(length: int, capacity: int = CAPACITY) -> list[int]:
    """Starts of the pieces of a document: all hold ``capacity`` tokens but the first, which may be shorter."""
    if length <= capacity:
        return [0]
    first = length % capacity or capacity
    return [0, *range(first, length, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None,
           pattern: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces of ``doc_id, text`` rows; with ``keep_ids`` their ids too. A null text is empty: only the end id."""

    def make(batches: Iterator[pa.RecordBatch]):
        encode = encoder(vocabulary, pattern).ids
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or "").astype("<u4"), np.uint32(end_id)).astype("<u4")
                starts = cut_points(len(ids), capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    values = (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b] if keep_ids else None)
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 6 if keep_ids else 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(rows[:n], kinds, strict=False)], names=names[:n])

    return docs.mapInArrow(make, _PIECES + (", ids array<int>" if keep_ids else ""))


# --- one group --------------------------------------------------------------------------------------------------


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: largest items first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0  # bit s is set if some bin has s left
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fitting = spaces >> sizes[item]
        if fitting:
            space = sizes[item] + (fitting & -fitting).bit_length() - 1
            own = by_space[space].pop()
            if not by_space[space]:
                spaces &= ~(1 << space)
        else:
            own, space = len(bins), capacity
            bins.append([])
        bins[own].append(item)
        by_space[space - sizes[item]].append(own)
        spaces |= 1 << (space - sizes[item])
    return bins


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Underfull bins improved until no step from an emptiest bin helps; emptied bins are gone.

    Steps for a bin, each of which increases the sum of squared fills: move an item to the fullest bin that takes it;
    give an item for a smaller one of a bin that then is fuller than both were; give two items for one likewise.
    """
    item = np.array([i for own in bins for i in own], np.int64)
    size = np.array([sizes[i] for i in item], np.int64)
    home = np.repeat(np.arange(len(bins)), [len(own) for own in bins])
    fill = np.bincount(home, size, len(bins)).astype(np.int64)
    members: list[list[int]] = [[] for _ in bins]
    for k, b in enumerate(home):
        members[b].append(k)

    def put(k: int, b: int) -> None:
        members[home[k]].remove(k)
        members[b].append(k)
        fill[home[k]] -= size[k]
        fill[b] += size[k]
        home[k] = b

    def exchange(e: int, given: list[int]) -> bool:
        """``given`` items of bin ``e`` for one item of another bin that becomes as full as possible by it."""
        total = int(size[given].sum())
        after = fill[home] + total - size
        better = (home != e) & (size < total) & (after <= capacity) & (after > np.maximum(fill[home], fill[e]))
        if not better.any():
            return False
        taken = int(np.argmax(np.where(better, after, -1)))
        other = int(home[taken])
        put(taken, e)
        for k in given:
            put(k, other)
        return True

    def improve(e: int) -> bool:
        for k in sorted(members[e], key=lambda k: -size[k]):
            room = (fill + size[k] <= capacity) & (fill + size[k] > fill[e]) & (fill > 0)
            room[e] = False
            if room.any():
                put(k, int(np.argmax(np.where(room, fill, -1))))
                return True
        own = sorted({int(size[k]): k for k in members[e]}.items(), reverse=True)  # one item of each size
        if any(exchange(e, [k]) for _, k in own):
            return True
        ordered = sorted(members[e], key=lambda k: -size[k])
        tried = set()
        for i, a in enumerate(ordered):
            for b in ordered[i + 1 :]:
                total = int(size[a] + size[b])
                if total not in tried:
                    tried.add(total)
                    if exchange(e, [a, b]):
                        return True
        return False

    improved = True
    while improved:
        improved = False
        for b in sorted(range(len(bins)), key=lambda b: (int(fill[b]), b)):
            while 0 < fill[b] < capacity and improve(b):
                improved = True
    return [[int(item[k]) for k in own] for own in members if own]


def packed_group(sizes: list[int], capacity: int) -> list[list[int]]:
    bins = best_fit(sizes, capacity)
    fill = [sum(sizes[i] for i in own) for own in bins]
    open_ = [own for own, f in zip(bins, fill, strict=True) if f < capacity]
    return [own for own, f in zip(bins, fill, strict=True) if f == capacity] + local_search(open_, sizes, capacity)


# --- the operator -----------------------------------------------------------------------------------------------


def _round(capacity: int, closing: float):
    """Packs a task's rows in groups; full bins close, and the fullest ``closing`` share of the others in each group.

    Pieces of bins that stay open keep a null sequence. Sequences are numbered within the round, by task. Of the pieces of a bin, open or not, just one has offset 0.
    """

    def pack(batches: Iterator[pa.RecordBatch]):
        task, made = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def flush():
            nonlocal made
            rows = pa.Table.from_batches(held)
            sizes = rows.column("length").to_pylist()
            order, sequence, offset = [], [], []
            bins = packed_group(sizes, capacity)
            fill = [sum(sizes[i] for i in own) for own in bins]
            open_ = sorted((f for f in fill if f < capacity), reverse=True)
            n_closing = math.ceil(closing * len(open_))
            bound, ties = (open_[n_closing - 1], n_closing - sum(f > open_[n_closing - 1] for f in open_)) if n_closing else (capacity, 0)
            for own, f in zip(bins, fill, strict=True):
                closed = f > bound or f == capacity or (f == bound and ties > 0)
                ties -= f == bound
                at = 0
                for i in own:
                    order.append(i)
                    sequence.append((task << 33) | made if closed else None)
                    offset.append(at)
                    at += sizes[i]
                made += closed
            out = rows.take(pa.array(order, pa.int64())).select(["doc_id", "piece", "start", "length", "ids_crc32"])
            out = out.append_column("sequence_id", pa.array(sequence, pa.int64()))
            return out.append_column("offset", pa.array(offset, pa.int64())).combine_chunks().to_batches()

        waiting = 0
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                if waiting + part.num_rows > GROUP:
                    yield from flush()
                    held.clear()
                    waiting = 0
                held.append(part)
                waiting += part.num_rows
        if waiting:
            yield from flush()

    return pack


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence); lengths must be 1 to capacity.

    Pieces of underfull bins are dealt anew until they fit into one group, or until their bins exceed the least number
    possible (by tokens, and by pieces of more than half the capacity) by no more than one for each group. After a round
    that gained less than a tenth the fuller half of the underfull bins closes and the emptier half meets again, so the
    rounds grow with the logarithm of the rows and the emptiest bins of all groups end in one.
    """
    done, first, before = None, 0, None
    rest, closing = rows.select("doc_id", "piece", "start", "length", "ids_crc32"), 0.0
    while True:
        result = written_once(rest.mapInArrow(_round(capacity, closing), _PACKED), "packed")
        closed = result.where("sequence_id is not null")
        closed = closed.withColumn("sequence_id", F.col("sequence_id") + F.lit(first).cast("long"))
        first += (result.agg(F.max("sequence_id")).first()[0] or 0) + 1  # behind all numbers of this round
        done = closed if done is None else done.unionAll(closed)
        if closing == 1:
            return done
        rest = result.where("sequence_id is null")
        left, tokens, large, bins = rest.agg(
            F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.count_if(F.col("length") * 2 > capacity),
            F.count_if(F.col("offset") == 0)).first()
        groups = max(1, -(-left // GROUP))
        if groups == 1 or bins - max(-(-tokens // capacity), large) <= groups:
            closing = 1.0
        else:
            closing = 0.5 if before is not None and left > 0.9 * before else 0.0
        before = left
        rest = rest.drop("sequence_id", "offset").repartition(groups)


def best_fit_packing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Packs all documents into as few sequences of ``capacity`` tokens as the search finds.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A null or empty text is a piece
    of its end id alone. Repeated rows are packed each. An empty table gives no rows. A very long text is tokenised
    whole and cut; other columns of ``docs`` are not read and may have any name.
    """
    made = written_once(pieces(id_and_text(docs, id_col, text_col), **options), "pieces")
    return pack(made, options.get("capacity", CAPACITY))


def sequences(packed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """Token sequences ``sequence_id, ids`` from packed rows and pieces made with ``keep_ids`` (unique ids assumed)."""
    joined = packed.join(with_ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    return joined.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids")
    )
