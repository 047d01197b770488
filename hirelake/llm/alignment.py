"""Cross-tokenizer alignment by interval coalescing.

Both tokenizers cut the same bytes, so each token is an interval of byte offsets. All tokens of a batch of texts lie on one
line; they are sorted together by start, and the running maximum of their ends shows where both have ended: a group
breaks where a start reaches it. Overlapping pairs within a group are expanded from two sorted searches, since the tokens of
one side that overlap a token of the other are neighbours. A text has fewer links than tokens, so all is linear.

One pass tokenises and stores a narrow row per text: its figures and its distinct id pairs with their numbers of links. Pair
counts of the corpus come from these by one grouping with partial sums. Then each text looks its pairs up:

* pairs with many links, a bounded number of them, from arrays that every worker holds;
* the remaining ones, if any, by a join on the pair. None of them is hot, as the hot ones are among the former.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import id_and_text, run_starts
from hirelake.llm.packing import encoder
from hirelake.session import written_once

#: Pairs that workers hold at once (16 bytes each); pairs with fewer links than these are joined.
HELD_PAIRS = 2_000_000
#: Bytes of text that are aligned together; a longer text is aligned alone.
BATCH_BYTES = 4_000_000
#: Links that a task counts before it hands its counts on.
COUNTED = 2_000_000

_ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs array<long>, links array<int>")
FIGURES = ("n_a", "n_b", "n_groups", "n_links")


class Pieces:
    """A sentencepiece model: ids of texts, and the bytes that each id stands for."""

    def __init__(self, model: str | None = None):
        import sentencepiece

        if model is None:
            import public_tokenizers

            model = public_tokenizers.path("piece_bpe_32k.model")
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        p = self.processor
        self.bytes = [
            bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
            for i in range(p.get_piece_size())
        ]
        self.sizes = np.array([len(b) for b in self.bytes])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(i, np.int64) for i in self.processor.encode(texts, num_threads=1)]


_PIECES: dict[str | None, Pieces] = {}


def pieces(model: str | None = None) -> Pieces:
    """One model per worker."""
    if model not in _PIECES:
        _PIECES[model] = Pieces(model)
    return _PIECES[model]


class ByteTokens:
    """The byte-level tokenizer: ids of texts, and the number of bytes of each id."""

    def __init__(self, vocabulary: str | None = None, pattern: str | None = None):
        self._encoder = encoder(vocabulary, pattern)
        self.bytes: dict[int, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        return self._encoder.ids(text).astype(np.int64)

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        for i in np.unique(ids).tolist():
            if i not in self.bytes:
                self.bytes[i] = self._encoder._encoding.decode_single_token_bytes(i)
        known = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
        for i in np.unique(ids).tolist():
            known[i] = len(self.bytes[i])
        return known[ids]


# --- one batch ------------------------------------------------------------------------------------------------------


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray):
    """Groups and links of two cuts of the same bytes.

    Returns the tokens of both sides in group order (side A first inside a group) as positions in A followed by B, the
    group and side of each, and the linked positions ``(a, b)``.
    """
    ends_a, ends_b = np.cumsum(a_sizes), np.cumsum(b_sizes)
    starts_a, starts_b = ends_a - a_sizes, ends_b - b_sizes
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    side = np.repeat([0, 1], [len(a_sizes), len(b_sizes)])
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    listed = np.lexsort((starts, side, group))
    # of B, the tokens that overlap one of A are those from the first that ends behind its start to the last that starts
    # before its end
    first = np.searchsorted(ends_b, starts_a, "right")
    last = np.searchsorted(starts_b, ends_a, "left")
    n = last - first
    a = np.repeat(np.arange(len(a_sizes)), n)
    b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return listed, group[listed], side[listed], a, b


def _written(ids: np.ndarray, group: np.ndarray, side: np.ndarray, names: list[str]) -> str:
    """``a1,a2|b1;a3|b2,b3`` of tokens in group order."""
    signs = np.full(len(ids), ord(","), np.uint8)
    signs[:-1][side[1:] != side[:-1]] = ord("|")
    signs[:-1][group[1:] != group[:-1]] = ord(";")
    listed = chain.from_iterable(zip(map(names.__getitem__, ids.tolist()), signs.tobytes().decode(), strict=True))
    return "".join(listed)[:-1]


def align_texts(texts: list[str], a: ByteTokens, b: Pieces, names: list[str]) -> list[tuple]:
    """Per text: figures, hash of the groups, distinct pairs (``b * 2^32 + a``), and how many links each has."""
    rows: list[tuple] = [(0, 0, 0, 0, "", [], [])] * len(texts)
    some = [i for i, t in enumerate(texts) if t]
    ids_a = [a.ids(" " + texts[i]) for i in some]
    ids_b = b.ids([texts[i] for i in some])
    sizes = a.sizes(np.concatenate([np.zeros(0, np.int64), *ids_a]))
    at, kept = 0, []
    for i, x, y in zip(some, ids_a, ids_b, strict=True):
        own, at = sizes[at:at + len(x)], at + len(x)
        whole = b" " + texts[i].encode()
        if b"".join([a.bytes[k] for k in x.tolist()]) == whole == b"".join([b.bytes[k] for k in y.tolist()]):
            kept.append((i, x, y, own))
    if not kept:
        return rows
    all_a, all_b = np.concatenate([x for _, x, _, _ in kept]), np.concatenate([y for _, _, y, _ in kept])
    listed, group, side, link_a, link_b = coalesce(np.concatenate([s for *_, s in kept]), b.sizes[all_b])
    ids = np.concatenate([all_a, all_b])[listed]
    # both sides of a text cover the same bytes, so no group and no link reaches into another text
    token_ends = np.cumsum([len(x) + len(y) for _, x, y, _ in kept])
    link_ends = np.searchsorted(link_a, np.cumsum([len(x) for _, x, _, _ in kept]), "left")
    keys = all_b[link_b] << 32 | all_a[link_a]
    t0 = l0 = 0
    for (i, x, y, _), t1, l1 in zip(kept, token_ends.tolist(), link_ends.tolist(), strict=True):
        text = _written(ids[t0:t1], group[t0:t1], side[t0:t1], names)
        pairs, links = np.unique(keys[l0:l1], return_counts=True)
        n_groups = int(group[t1 - 1] - group[t0]) + 1
        rows[i] = (len(x), len(y), n_groups, l1 - l0, hashlib.sha256(text.encode()).hexdigest(), pairs, links.astype(np.int32))
        t0, l0 = t1, l1
    return rows


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most BATCH_BYTES (as characters) or of one text."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > begin and size + n > BATCH_BYTES:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def aligned(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, model: str | None = None) -> DataFrame:
    """One row per ``doc_id, text`` row with a number of its own, its figures, and its distinct pairs with their links."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteTokens(vocabulary, pattern), pieces(model)
        names = [str(i) for i in range(max(a._encoder._encoding.n_vocab, len(b.bytes)))]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for begin, end in _chunks(texts):
                found = align_texts([t or "" for t in texts[begin:end]], a, b, names)
                n_a, n_b, n_groups, n_links, sha, pairs, links = zip(*found, strict=True)
                own = ids.slice(begin, end - begin)
                yield pa.record_batch([
                    pa.array(range(row, row + len(own)), pa.int64()), own, *[pa.array(v, pa.int64()) for v in (n_a, n_b, n_groups, n_links)],
                    pa.array(sha, pa.string()), pa.array(pairs, pa.list_(pa.int64())), pa.array(links, pa.list_(pa.int32())),
                ], names=[f.split()[0] for f in _ALIGNED.split(", ")])
                row += len(own)

    return docs.mapInArrow(align, _ALIGNED)


# --- the corpus -----------------------------------------------------------------------------------------------------


def _summed(pairs: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, links = pairs[order], links[order]
    at = run_starts(pairs)
    return pairs[at], np.add.reduceat(links, at) if len(at) else links


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, count`` over all texts: summed inside each task before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def handed() -> pa.RecordBatch:
            pairs, links = _summed(*(np.concatenate(c) for c in zip(*held, strict=True)))
            return pa.record_batch([pa.array(pairs), pa.array(links)], names=["pair", "count"])

        for batch in batches:
            pairs, links = (batch.column(i).flatten().to_numpy() for i in (0, 1))
            held.append(_summed(pairs, links.astype(np.int64)))
            size += len(held[-1][0])
            if size > COUNTED:
                yield handed()
                held, size = [], 0
        if held:
            yield handed()

    counted = rows.select("pairs", "links").mapInArrow(count, "pair long, count long")
    return counted.groupBy("pair").agg(F.sum("count").alias("count"))


def with_best(counts: DataFrame) -> DataFrame:
    """``pair, count, best``: whether no pair of the same B id has more links."""
    most = counts.groupBy(F.shiftright("pair", 32).alias("b")).agg(F.max("count").alias("most"))
    joined = counts.withColumn("b", F.shiftright("pair", 32)).join(most, "b")
    return joined.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def held_limit(counts: DataFrame, limit: int) -> int:
    """The least power of two such that at most ``limit`` pairs have as many links or more."""
    by_size = counts.groupBy(F.floor(F.log2("count") + 1e-9).cast("int").alias("e")).count().orderBy(F.desc("e"))
    total, least = 0, 64
    for r in by_size.collect():  # at most 64 rows
        total += r["count"]
        if total > limit:
            break
        least = r["e"]
    return 2**least if least < 63 else 2**63 - 1


def alignment(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, pattern: str | None = None,
    model: str | None = None, held: int = HELD_PAIRS,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per row of ``docs``.

    A text that is null or empty, or that one tokenizer does not give back byte by byte, has no tokens: zeros and ''.
    Repeated rows count as often as they occur, ties for the best pair are all best, very long texts are aligned whole and
    alone, and other columns of ``docs`` are not read. An empty table gives no rows. ``held`` changes where pair counts
    are looked up, never a result.
    """
    rows = written_once(aligned(id_and_text(docs, id_col, text_col), vocabulary, pattern, model), "aligned")
    counts = written_once(with_best(written_once(pair_counts(rows), "pair-counts")), "pair-best")
    least = held_limit(counts, held)
    top = counts.where(F.col("count") >= least).orderBy("pair").toArrow()  # at most ``held`` pairs
    table = docs.sparkSession.sparkContext.broadcast(
        (top["pair"].to_numpy(), top["count"].to_numpy(), top["best"].to_numpy(zero_copy_only=False)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = table.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("pairs"))
            pairs = column.flatten().to_numpy()
            links = batch.column(batch.schema.get_field_index("links")).flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            found = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            ends = np.cumsum(column.value_lengths().to_numpy())
            sums = []
            for values in (links * count[at] * found, links * (best[at] & found)) if len(known) else (links * 0, links * 0):
                running = np.concatenate([[0], np.cumsum(values)])
                sums.append(running[ends] - running[ends - column.value_lengths().to_numpy()])
            yield pa.record_batch([*batch.columns[:-2], *map(pa.array, sums)], names=[*batch.schema.names[:-2], "count_sum", "n_best"])

    fields = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    result = rows.mapInArrow(look_up, f"{fields}, count_sum long, n_best long")
    rare = counts.where(F.col("count") < least)
    if not rare.isEmpty():
        own = rows.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("links").alias("n"))))
        more = own.join(rare, "pair").groupBy("row").agg(
            F.sum(F.col("n") * F.col("count")).alias("_sum"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("_best"))
        result = result.join(more, "row", "left").withColumns({
            "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0)), "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0))})
    return result.select("doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256")
