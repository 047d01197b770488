"""Quality classifier by compression: which of two zstandard dictionaries makes a text smaller.

One dictionary is built from good, one from bad labelled text. A text is compressed with both, in blocks, so that the
dictionaries count throughout a long text and not at its head alone. The normalised difference of the sizes, (bad - good) /
(bad + good), becomes a score by a logistic calibration on labelled rows that built no dictionary. How far a difference
can be trusted depends on the length of the text, so the calibration has the difference, the length and their product.

Learning reads a bounded sample of the labelled rows that are not held out (PIECES blocks and FIT_ROWS texts a class, first by
hash); rows are weighed by their class's share, so scores are shares. Scoring reads every whole text once, where it
lies, without shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import id_and_text, utf8
from hirelake.llm.toxicity import held_out
from hirelake.session import written_once

#: Labelled texts of each class that the calibration may read.
FIT_ROWS = 4_000
#: Blocks of each class from which its dictionary is built.
PIECES = 3_000
#: Bytes of a block of text that is compressed by itself.
BLOCK = 2_048
#: Bytes of a dictionary, at most.
DICTIONARY = 112_640
LEVEL = 3


def blocks(text: bytes, size: int = BLOCK) -> list[bytes]:
    """A whole text in blocks of equal length, at most ``size`` bytes; an empty text is one empty block."""
    n = max(-(-len(text) // size), 1)
    each = -(-len(text) // n) or 1
    return [text[i:i + each] for i in range(0, max(len(text), 1), each)]


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; where there is too little text to train on, the text itself."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionaries(good: list[bytes], bad: list[bytes]) -> tuple[bytes, bytes] | None:
    """Dictionaries of one size for both classes, at most a quarter of the smaller class's text."""
    size = min(DICTIONARY, min(sum(map(len, good)), sum(map(len, bad))) // 4)
    return (dictionary(good, size), dictionary(bad, size)) if size >= 64 else None


class Compressors:
    """A compressor for each dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self._compress = []
        for content in (good, bad):
            held = zstandard.ZstdCompressionDict(content)
            held.precompute_compress(level=LEVEL)
            options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            self._compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, **options).compress)

    def sizes(self, text: bytes) -> tuple[int, int]:
        parts = blocks(text)
        return tuple(sum(len(compress(p)) for p in parts) for compress in self._compress)


def features(compressors: Compressors | None, texts: list[bytes]) -> np.ndarray:
    """Per text the normalised difference, the logarithm of the length, and their product."""
    x = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        length = np.log2(1 + len(text)) / 10
        if compressors and text:
            good, bad = compressors.sizes(text)
            x[i, 0] = (bad - good) / (bad + good) * 10
        x[i, 1], x[i, 2] = length, x[i, 0] * length
    return x


def calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weighted logistic coefficients, constant first, by Newton steps with a ridge on all but the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(slope, x.T @ (weight * (y - p)) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Model:
    dictionaries: tuple[bytes, bytes] | None
    coefficients: np.ndarray

    def scores(self, texts: list[bytes], compressors: Compressors | None) -> np.ndarray:
        z = self.coefficients[0] + features(compressors, texts) @ self.coefficients[1:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def compressors(self) -> Compressors | None:
        return Compressors(*self.dictionaries) if self.dictionaries else None


def labelled(labels: DataFrame) -> DataFrame:
    """``doc_id, good`` of labelled documents that are not held out; of several labels the worst counts."""
    own = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
    own = own.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return own.groupBy("doc_id").agg((F.min("quality") == 1).cast("int").alias("good"))


def fit_sample(docs: DataFrame, own: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``text, good, part`` of at most ``rows`` labelled documents of each class for each of two parts, first by hash.

    Ids are chosen from the labels alone and broadcast (at most four times ``rows``); texts are picked where they are read.
    """
    parted = own.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(2)).cast("int"))
    chosen = None
    for good in (0, 1):
        for part in (0, 1):
            some = parted.where((F.col("good") == good) & (F.col("part") == part))
            some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
            chosen = some if chosen is None else chosen.unionAll(some)
    return docs.join(F.broadcast(chosen), "doc_id").select("text", "good", "part")


def _as_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, good in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            if text:
                parts = blocks(text)
                yield pa.record_batch([pa.array(parts, pa.binary()), pa.array([good] * len(parts), pa.int32())], names=["block", "good"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, pieces: int = PIECES) -> Model:
    """Learns from labelled, not held out rows of ``doc_id, text``. Without rows of both classes the score is the share of
    good labels, or 0.5 without labels."""
    own = labelled(labels)
    counts = {r["good"]: r["count"] for r in own.groupBy("good").count().collect()}  # at most two rows
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    prior = Model(None, np.array([np.log(share / (1 - share)), 0.0, 0.0, 0.0]))
    if len(counts) < 2:
        return prior
    sample = written_once(fit_sample(docs, own, rows), "quality-sample")
    cut = written_once(sample.where("part = 0").select("text", "good").mapInArrow(_as_blocks, "block binary, good int"), "quality-blocks")
    found = {}
    for good in (0, 1):
        some = cut.where(F.col("good") == good).orderBy(F.xxhash64("block"), "block").limit(pieces)
        found[good] = [bytes(r["block"]) for r in some.select("block").collect()]  # at most PIECES blocks of BLOCK bytes
    built = dictionaries(found[1], found[0])
    if built is None:
        return prior

    def rows_of(batches):
        compressors = Compressors(*built)
        for batch in batches:
            x = features(compressors, utf8(batch.column(0)))
            yield pa.record_batch({"x": pa.array(list(x), pa.list_(pa.float64())), "good": batch.column(1)})

    known = sample.where("part = 1").select("text", "good").mapInArrow(rows_of, "x array<double>, good int").toPandas()
    if known["good"].nunique() < 2:
        return prior
    y = known["good"].to_numpy(float)
    weight = np.where(y == 1, counts[1] / y.sum(), counts[0] / (1 - y).sum())
    return Model(built, calibrated(np.stack(known["x"]), y, weight * len(y) / weight.sum()))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row of ``doc_id, text``; a null text scores as an empty one."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        compressors = held.value.compressors()
        for batch in batches:
            yield pa.record_batch({
                "doc_id": batch.column(0), "score": pa.array(held.value.scores(utf8(batch.column(1)), compressors))})

    return docs.mapInArrow(score, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``; a score of 0.3 or more predicts good.

    Scores come from the text alone. Null and empty texts get the score of a text without difference, very long texts are
    read whole in blocks, repeated rows get equal scores, without labels of both classes all scores are equal, and other
    columns are not read. An empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col)
    return scored(rows, fit(rows, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
