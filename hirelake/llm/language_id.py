"""Hierarchical language identification: the family first, then one-versus-one linear SVMs inside it.

Features are relative frequencies of hashed letter n-grams (2 to 4 letters, word borders included) of the whole text,
scaled by their spread. A linear machine's value is then a mean of n-gram weights, so scoring is one lookup for each n-gram
and no feature vector is built. Families come from a fixed table of language codes; a code it does not hold is a family of
its own. Between more than two families and between the languages of a family every pair has its own machine and the most
votes win, ties by the larger margins.

Learning takes a bounded sample (FIT_ROWS per language, first by hash) whose n-gram counts Spark's tasks make.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import id_and_text
from hirelake.session import written_once

#: Language codes by family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk pl cs sk bg sr hr sl mk be",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "celtic": "ga gd cy br",
    "indo-aryan": "hi bn ur mr ne pa gu",
    "semitic": "ar he mt am",
    "sinitic": "zh yue",
}
#: Rows of each language that learning may read.
FIT_ROWS = 400
#: Hash buckets of n-grams.
BUCKETS = 1 << 13
ORDERS = (2, 3, 4)
UNDETERMINED = "und"


def family_of(language: str) -> str:
    base = language.lower().split("-")[0].split("_")[0]
    return next((f for f, codes in FAMILIES.items() if base in codes.split()), f"only {language}")


# --- n-grams of a batch -----------------------------------------------------------------------------------------


def _letters() -> np.ndarray:
    """For each code point below 0x3000 itself if it is a letter, else 0."""
    return np.array([i if chr(i).isalpha() else 0 for i in range(0x3000)], np.uint32)


_LETTERS = _letters()


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams and the text each belongs to. Other signs than letters all are one word border."""
    points = np.frombuffer("".join(f"\n{t}\n" for t in texts).lower().encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t.lower()) + 2 for t in texts])
    letter = np.where(points < 0x3000, _LETTERS[np.minimum(points, 0x2FFF)], points)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    kept = (letter > 0) | np.concatenate(([True], letter[:-1] > 0))  # the first of several other signs
    kept |= np.concatenate(([True], owner[1:] != owner[:-1]))
    letter, owner = letter[kept], owner[kept]
    found, whose = [], []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            if len(letter) < n:
                continue
            h = np.full(len(letter) - n + 1, n, np.uint32)
            for k in range(n):
                h = (h ^ letter[k : len(letter) - n + 1 + k]) * np.uint32(0x01000193)
            same = owner[: len(h)] == owner[n - 1 :]
            inner = same & ((letter[: len(h)] > 0) | (letter[n - 1 :] > 0))
            found.append(((h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS))[inner])
            whose.append(owner[: len(h)][inner])
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    return np.concatenate(found), np.concatenate(whose)


def has_letter(texts: list[str]) -> np.ndarray:
    return np.array([any(map(str.isalpha, t)) for t in texts], bool)


def frequencies(texts: list[str]) -> np.ndarray:
    """Relative frequency of each bucket, a row per text."""
    bucket, owner = ngrams(texts)
    counts = np.bincount(owner.astype(np.int64) * BUCKETS + bucket, minlength=len(texts) * BUCKETS)
    counts = counts.reshape(len(texts), BUCKETS).astype(np.float32)
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


# --- machines ---------------------------------------------------------------------------------------------------


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 30) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by dual coordinate descent; y is +1 or -1."""
    n = len(x)
    squares = np.einsum("ij,ij->i", x, x) + 1
    w, bias, alpha = np.zeros(x.shape[1], np.float64), 0.0, np.zeros(n)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        largest = 0.0
        for i in order.permutation(n):
            gradient = y[i] * (x[i] @ w + bias) - 1 + alpha[i] / (2 * c)
            new = max(alpha[i] - gradient / (squares[i] + 1 / (2 * c)), 0.0)
            step = (new - alpha[i]) * y[i]
            if step:
                w += step * x[i]
                bias += step
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return w, bias


@dataclass(frozen=True)
class Choice:
    """One-versus-one machines between ``names``; columns of ``weights`` follow the pairs."""

    names: tuple[str, ...]
    pairs: tuple[tuple[int, int], ...]
    weights: np.ndarray  # BUCKETS x pairs
    biases: np.ndarray

    def votes(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner of each row and a confidence in it, from 0.5 to 1 between two names."""
        n, k = len(values), len(self.names)
        if k == 1:
            return np.zeros(n, np.int64), np.ones(n)
        won, margin = np.zeros((n, k)), np.zeros((n, k))
        for column, (a, b) in enumerate(self.pairs):
            v = values[:, column]
            won[:, a] += v >= 0
            won[:, b] += v < 0
            margin[:, a] += v
            margin[:, b] -= v
        best = np.argmax(won + 1e-3 * np.tanh(margin / k), axis=1)
        own = margin[np.arange(n), best] / (k - 1)
        return best, 1 / (1 + np.exp(-np.clip(2 * own, -30, 30)))


def _choice(names: list[str], x: np.ndarray, label: np.ndarray, scale: np.ndarray) -> Choice:
    pairs = tuple(combinations(range(len(names)), 2))
    weights, biases = np.zeros((BUCKETS, len(pairs)), np.float32), np.zeros(len(pairs))
    for column, (a, b) in enumerate(pairs):
        rows = np.isin(label, (a, b))
        own = x if rows.all() else x[rows]
        w, biases[column] = linear_svm(own, np.where(label[rows] == a, 1.0, -1.0))
        weights[:, column] = w * scale
    return Choice(tuple(names), pairs, weights, biases)


@dataclass(frozen=True)
class Model:
    families: Choice
    languages: dict[str, Choice]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and a score between 0 and 1; ``und`` with score 0 without letters."""
        n = len(texts)
        known = has_letter(texts)
        if not self.families.names:
            return [UNDETERMINED] * n, np.zeros(n)
        bucket, owner = ngrams(texts)
        total = np.maximum(np.bincount(owner, minlength=n)[:n], 1)

        def values(choice: Choice) -> np.ndarray:
            sums = [np.bincount(owner, choice.weights[bucket, k], minlength=n)[:n] for k in range(len(choice.pairs))]
            return np.column_stack(sums) / total[:, None] + choice.biases if sums else np.zeros((n, 0))

        family, sure = self.families.votes(values(self.families))
        names, score = np.full(n, UNDETERMINED, object), np.zeros(n)
        for k, f in enumerate(self.families.names):
            own = (family == k) & known
            choice = self.languages[f]
            language, inside = choice.votes(values(choice))
            names[own] = np.array(choice.names, object)[language[own]]
            score[own] = (sure * inside)[own]
        return names.tolist(), score


def fit_sample(docs: DataFrame, lang: str, rows: int = FIT_ROWS) -> DataFrame:
    """``lang, text`` of at most ``rows`` documents of each language that are not held out, first by hash of the id.

    Ids are chosen without their texts and broadcast. The list of languages is short.
    """
    own = docs.where(F.col(lang).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = own.groupBy(lang).agg(F.count(F.lit(1)).alias("n"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # a third more than wanted by hash first, so that few rows of a common language meet in one task
    near = own.select("doc_id", lang).join(F.broadcast(sizes), lang).where(place * F.col("n") <= 1.33 * rows)
    order = Window.partitionBy(lang).orderBy(place, "doc_id")
    chosen = near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= rows)
    ids = chosen.select("doc_id").distinct()
    return own.join(F.broadcast(ids), "doc_id").select(F.col(lang).alias("lang"), "text")


def held_out(id_col, modulus: int = 4, remainder: int = 2):
    """Whether crc32 of the id as text leaves ``remainder``; a null id hashes as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def fit(docs: DataFrame, lang: str = "lang", rows: int = FIT_ROWS) -> Model:
    """Learns from ``doc_id, text`` and ``lang``. Texts without letters teach nothing."""

    def counted(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts, names = batch.column(1).to_pylist(), batch.column(0)
            for at in range(0, len(texts), 256):
                x = frequencies([t or "" for t in texts[at : at + 256]])
                buckets = [np.flatnonzero(r) for r in x]
                yield pa.record_batch({
                    "lang": names.slice(at, 256), "buckets": pa.array(buckets, pa.list_(pa.int32())),
                    "shares": pa.array([r[b] for r, b in zip(x, buckets, strict=True)], pa.list_(pa.float32())),
                })

    sample = fit_sample(docs, lang, rows).mapInArrow(counted, "lang string, buckets array<int>, shares array<float>")
    known = written_once(sample, "language-sample").where("size(buckets) > 0").toPandas()  # bounded by `rows`
    if known.empty:
        return Model(Choice((), (), np.zeros((BUCKETS, 0)), np.zeros(0)), {})
    # rows come in any order; a fixed one makes equal models
    known["key"] = [zlib.crc32(np.asarray(b).tobytes()) for b in known["buckets"]]
    known = known.sort_values(["lang", "key"], kind="stable").reset_index(drop=True)
    x = np.zeros((len(known), BUCKETS), np.float32)
    for i, (b, s) in enumerate(zip(known["buckets"], known["shares"], strict=True)):
        x[i, b] = s
    # rarer n-grams weigh more: every bucket is divided by the root of its mean share
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6)
    x *= scale
    size = np.float32(np.sqrt(np.einsum("ij,ij->i", x, x).mean()))
    x /= size
    scale = scale / size
    labels = known["lang"].to_numpy(object)
    del known
    family = np.array([family_of(n) for n in labels], object)
    names = sorted(set(family))
    families = _choice(names, x, np.array([names.index(f) for f in family]), scale)
    languages = {}
    for f in names:
        rows_of = family == f
        inside = sorted(set(labels[rows_of]))
        languages[f] = _choice(inside, x[rows_of], np.array([inside.index(n) for n in labels[rows_of]]), scale)
    return Model(families, languages)


def language_id(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, one row per row of ``docs``.

    Predictions come from the text alone. A null text and one without letters are ``und`` with score 0; without any
    labelled row all are. Repeated rows get equal predictions. An empty table gives no rows.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                       docs[lang_col].cast("string").alias("lang"))
    held = docs.sparkSession.sparkContext.broadcast(fit(rows))

    def predict(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            names, scores = [], []
            for part in parts(texts):
                some, sure = held.value.predict(part)
                names += some
                scores.append(sure)
            yield pa.record_batch({
                "doc_id": batch.column(0), "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(np.concatenate([np.zeros(0), *scores])),
            })

    found = id_and_text(docs, id_col, text_col).mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def parts(texts: list[str], points: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about so many characters, which bounds the arrays over them; texts are never cut."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text) + 1
        if size >= points:
            yield held
            held, size = [], 0
    if held:
        yield held
