"""Toxicity: a learned lexicon, misspellings caught by Levenshtein automata over its trie, context windows, a score.

Learning takes a bounded sample of labelled rows (FIT_ROWS of each class, first by hash): one part gives the lexicon
(words and word stems whose document frequency differs significantly between the classes), the other the weights of a
logistic score over features of the found terms. Scoring reads every whole text once, where it lies, without shuffle:
each word of a batch runs through one deterministic automaton, all words of the batch together.

Context windows tell quotation from abuse: a term between two quotation marks close by counts as quoted, a term with
another unquoted term close by counts as clustered. The score weighs both kinds separately.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.automata import DEAD, START, LexiconAutomaton, compile_lexicon
from hirelake.llm.common import id_and_text
from hirelake.session import written_once

#: Labelled rows of each class that learning may read.
FIT_ROWS = 4_000
#: Terms of one automaton; a lexicon of more terms has several, so that no table of states grows with the lexicon.
AUTOMATON_TERMS = 250
#: Lengths of stems.
STEM = (4, 7)
#: Least roots of a term's likelihood ratio (a normal score where the term says nothing). Each gives a lexicon of all terms
#: beyond it; that with the least loss on rows that gave no lexicon is used.
SIGNIFICANT = (4.5, 7.0, 10.0)
#: Characters before and after a term that are looked at for quotation marks, words for other terms.
QUOTE_WINDOW, CLUSTER_WINDOW = 80, 12

_QUOTES = "\"«»“”„‹›"
_DISGUISES = "*@$!"
FEATURES = ("exact", "misspelt", "stem", "quoted", "clustered", "weight", "density")


def held_out(id_col: Column, modulus: int = 5, remainder: int = 0) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id hashes as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


# --- words of a batch as arrays ---------------------------------------------------------------------------------


def _kinds() -> np.ndarray:
    """For each code point below 0x3000: 1 letter or digit, 2 quotation mark, 3 sign that may stand for a letter."""
    kinds = np.array([chr(i).isalnum() for i in range(0x3000)], np.uint8)
    kinds[[ord(c) for c in _QUOTES]] = 2
    kinds[[ord(c) for c in _DISGUISES]] = 3
    return kinds


_KINDS = _kinds()
_HIGH = 1  # from 0x3000 on: letters


@dataclass
class Words:
    points: np.ndarray
    first: np.ndarray  # of each word
    end: np.ndarray
    document: np.ndarray
    quotes: np.ndarray  # positions of quotation marks

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        """Words are runs of letters and digits; a sign of ``*@$!`` between two letters is one of them."""
        points = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
        kind = np.where(points < 0x3000, _KINDS[np.minimum(points, 0x2FFF)], _HIGH)
        inside = kind == 1
        if len(points) > 2:
            inside[1:-1] |= (kind[1:-1] == 3) & inside[:-2] & inside[2:]
        edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
        first = np.flatnonzero(edge == 1)
        ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
        return cls(points, first, np.flatnonzero(edge == -1), np.searchsorted(ends_of_texts, first, side="right"),
                   np.flatnonzero(kind == 2))


def run(automaton: LexiconAutomaton, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of matching words, their terms and edits. All words take a step together; dead ones are left behind."""
    column = np.zeros(0x3000, np.int32)
    for c, i in automaton.letters.items():
        if ord(c) < 0x3000:
            column[ord(c)] = i
    length = words.end - words.first
    alive = np.arange(len(length))
    state = np.full(len(length), START, np.int32)
    found: list[np.ndarray] = []
    results: list[np.ndarray] = []
    step = 0
    while len(alive):
        points = words.points[words.first[alive] + step]
        state = automaton.step[state, np.where(points < 0x3000, column[np.minimum(points, 0x2FFF)], 0)]
        step += 1
        over = (length[alive] == step) & (automaton.term[state] >= 0)
        found.append(alive[over])
        results.append(state[over])
        on = (state != DEAD) & (length[alive] > step)
        absorbed = on & automaton.stays[state]
        found.append(alive[absorbed])
        results.append(state[absorbed])
        alive, state = alive[on & ~absorbed], state[on & ~absorbed]
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    order = np.argsort(at, kind="stable")
    last = np.concatenate(results)[order] if results else np.zeros(0, np.int32)
    return at[order], automaton.term[last], automaton.errors[last]


# --- features ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Lexicon:
    automata: tuple[tuple[LexiconAutomaton, np.ndarray], ...]  # each with the numbers of its terms
    weights: np.ndarray  # by term number
    stems: np.ndarray  # by term number: is it a stem


def lexicon(terms: dict[str, tuple]) -> Lexicon:
    """Of term -> (is a stem, weight, ...). Neighbours in the alphabet share an automaton, as they share a trie."""
    rank = lambda t: (terms[t][0], -len(t), t)
    order = sorted(terms, key=rank)
    number = {t: i for i, t in enumerate(order)}
    spelt, automata = sorted(terms), []
    for at in range(0, max(1, len(spelt)), AUTOMATON_TERMS):
        own = sorted(spelt[at : at + AUTOMATON_TERMS], key=rank)
        automata.append((compile_lexicon({t: terms[t][0] for t in own}), np.array([number[t] for t in own], np.int32)))
    return Lexicon(tuple(automata), np.array([terms[t][1] for t in order], float),
                   np.array([terms[t][0] for t in order], bool))


def matches(lex: Lexicon, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of matching words, terms and edits: of all automata's matches that with fewest edits, then a whole term
    before a stem, then the longest."""
    parts_ = []
    for automaton, number in lex.automata:
        at, term, errors = run(automaton, words)
        parts_.append((at, number[term] if len(term) else term, errors))
    if len(parts_) == 1:
        return parts_[0]
    at, term, errors = (np.concatenate(c) for c in zip(*parts_, strict=True))
    order = np.lexsort((term, errors, at))  # numbers follow whole terms first, then length
    at, term, errors = at[order], term[order], errors[order]
    first = np.concatenate(([True], at[1:] != at[:-1])) if len(at) else np.zeros(0, bool)
    return at[first], term[first], errors[first]


def features(texts: list[str], lex: Lexicon) -> np.ndarray:
    """A row of FEATURES per text."""
    n = len(texts)
    words = Words.of([t.lower() for t in texts])
    at, term, errors = matches(lex, words)
    out = np.zeros((n, len(FEATURES)))
    if not len(at):
        return out
    doc = words.document[at]
    quotes, first, end = words.quotes, words.first[at], words.end[at]
    before, after = np.searchsorted(quotes, first) - 1, np.searchsorted(quotes, end)
    padded = np.concatenate((quotes, [1 << 60]))
    quoted = (before >= 0) & (first - padded[before] <= QUOTE_WINDOW) & (padded[after] - end <= QUOTE_WINDOW)
    plain = np.flatnonzero(~quoted)
    near = np.zeros(len(at), bool)
    close = (np.diff(at[plain]) <= CLUSTER_WINDOW) & (np.diff(doc[plain]) == 0)
    near[plain[1:][close]] = near[plain[:-1][close]] = True
    stem = lex.stems[term]
    total = np.bincount(words.document, minlength=n)[:n]
    groups = (~quoted & ~stem & (errors == 0), ~quoted & (errors > 0), ~quoted & stem, quoted, near)
    for k, group in enumerate(groups):
        out[:, k] = np.log1p(np.bincount(doc[group], minlength=n)[:n])
    weight = np.bincount(doc[~quoted], (lex.weights[term] / (1 + errors))[~quoted], minlength=n)[:n]
    out[:, 5] = np.log1p(weight)
    out[:, 6] = np.log1p(100 * weight / np.maximum(total, 1))
    return out


def parts(texts: list[str], points: int = 1 << 21) -> Iterator[list[str]]:
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


# --- learning ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    coefficients: np.ndarray  # constant first

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.concatenate([np.zeros((0, len(FEATURES))), *(features(t, self.lexicon) for t in parts(texts))])
        z = self.coefficients[0] + x @ self.coefficients[1:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, text, toxic, part`` of at most ``rows`` documents of each class that are not held out, first by hash.

    Ids are chosen from the labels alone and broadcast (at most twice ``rows``); texts are picked where they are read.
    A document labelled more than once is toxic if any label says so.
    """
    own = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    own = own.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("toxic"))
    chosen = None
    for kind in (0, 1):
        some = own.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = some if chosen is None else chosen.unionAll(some)
    chosen = chosen.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)).cast("int"))
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic", "part")


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = Words.of([(text or "").lower()])
            whole = (text or "").lower()
            own = {whole[a:b] for a, b in zip(words.first, words.end, strict=True)}
            own = {w for w in own if 3 <= len(w) <= 24 and not any(c.isdigit() for c in w)}
            terms = {(w, False) for w in own} | {(w[:n], True) for w in own for n in range(*STEM) if len(w) > n}
            counts.update((*t, toxic) for t in terms)
            counts[None, False, toxic] += 1
    keys = list(counts)
    yield pa.record_batch({
        "term": pa.array([k[0] for k in keys], pa.string()), "stem": pa.array([k[1] for k in keys], pa.bool_()),
        "toxic": pa.array([k[2] for k in keys], pa.int32()), "n": pa.array([counts[k] for k in keys], pa.int64()),
    })


def learned_terms(sample: DataFrame) -> dict[str, tuple[bool, float, float]]:
    """All significant terms as (is a stem, smoothed log-odds, root of the likelihood ratio of document frequencies).

    The most significant come first, and no term hangs on later ones: those beyond a level are a lexicon. They are terms of the bounded sample, each in at least three of its documents.
    """
    counts = sample.select("text", "toxic").mapInArrow(_term_counts, "term string, stem boolean, toxic int, n long")
    both = counts.groupBy("term", "stem").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
    both = written_once(both, "toxicity-terms")
    sizes = both.where("term is null").first()
    if sizes is None or not sizes["a"] or not sizes["b"]:
        return {}
    share = sizes["a"] / (sizes["a"] + sizes["b"])
    odds = F.log((F.col("a") + 0.5) / (sizes["a"] + 1)) - F.log((F.col("b") + 0.5) / (sizes["b"] + 1))
    both_n = F.col("a") + F.col("b")
    part = lambda n, p: F.when(n > 0, n * F.log(n / (both_n * p))).otherwise(0.0)
    ratio = F.sqrt(2 * (part(F.col("a"), share) + part(F.col("b"), 1 - share)))
    best = both.where("term is not null and a >= 3").select("term", "stem", "a", odds.alias("w"), ratio.alias("z"))
    best = best.where((F.col("z") >= min(SIGNIFICANT)) & (F.col("w") >= 1.5))
    kept: dict[str, tuple[bool, float, float]] = {}
    documents: dict[str, int] = {}  # stem -> documents of its most frequent kept word
    for r in best.orderBy(F.desc("z"), "stem", "term").collect():
        term = r["term"]
        # what a kept term finds already needs no term of its own
        begun = term in kept or any(kept.get(term[:n], (False,))[0] for n in range(*STEM))
        # a stem whose documents are nearly those of one kept word says nothing more
        if begun or r["stem"] and documents.get(term, 0) >= 0.9 * r["a"]:
            continue
        kept[term] = (bool(r["stem"]), float(r["w"]), float(r["z"]))
        if not r["stem"]:
            for n in range(*STEM):
                documents[term[:n]] = max(documents.get(term[:n], 0), r["a"])
    return kept


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Coefficients, constant first, by Newton steps with a ridge on all but the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learns from labelled, not held out rows of ``doc_id, text``. Without rows of both classes all scores are 0.

    The part of the sample that gave the lexicon does not fit the weights, so chance finds are not trusted.
    """
    sample = written_once(fit_sample(docs, labels, rows), "toxicity-sample")
    terms = learned_terms(sample.where("part <> 0"))
    part, best = sample.where("part = 0").select("doc_id", "text", "toxic"), None
    for level in SIGNIFICANT:
        own = {t: v for t, v in terms.items() if v[2] >= level}
        if best is not None and len(own) == len(best.lexicon.weights):
            continue  # the lexicon before
        lex = lexicon(own)
        x, y = _known(part, lex)
        if len(set(y.tolist())) < 2:
            return Model(lex, np.array([-40.0] + [0.0] * len(FEATURES)))
        loss = _loss(x, y)
        if best is None or loss < least:
            best, least = Model(lex, logistic(x, y)), loss
    return best


def _known(part: DataFrame, lex: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the sample's part, by id: at most 2 * FIT_ROWS rows of seven numbers."""

    def rows_of(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            x = np.concatenate([features(t, lex) for t in parts(texts)])
            yield pa.record_batch(
                {"doc_id": batch.column(0), "x": pa.array(list(x), pa.list_(pa.float64())), "toxic": batch.column(2)})

    known = part.mapInArrow(rows_of, "doc_id long, x array<double>, toxic int").toPandas()
    known = known.sort_values("doc_id", kind="stable")
    x = np.stack(known["x"]) if len(known) else np.zeros((0, len(FEATURES)))
    return x, known["toxic"].to_numpy(float)


def _loss(x: np.ndarray, y: np.ndarray, folds: int = 5) -> float:
    """Mean logistic loss of each fold's rows under the weights of the others."""
    fold, total = np.arange(len(y)) % folds, 0.0
    for k in range(folds):
        w = logistic(x[fold != k], y[fold != k])
        z = (2 * y[fold == k] - 1) * (w[0] + x[fold == k] @ w[1:])
        total += float(np.logaddexp(0, -z).sum())
    return total / max(1, len(y))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row of ``doc_id, text``; a null text scores as an empty one."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array(held.value.scores(texts))})

    return docs.mapInArrow(score, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    Scores come from the text alone. Null and empty texts get the score of a text without terms; repeated rows get
    equal scores; without labels nothing is predicted toxic. An empty table gives no rows. Very long texts are scored
    whole; other columns of ``docs`` are not read and may have any name.
    """
    rows = id_and_text(docs, id_col, text_col)
    return scored(rows, fit(rows, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def not_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they were, in one pass without shuffle."""
    model = fit(id_and_text(docs, id_col, text_col), labels)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.scores([t or "" for t in texts]) < 0.5)

    return docs.where(accepted(docs[text_col].cast("string")))
