"""Personal data by candidate gradient boosting, with DataFrame functions only.

1. Base spans (fixed rules, checked) stay as they are.
2. High-recall generators propose further spans that may overlap each other and what the base has dropped: a zero-width
   look-ahead at each possible start finds them, whatever an earlier match has swallowed.
3. Boosted trees score each candidate from features of its format and context. They learn from all texts: equal examples
   become one row with their number as its weight, so the fit holds their kinds, not their count. Positives are base spans as they stand, and the same spans rewritten in place
   in the ways in which people mask or group them (``planted``), which the base does not match. Negatives are what the
   base decides: candidates of the extent of a match that its checks drop, and, in the original text, unmasked candidates apart
   from all its matches. Masked candidates in the original text teach nothing: no rule has decided them.
4. For each kind a threshold is calibrated on the third of the documents that did not train: the lowest with PRECISION there.
   Candidates above it are selected, best first, where they overlap no span yet.

The trees become one CASE expression, so scoring is part of the same pass over the texts and nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import id_and_text
from hirelake.session import written_once

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
#: What decides on a candidate besides itself: characters before it, and more behind it than any generator takes.
BEFORE, BEHIND = 31, 1024
#: Matches whose places are added up together, and the size of the pieces (a power of two) that contexts are cut from.
RUN, BLOCK_BITS = 64, 9
#: Boosting: trees, their depth, and how many examples a leaf has at least.
TREES, DEPTH, LEAF = 10, 3, 5

#: The base rules. Possessive repeats and the look-behinds match the same spans as the plain rules, without trying a long
#: run again from each of its characters; \G lets a match begin right where the one before ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # all digits of a run in one match; runs of less than 13 can pass no check and are left out at once
    "card": r"[0-9](?:[ -]?+[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a rule or generator of the kind to find anything.
NEEDS = {"email": r"@|\b(?i:at)\b", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9][ -]?[0-9]", "phone": r"[0-9][ ().-]*[0-9]"}

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]{1,64}", "[A-Za-z0-9-]{1,63}"
GENERATORS = {
    "email": [
        rf"(?<![A-Za-z0-9._%+-])(?=({_LOCAL}@{_LABEL}(?:\.{_LABEL}){{1,8}}))",
        rf"(?<![A-Za-z0-9._%+-])(?=({_LOCAL} ?(?i:\(at\)|\[at\]) ?{_LABEL}(?: ?(?i:\(dot\)|\[dot\]|\.) ?{_LABEL}){{1,8}}))",
    ],
    "ip": [r"(?<![0-9])(?=([0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9]))"],
    "card": [  # in one piece, or in the groups that cards are written in
        r"(?<![0-9])(?=([0-9]{13,19})(?![0-9]))",
        r"(?<![0-9])(?=([0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,4}(?:[ -][0-9]{1,3})?)(?![0-9]))",
        r"(?<![0-9])(?=([0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9]))",
    ],
    "phone": [
        r"(?<![0-9+])(?=((?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4})(?![0-9]))",
        r"(?<![0-9+])(?=(\+?[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4})(?![0-9]))",
    ],
}
_CUES = {
    "email": r"(?i)mail|contact|write", "ip": r"(?i)\bip\b|addr|host|server", "card": r"(?i)card|visa|credit|account",
    "phone": r"(?i)phone|tel|call|fax|mobile",
}
#: Ways to write a base span that the base rule does not match: pattern and replacement, applied to the span.
PLANTED = {
    "email": [(r"^([^@]+)@(.+)\.([^.]+)$", "$1 (at) $2 (dot) $3"), (r"^([^@]+)@(.+)\.([^.]+)$", "$1[at]$2[dot]$3"),
              (r"^([^@]+)@(.+)$", "$1 [at] $2")],
    "phone": [(r"^.*?([0-9]{3})[^0-9]*([0-9]{3})[^0-9]*([0-9]{4})$", "($1) $2-$3"),
              (r"^.*?([0-9]{3})[^0-9]*([0-9]{3})[^0-9]*([0-9]{4})$", "$1-$2-$3"),
              (r"^.*?([0-9]{3})[^0-9]*([0-9]{3})[^0-9]*([0-9]{4})$", "$1.$2.$3")],
}
FEATURES = (
    "digits", "chars", "valid", "plus", "brackets", "separators", "kinds_of_separators", "letter_before", "sign_before",
    "letter_after", "sign_after", "cue", "is_email", "is_ip", "is_card", "is_phone", "masked",
    "groups",
)


# --- spans ------------------------------------------------------------------------------------------------------


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` names it and in whatever lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spans(text: str, pattern: str, group: int = 0, shift: int = 0) -> Column:
    """Matches in ``text`` (an SQL expression) as ``start`` (code points from 0), ``end`` and ``hit``.

    Places are running totals of the lengths of matches and of the pieces between them: over runs of RUN matches first,
    then inside each run, so that no long array is copied once for each of its elements. One SQL expression, as it is
    built many times. A match of no width leaves what it captures to the piece behind it.
    """
    quoted = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    ahead = "length(p.gap)" if group else "length(p.gap) + length(p.hit)"
    none = "cast(array() as array<struct<start:int,end:int,hit:string>>)"
    placed = f"""aggregate(run, named_struct('at', at[k], 'out', {none}), (a, p) -> named_struct(
        'at', a.at + {ahead}, 'out', concat(a.out, array(named_struct(
            'start', a.at + length(p.gap) + {shift}, 'end', a.at + length(p.gap) + length(p.hit) + {shift},
            'hit', p.hit)))), a -> a.out)"""
    begins = f"""aggregate(runs, named_struct('at', 0, 'out', cast(array() as array<int>)), (a, run) -> named_struct(
        'at', aggregate(run, a.at, (at, p) -> at + {ahead}), 'out', concat(a.out, array(a.at))), a -> a.out)"""
    in_runs = f"""transform(array(transform(sequence(0, int((size(ps) - 1) div {RUN})), k -> slice(ps, k * {RUN} + 1, {RUN}))),
        runs -> transform(array({begins}), at -> flatten(transform(runs, (run, k) -> {placed})))[0])[0]"""
    return F.expr(f"""transform(array(regexp_extract_all({text}, {quoted}, {group})), hits -> if(size(hits) = 0, {none},
        transform(array(split({text}, {quoted}, -1)), gaps -> transform(
            array(transform(hits, (hit, i) -> named_struct('gap', gaps[i], 'hit', hit))), ps -> {in_runs})[0])[0]))[0]""")


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(number)
    places = F.sequence(F.lit(1), F.length(number))
    digit = lambda i: F.substr(back, i, F.lit(1))
    value = lambda i: F.when(i % 2 == 1, digit(i)).otherwise(
        F.translate(digit(i), "0123456789", "0246813579")).cast("int")
    return F.aggregate(places, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    """The checks of the base rules."""
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(hit, r"\."), lambda p: F.when(F.length(part(p)) > 3, F.lit(False)).otherwise(
            F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = digits(hit)
        return F.when(F.length(n).between(13, 19), luhn(n)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(hit)).between(9, 15)
    return F.lit(True)


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def ranked(points: Column, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` of a function that tells how many of ``points`` are at most x: sorted once, then halved for each x."""
    powers = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))

    def with_sorted(s: Column) -> Column:
        return body(lambda x: F.aggregate(s["steps"], F.lit(0), lambda k, step: F.when(
            F.get(s["points"], k + step - 1) <= x, k + step).otherwise(k)))

    return bound(bound(points, lambda p: F.struct(
        F.sort_array(p).alias("points"), F.filter(powers, lambda step: step <= F.size(p)).alias("steps"))), with_sorted)


def meeting(found: Column, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` of a test whether a span overlaps any of ``found``: more of them begin before its end than end by its start."""
    return ranked(F.transform(found, lambda b: b["start"]), lambda begun: ranked(
        F.transform(found, lambda b: b["end"]), lambda ended: body(lambda c: begun(c["end"] - 1) > ended(c["start"]))))


# --- candidates -------------------------------------------------------------------------------------------------


_AT = {name: i for i, name in enumerate(FEATURES)}
_MASKED = r"(?i)\(at\)|\[at\]"


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("double"), F.lit(0.0))


def placed_in_context(kind: str) -> Column:
    """Candidates with the character ``before``, the one ``after`` and the ``context`` of 30 characters before them.

    These are cut from ``blocks``, the text in pieces, so that no text is read from its start for each candidate.
    """
    size = 1 << BLOCK_BITS

    def piece(at: str, length: str) -> str:
        two = " , ".join(f"coalesce(get(blocks, int(({at}) div {size}) + {i}), '')" for i in (0, 1))
        return f"substr(concat({two}), ({at}) % {size} + 1, {length})"

    return F.expr(f"""transform(more_{kind}, c -> named_struct('start', c.start, 'end', c.end, 'hit', c.hit,
        'before', if(c.start > 0, {piece('c.start - 1', '1')}, ''), 'after', {piece('c.end', '1')},
        'context', {piece('greatest(c.start - 30, 0)', 'least(c.start, 30)')}))""").alias(f"more_{kind}")


def features(kind: str, c: Column) -> Column:
    """FEATURES of a candidate as an array of doubles."""
    hit, before, after, context = (c[name] for name in ("hit", "before", "after", "context"))
    n = digits(hit)
    signs = F.regexp_replace(hit, r"[^ ().-]+", "")
    return F.array(
        F.length(n).cast("double"), F.length(hit).cast("double"), _flag(valid(kind, hit)), _flag(hit.startswith("+")),
        _flag(F.contains(hit, F.lit("("))), F.length(signs).cast("double"),
        reduce(lambda a, b: a + b, (_flag(F.contains(signs, F.lit(s))) for s in " .-")),
        _flag(before.rlike(r"\p{L}")), _flag(before.rlike(r"[^\p{L}\s]")),
        _flag(after.rlike(r"\p{L}")), _flag(after.rlike(r"[^\p{L}\s.,;:]")),
        _flag(context.rlike(_CUES[kind])), *(F.lit(float(kind == k)) for k in KINDS),
        _flag(hit.rlike(_MASKED)), F.size(F.split(hit, "[^0-9]+")).cast("double"))


def candidates(rows: DataFrame, *more: str) -> DataFrame:
    """``text`` and columns ``more`` with columns ``base_KIND`` and ``more_KIND``: all base matches with ``ok``, all candidates with
    features; candidates that are cut short by another of the same start are kept beside it."""
    text = F.col("text")
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    out = rows.select(*more, F.coalesce("text", F.lit("")).alias("text"))
    raw = []
    for kind in KINDS:
        may = text.rlike(NEEDS[kind])
        raw.append(F.when(may, spans("text", BASE[kind])).otherwise(none).alias(f"base_{kind}"))
        # a space before the text, as a zero-width match at its very start would be no place to split
        found = [spans("concat(' ', text)", g, 1, -1) for g in GENERATORS[kind]]
        raw.append(F.when(may, F.concat(*found)).otherwise(none).alias(f"more_{kind}"))
    out = out.select(*more, "text", *raw)
    some = reduce(lambda a, b: a + b, (F.size(f"more_{k}") for k in KINDS)) > 0
    blocks = F.when(some, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << BLOCK_BITS}}}"), F.lit(0)))
    out = out.select(*more, *(f"{a}_{k}" for k in KINDS for a in ("base", "more")), blocks.alias("blocks"))
    out = out.select(*more, *(f"base_{k}" for k in KINDS), *map(placed_in_context, KINDS))

    def with_check(kind: str) -> Column:
        return F.transform(f"base_{kind}", lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), valid(kind, c["hit"]).alias("ok"))).alias(f"base_{kind}")

    def with_features(kind: str) -> Column:
        return F.transform(f"more_{kind}", lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), features(kind, c).alias("x"))).alias(f"more_{kind}")

    checked = [make(k) for k in KINDS for make in (with_check, with_features)]
    return out.select(*more, *checked)


# --- learning ---------------------------------------------------------------------------------------------------


def planted(rows: DataFrame) -> DataFrame:
    """``part, kind, text, start, end``: pieces of ``part, text`` rows around one base span, written in a way of PLANTED.

    Of each text the first span of each kind that has such ways; the way follows from the text's hash. Positions are those
    of the rewritten span in the piece, which holds all that decides on a candidate there.
    """
    def sown(kind: str, ways: list[tuple[str, str]]) -> Column:
        way = F.pmod(F.xxhash64("text"), F.lit(len(ways)))
        rewritten = lambda s: F.coalesce(
            *[F.when(way == i, F.regexp_replace(s["hit"], *w)) for i, w in enumerate(ways)])

        def piece(s: Column, new: Column) -> Column:
            lead = F.least(s["start"], F.lit(BEFORE))
            text = F.concat(
                F.substr("text", s["start"] - lead + 1, lead), new, F.substr("text", s["end"] + 1, F.lit(BEHIND)))
            return F.when(new != s["hit"], F.struct(
                F.lit(kind).alias("kind"), text.alias("text"), lead.alias("start"), (lead + F.length(new)).alias("end")))

        valid_ones = F.filter(spans("text", BASE[kind]), lambda c: valid(kind, c["hit"]))
        first = F.when(F.col("text").rlike(NEEDS[kind]), F.get(valid_ones, F.lit(0)))
        return bound(first, lambda s: bound(rewritten(s), lambda new: piece(s, new)))

    pieces = F.array_compact(F.array(*(sown(kind, ways) for kind, ways in PLANTED.items())))
    # the outer form, here and below: the inner one makes Catalyst evaluate the array a second time to test its size
    return rows.select("part", F.inline_outer(pieces)).where("kind is not null")


def examples(rows: DataFrame) -> DataFrame:
    """``kind, part, x, y, n``: candidates in ``doc_id, text`` rows that the base decides, and planted positives, with how
    many they are. A third of the ids, or of the texts where the id is null, is ``part`` 0."""
    part = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(3)).alias("part")
    dealt = rows.where("text is not null").select(part, "text")

    def decided(kind: str, meets: Callable) -> Column:
        # apart from all matches, a form that the base rule reads whole is no such data; other forms it has not decided
        plain = lambda c: c["x"][_AT["masked"]] == 0 if kind != "phone" else c["x"][_AT["valid"]] == 0

        def judged(c: Column, begun: Callable) -> Column:
            b = F.get(F.col(f"base_{kind}"), begun(c["start"]) - 1)  # the last match of the kind that begins by then
            return bound(F.when((b["start"] == c["start"]) & (b["end"] == c["end"]), b["ok"]), lambda ok: F.when(
                ok, 1.0).when(~ok | (~meets(c) & plain(c)), 0.0))

        return ranked(F.transform(f"base_{kind}", lambda b: b["start"]), lambda begun: F.transform(
            f"more_{kind}", lambda c: F.struct(F.lit(kind).alias("kind"), c["x"].alias("x"), judged(c, begun).alias("y"))))

    matches = F.concat(*(F.col(f"base_{k}") for k in KINDS))
    found = candidates(dealt, "part").select("part", F.inline_outer(
        meeting(matches, lambda meets: F.concat(*(decided(k, meets) for k in KINDS)))))
    again = candidates(planted(dealt), "part", "kind", "start", "end")
    of_kind = F.coalesce(*(F.when(F.col("kind") == k, F.col(f"more_{k}")) for k in PLANTED))
    hit = F.filter(of_kind, lambda c: (c["start"] == F.col("start")) & (c["end"] == F.col("end")))
    again = again.select("part", "kind", F.inline_outer(F.transform(
        hit, lambda c: F.struct(c["x"].alias("x"), F.lit(1.0).alias("y")))))
    known = found.unionByName(again).where("y is not null")
    return known.groupBy("kind", "part", "x", "y").agg(F.count(F.lit(1)).alias("n"))


def tree_expression(debug: str, x: Column | None = None) -> str:
    """SQL over the array ``x`` for one regression tree, from Spark's own printout of it."""
    lines = [line.strip() for line in debug.splitlines() if re.match(r"\s*(If|Else|Predict)", line)]

    def node(at: int) -> tuple[str, int]:
        if m := re.match(r"Predict: (\S+)", lines[at]):
            return f"{float(m[1])!r}D", at + 1
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at])
        left, at = node(at + 1)
        right, at = node(at + 1)  # past its Else
        return f"CASE WHEN c.x[{m[1]}] <= {float(m[2])!r}D THEN {left} ELSE {right} END", at

    return node(0)[0]


def boosted(train: DataFrame) -> str:
    """SQL for the probability of a candidate ``c``, from boosted trees fitted to ``x, y`` of weight ``n``.

    A leaf has LEAF examples at least, by weight. Spark draws the cut points from max(bins squared, 10,000) rows: the bins are
    as many as it takes to read all rows there.
    """
    rows = train.select(
        array_to_vector(F.col("x")).alias("features"), F.col("y").alias("label"), F.col("n").cast("double").alias("weight"))
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("weight")).first()
    model = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH if size["weight"] >= 2 * LEAF else 0, stepSize=0.3, seed=1, weightCol="weight",
        minWeightFractionPerNode=min((LEAF - 0.5) / size["weight"], 0.49),
        maxBins=max(32, math.isqrt(size["rows"]) + 1)).fit(rows)
    trees = zip(model.treeWeights, model.trees, strict=True)
    total = " + ".join(f"{float(w)!r}D * ({tree_expression(t.toDebugString)})" for w, t in trees)
    return f"1D / (1D + exp(-2D * ({total})))"


def thresholds(scores: DataFrame) -> dict[str, float]:
    """For each kind the lowest probability (in steps of 0.001) from which on PRECISION holds; none if there is none."""
    steps = scores.groupBy("kind", F.round("p", 3).alias("p")).agg(
        F.sum(F.col("y") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect()  # at most 1001 steps a kind
    out = {}
    for kind in KINDS:
        good = n = 0
        for row in sorted((r for r in steps if r["kind"] == kind), key=lambda r: -r["p"]):
            good, n = good + row["good"], n + row["n"]
            if good / n >= PRECISION:
                out[kind] = row["p"] - 0.0005
    return out


def learn(rows: DataFrame) -> tuple[str, dict[str, float]]:
    """The score expression and the thresholds, from all of ``doc_id, text``; no thresholds if a class is missing."""
    known = written_once(examples(rows), "pii-examples")
    train = known.where("part <> 0")
    if train.select("y").distinct().count() < 2:
        return "0D", {}
    score = boosted(train)
    held = known.where("part = 0").select("kind", "y", "n", F.struct("x").alias("c")).select(
        "kind", "y", "n", F.expr(score).alias("p"))
    return score, thresholds(held)


# --- the operator -----------------------------------------------------------------------------------------------


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, base, added``: arrays of ``kind`` (number in KINDS), ``start, end``, in that order; one row a row.

    Positions are code points, ends exclusive. A null or empty text has no spans; repeated rows get equal spans; texts of any
    length are searched whole, in time about proportional to it unless learned spans overlap in one long chain, and other columns, whatever their names, are not read. Where the texts show no candidate of both classes, nothing is added. An empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col)
    score, least = learn(rows)
    found = candidates(rows, "doc_id")
    place = "array<struct<kind:int,start:int,end:int>>"
    kept = lambda i, k: F.transform(F.filter(f"base_{k}", lambda b: b["ok"]), lambda b: F.struct(
        F.lit(i).alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    base = F.concat(*(kept(i, k) for i, k in enumerate(KINDS))).cast(place)
    scored = [
        F.expr(f"""transform(filter(transform(more_{k}, c -> named_struct(
            'p', {score}, 'kind', {i}, 'start', c.start, 'end', c.end)), c -> c.p >= {least[k]!r}D), c -> c)""")
        for i, k in enumerate(KINDS) if k in least
    ]
    if not scored:
        return found.select("doc_id", base.alias("base"), F.array().cast(place).alias("added"))
    found = found.select("doc_id", base.alias("base"), F.concat(*scored).alias("more"))
    free = meeting(F.col("base"), lambda meets: F.filter("more", lambda c: ~meets(c)))
    return found.select("doc_id", "base", F.array_sort(bound(free, _best)).alias("added"))


def _best(free: Column) -> Column:
    """Spans of ``free`` (p, kind, start, end) that do not overlap: best first, then the longer, then the earlier.

    Only spans of one cluster can overlap. A cluster begins where as many spans have ended as began before it.
    """
    place = "array<struct<kind:int,start:int,end:int>>"

    def chosen(cluster: Column) -> Column:
        order = F.array_sort(F.transform(cluster, lambda c: F.struct(
            (-c["p"]).alias("p"), (c["start"] - c["end"]).alias("size"), c["start"].alias("start"),
            c["kind"].alias("kind"), c["end"].alias("end"))))
        return F.aggregate(order, F.array().cast(place), lambda a, c: F.when(
            F.exists(a, lambda s: overlaps(s, c)), a).otherwise(F.concat(a, F.array(F.struct(
                c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))))

    def clusters(c: Column) -> Column:
        first = ranked(F.transform(c, lambda s: s["end"]), lambda ended: F.array_compact(
            F.transform(c, lambda s, i: F.when(ended(s["start"]) == i, i))))
        return bound(first, lambda at: F.transform(at, lambda a, j: F.slice(
            c, a + 1, F.coalesce(F.get(at, j + 1), F.size(c)) - a)))

    by_start = F.sort_array(F.transform(free, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), c["p"].alias("p"))))
    return F.flatten(F.transform(bound(by_start, clusters), chosen))


def listing(found: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(found: DataFrame) -> DataFrame:
    """Spans as counts of the base, a digest of the base and a listing of all spans."""
    number = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id", *(number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(listing(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listing(F.array_sort(F.concat("base", "added"))).alias("spans"))


def redacted(text: Column, found: Column) -> Column:
    """``text`` with each span (not overlapping, by start) replaced by its kind in brackets."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    out = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("text")),
        lambda a, s: F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(
            a["text"], F.substr(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))),
            F.lit("["), F.get(names, s["kind"]), F.lit("]")).alias("text")))
    return F.concat(out["text"], F.substr(text, out["at"] + 1))
