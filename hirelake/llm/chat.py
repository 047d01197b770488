"""Chat formatting with Spark expressions only.

Template: each turn is ``<turn ROLE>`` text ``</turn>`` and a line feed; adjacent rows of one role are one turn, their texts
parted by ``<part/>``. Inside texts and roles ``\\`` is written ``\\\\``, ``<`` is ``\\l`` and ``>`` is ``\\g``, so no text can hold
a control string, and reading back gives the rows as they were. The loss mask is a list of spans of the formatted string in
code points: the texts of the roles that are learned, each without the control strings around it.

Rows of a conversation are collected as structs and sorted; a conversation becomes one output row and must fit into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings of the template.
OPEN, GAP, CLOSE, PART, END = "<turn ", ">", "</turn>", "<part/>", "\n"
LEARNED = ("assistant",)


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l")),
                     F.lit(">"), F.lit("\\g"))


def unescaped(text: Column) -> Column:
    """Pairs are read from the left: between two escaped backslashes every backslash begins ``\\l`` or ``\\g``."""
    pieces = F.split(text, r"\\\\", -1)
    plain = lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.array_join(F.transform(pieces, plain), "\\")


def turn_begins(turns: Column) -> Column:
    """Places (from 1) in sorted ``role, text`` structs at which the role changes. Null roles equal each other."""
    role = lambda i: F.element_at(turns, i)["role"]
    return F.filter(F.sequence(F.lit(1), F.size(turns)),
                    lambda i: (i == 1) | ~role(i).eqNullSafe(role(F.greatest(i - 1, F.lit(1)))))


def merged_turns(turns: Column, begins: Column) -> Column:
    """``role, texts`` structs: adjacent turns of one role are one. ``begins`` must be a stored column: each turn looks
    at the next place, so its expression would be computed anew for each turn."""
    return F.transform(begins, lambda b, k: F.struct(
        F.element_at(turns, b)["role"].alias("role"),
        F.transform(F.slice(turns, b, F.coalesce(F.get(begins, k + 1), F.size(turns) + 1) - b),
                    lambda t: t["text"]).alias("texts")))


def chat_format(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", learned: tuple[str, ...] = LEARNED,
) -> DataFrame:
    """``conv_id, formatted, loss_spans`` (array of ``start`` from 0 and ``length``, code points), one row a conversation.

    Rows follow their turn; ties follow role and text, repeated rows stay. A null text is empty, a null role is an
    empty role and never learned, a null turn comes first. Rows without conversation id are one conversation without
    id. An empty table gives no rows. Work grows with the turns of a conversation (and their sorting), also in one of
    very many turns; other columns of ``rows`` are not read and may have any name.
    """
    turns = rows.select(
        rows[conv_col].alias("conv_id"),
        F.struct(rows[turn_col].alias("turn"), F.coalesce(rows[role_col], F.lit("")).alias("role"),
                 F.coalesce(rows[text_col], F.lit("")).alias("text")).alias("t"))
    sorted_ = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    begun = sorted_.select("conv_id", "turns", turn_begins(F.col("turns")).alias("begins"))
    merged = begun.select("conv_id", merged_turns(F.col("turns"), F.col("begins")).alias("turns"))
    # every turn as pieces of text, each learned or not
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    pieces = F.flatten(F.transform("turns", lambda t: F.flatten(F.array(
        F.array(piece(F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(GAP)), no)),
        F.flatten(F.transform(t["texts"], lambda x, i: F.array(
            piece(F.when(i > 0, F.lit(PART)).otherwise(F.lit("")), no),
            piece(escaped(x), t["role"].isin(*learned))))),
        F.array(piece(F.lit(CLOSE + END), no))))))
    # a running total over each conversation's pieces places them; rows lie by conversation already, so nothing is shuffled
    each = merged.select("conv_id", F.posexplode(pieces).alias("k", "piece"))
    before = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    chars = F.length("piece.text")
    at = F.coalesce(F.sum(chars).over(before), F.lit(0)).cast("int")
    placed = each.select("conv_id", "k", "piece", at.alias("start"), chars.alias("length"))
    span = F.struct("start", "length")
    out = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("k", F.col("piece.text").alias("text")))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("piece.loss"), F.struct("k", span.alias("span"))))).alias("spans"))
    return out.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.transform("spans", lambda s: s["span"]).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """Rows of a formatted conversation, in order: array of ``role, text``."""
    turns = F.split(formatted, CLOSE + END, -1)
    whole = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def parts(turn: Column) -> Column:
        role = F.substring_index(F.substr(turn, F.lit(len(OPEN) + 1)), GAP, 1)
        body = F.substr(turn, F.lit(len(OPEN) + len(GAP) + 1) + F.length(role))
        # the lambda's variable holds the role, which is read once for all parts
        return F.flatten(F.transform(F.array(unescaped(role)), lambda r: F.transform(
            F.split(body, PART, -1), lambda x: F.struct(r.alias("role"), unescaped(x).alias("text")))))

    return F.flatten(F.transform(whole, parts))


#: Four bytes a code point, so that a span is found by its place without reading what stands before it.
_WIDE = "UTF-32"


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped: each span once, in order."""
    cut = lambda wide, s: F.decode(F.substr(wide, 4 * s["start"] + 1, 4 * s["length"]), _WIDE)
    return F.array_join(F.flatten(F.transform(F.array(F.encode(formatted, _WIDE)), lambda wide: F.transform(
        spans, lambda s: unescaped(cut(wide, s))))), "")
