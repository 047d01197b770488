"""Conversation prefix trie, rolled up by centroid decomposition of its parent-edge forest.

A node is a distinct sequence of first turns. Its name is the sum, in two 64-bit lanes, of one hash for each place and turn,
so names are running sums along a conversation, and sums need no conversation to lie in one task: rows are sorted over all
tasks, each task sums its own, and what a conversation brought along from earlier tasks is added (one number for each task).

Subtree totals. A component is a connected part of the forest; at first it is the whole. Its centroid is the deepest node
that holds more than half of its weight (of member turns, which one grouping gives for all nodes). The centroid splits it:
the subtree of each of its children becomes a component, the part above it stays one. The total of all nodes from the
centroid down, one aggregate, is the centroid's own, and is added to each node on the path from the centroid to the
component's top, which also loses the centroid's weight. Large components are split so by rounds of joins, all at once, and
weights halve with each round; a component of at most LOCAL nodes is split further inside a task, down to single nodes.

Which child of the centroid a node lies under is read from the path of the node's smallest member, by a join on conversation
and depth; no paths are stored with nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import run_starts, small
from hirelake.session import written_once

#: Nodes that a task splits by itself.
LOCAL = 2_000
#: Conversation ids that are joined into one text at a time.
LISTED = 50_000
#: Children from which on a parent is looked up apart.
MANY_CHILDREN = 1_000
#: Conversations that share a head: the first of each so many.
FAMILY = 20

ROOT = bytes(16)
_WORD = r"[^\x20\x09-\x0D]+"


def joinable(df: DataFrame) -> DataFrame:
    """A stored frame, broadcast where it is small enough."""
    return F.broadcast(df) if small(df) else df


# --- running sums over rows sorted across tasks -------------------------------------------------------------------


def _with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``part`` and the row's place among its conversation's rows of this task."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        at = run_starts(conv)
        sizes = np.diff(np.append(at, len(conv)))
        place = np.arange(len(conv)) - np.repeat(at, sizes)
        if conv[0] == last:
            place[: sizes[0]] += count
        last, count = conv[-1], place[-1] + 1
        yield pa.record_batch([*batch.columns, pa.array(place), pa.array(np.full(len(conv), part))],
                              names=[*batch.schema.names, "place", "part"])


def _with_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace ``digest`` by the running sums of both lanes, this row included (``n0, n1``) and not (``p0, p1``)."""
    part, last, carried = TaskContext.get().partitionId(), None, np.zeros(2, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, place, digest, *rest = batch.columns
        hashed = b"".join(
            hashlib.blake2b(p.to_bytes(8, "little") + d, digest_size=16).digest()
            for p, d in zip(place.to_pylist(), digest.to_pylist(), strict=True))
        lanes = np.frombuffer(hashed, "<u8").reshape(-1, 2)
        conv = conv.to_numpy()
        at = run_starts(conv)
        sizes = np.diff(np.append(at, len(conv)))
        running = np.cumsum(lanes, axis=0, dtype=np.uint64)
        sums = running - np.repeat(running[at] - lanes[at], sizes, axis=0)
        if conv[0] == last:
            sums[: sizes[0]] += carried
        last, carried = conv[-1], sums[-1].copy()
        before = sums - lanes
        columns = [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in (*sums.T, *before.T)]
        yield pa.record_batch([*batch.columns[:2], *rest, *columns, pa.array(np.full(len(conv), part))],
                              names=["conv_id", "place", *batch.schema.names[3:], "n0", "n1", "p0", "p1", "part"])


def _brought_along(stored: DataFrame, values: list[str]) -> dict[tuple[int, int], list[int]]:
    """For each task that begins inside a conversation: what the conversation's rows of earlier tasks sum up to.

    ``values`` are running sums of a task; one row a task is collected, and one for each conversation that spans tasks.
    """
    bounds = stored.groupBy("part").agg(F.min("conv_id").alias("a"), F.max("conv_id").alias("b")).orderBy("part").collect()
    spanning = sorted({r["a"] for r, before in zip(bounds[1:], bounds, strict=False) if r["a"] == before["b"]})
    if not spanning:
        return {}
    last = F.max(F.struct("place", *values)).alias("last")
    ends = stored.where(F.col("conv_id").isin(spanning)).groupBy("conv_id", "part").agg(last).orderBy("conv_id", "part")
    found, conv, sums = {}, None, [0] * len(values)
    for r in ends.collect():
        if r["conv_id"] != conv:
            conv, sums = r["conv_id"], [0] * len(values)
        found[conv, r["part"]] = sums
        sums = [s + r["last"][v] for s, v in zip(sums, values, strict=True)]
    return found


def _brought(brought: dict[tuple[int, int], list[int]], batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Rows of a batch, and what is to be added to them."""
    conv, part = batch.column("conv_id").to_numpy(), batch.column("part").to_numpy()
    for p in np.unique(part).tolist():
        for c in np.unique(conv[part == p]).tolist() if len(brought) else ():
            if (c, p) in brought:
                yield np.flatnonzero((part == p) & (conv == c)), brought[c, p]


def numbered(rows: DataFrame) -> DataFrame:
    """``conv_id, digest, words, place``: rows in order of turn (null first), then role and text digest."""
    order = ["conv_id", "turn", "role", "digest"]
    dealt = rows.select(*order, "words").repartitionByRange(*order).sortWithinPartitions(*order)
    types = "conv_id long, turn long, role string, digest binary, words long, place long, part long"
    stored = written_once(dealt.mapInArrow(_with_places, types).drop("turn", "role"), "trie-places")
    brought = _brought_along(stored.withColumn("n", F.col("place") + 1), ["n"])

    def add(batches):
        for batch in batches:
            place = batch.column("place").to_numpy().copy()
            for at, (n,) in _brought(brought, batch):
                place[at] += n
            yield pa.record_batch([*batch.columns[:3], pa.array(place)], names=["conv_id", "digest", "words", "place"])

    return stored.mapInArrow(add, "conv_id long, digest binary, words long, place long")


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, words, turns`` of ``conv_id, place, digest, words, turns`` rows."""
    dealt = rebuilt.repartitionByRange("conv_id", "place").sortWithinPartitions("conv_id", "place")
    sums = ["n0", "n1"]
    types = "conv_id long, place long, words long, turns long, n0 long, n1 long, p0 long, p1 long, part long"
    stored = written_once(dealt.select("conv_id", "place", "digest", "words", "turns").mapInArrow(_with_sums, types), "trie-sums")
    brought = {k: [v % 2**64 for v in vs] for k, vs in _brought_along(stored, sums).items()}

    def add(batches):
        for batch in batches:
            lanes = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in ("n0", "n1", "p0", "p1")], axis=1)
            for at, (a, b) in _brought(brought, batch):
                lanes[at] += np.array([a, b, a, b], np.uint64)
            raw = lanes.tobytes()
            names = [[raw[i:i + 16] for i in range(k, len(raw), 32)] for k in (0, 16)]
            yield pa.record_batch(
                [batch.column("conv_id"), pa.array(batch.column("place").to_numpy() + 1), *[pa.array(n, pa.binary()) for n in names],
                 batch.column("words"), batch.column("turns")], names=["conv_id", "depth", "node", "parent", "words", "turns"])

    return stored.mapInArrow(add, "conv_id long, depth long, node binary, parent binary, words long, turns long")


# --- conversations and nodes ----------------------------------------------------------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, words``: texts go no further than here. Rows without conversation id belong to none."""
    c = conversations
    role, text = (F.coalesce(c[n].cast("string"), F.lit("")) for n in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = c.select(c["conv_id"].cast("long").alias("conv_id"), c["turn"].cast("long").alias("turn"), role.alias("role"),
                    digest.alias("digest"), F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"))
    return rows.where("conv_id IS NOT NULL")


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, turns`` of all conversations, and their rows ``conv_id, place, digest, words, turns`` after rebuilding."""
    rows = written_once(numbered(turns_of(conversations)), "trie-turns")
    own = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    own = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": head_length(F.col("conv_id"))})
    heads = rows.where("place < 3").groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "words"))).alias("head"))  # at most three
    own = own.join(heads, "base", "left").withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array()))
    own = own.withColumn("turns", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    own = written_once(own.select("conv_id", "h", "head", "turns"), "trie-conversations")
    first = own.select("conv_id", F.inline("head"), "turns").select("conv_id", "place", "digest", "words", "turns")
    shift = own.select("conv_id", "h", (F.size("head") - F.col("h")).alias("shift"), "turns")
    later = rows.join(shift, "conv_id").where(F.col("place") >= F.col("h"))
    later = later.select("conv_id", (F.col("place") + F.col("shift")).alias("place"), "digest", "words", "turns")
    return own.select("conv_id", "turns"), first.unionByName(later)


def nodes_of(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per node: smallest member, depth, parent, members, children, weight (member turns of its subtree), and the
    two values that are summed over subtrees."""
    found = paths.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"), F.sum("turns").alias("turns"), F.min("words").alias("words"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("turns").alias("turns"))
    root = root.where("n_convs > 0").withColumns({
        "node": F.lit(ROOT), "depth": F.lit(0).cast("long"), "parent": F.lit(None).cast("binary"), "words": F.lit(0).cast("long")})
    found = written_once(found.unionByName(root), "trie-nodes")
    children = found.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    n = F.coalesce("n_children", F.lit(0).cast("long"))
    return found.join(children, "node", "left").select(
        "node", "conv_id", "depth", "parent", "n_convs", n.alias("n_children"),
        (F.col("turns") - (F.col("depth") - 1) * F.col("n_convs")).alias("weight"),
        (n == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))


# --- centroid decomposition -----------------------------------------------------------------------------------------

_STATE = ["node", "conv_id", "depth", "parent", "weight", "leaf", "saved", "part_of", "more_leaves", "more_saved"]


def split_by_centroids(state: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split each component at its centroid. Returns the centroids with their totals and the new state of all others."""
    top = joinable(written_once(state.groupBy("part_of").agg(F.max("weight").alias("whole")), "trie-wholes"))
    heavy = state.join(top, "part_of").where(2 * F.col("weight") > F.col("whole")).groupBy("part_of").agg(
        F.min(F.struct("weight", (-F.col("depth")).alias("up"), "node", "conv_id")).alias("x"))
    centroids = written_once(heavy.select(
        "part_of", F.col("x.node").alias("x"), F.col("x.conv_id").alias("x_conv"), (-F.col("x.up")).alias("x_depth"),
        F.col("x.weight").alias("x_weight")), "trie-centroids")
    # the node below the centroid's depth on the path of a node's smallest member
    step = paths.join(joinable(centroids.select((F.col("x_depth") + 1).alias("depth")).distinct()), "depth", "left_semi")
    step = step.select("conv_id", F.col("depth").alias("s_depth"), F.col("node").alias("s_node"), F.col("parent").alias("s_parent"))
    at = state.join(joinable(centroids), "part_of").withColumn("s_depth", F.col("x_depth") + 1).join(step, ["conv_id", "s_depth"], "left")
    below = (F.col("depth") > F.col("x_depth")) & (F.coalesce("s_parent", F.lit(b"")) == F.col("x"))
    place = F.when(F.col("node") == F.col("x"), 0).when(below, 1).otherwise(2)
    placed = written_once(at.withColumn("place", place).select(*_STATE, "x", "place", "s_node"), "trie-placed")
    totals = written_once(placed.where("place < 2").groupBy("x").agg(
        F.sum("leaf").alias("t_leaves"), F.sum("saved").alias("t_saved")), "trie-totals")
    done = placed.where("place = 0").join(joinable(totals), "x").select(
        "node", (F.col("t_leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("t_saved") + F.col("more_saved")).alias("saved_tokens"))
    # the path from each centroid to its component's top: the parents along its smallest member, as far as the component goes
    ways = centroids.join(joinable(totals), "x").select("x", "x_depth", "x_weight", "t_leaves", "t_saved", F.col("x_conv").alias("conv_id"))
    way = paths.join(joinable(ways), "conv_id").where(F.col("depth") <= F.col("x_depth"))
    way = way.select(F.col("parent").alias("node"), "x", "x_weight", "t_leaves", "t_saved")
    way = written_once(way, "trie-paths")
    moved = placed.where("place > 0").join(joinable(way), ["node", "x"], "left")
    more = lambda c, d: (F.col(c) + F.coalesce(d, F.lit(0))).alias(c)
    rest = moved.select(
        "node", "conv_id", "depth", "parent", (F.col("weight") - F.coalesce("x_weight", F.lit(0))).alias("weight"), "leaf", "saved",
        F.when(F.col("place") == 1, F.col("s_node")).otherwise(F.col("part_of")).alias("part_of"),
        more("more_leaves", "t_leaves"), more("more_saved", "t_saved"))
    return done, rest


def rolled_up(parents: list[int], values: np.ndarray) -> np.ndarray:
    """Subtree sums of a component's nodes, listed from the top down (the top's parent is -1), by centroid decomposition."""
    children: list[list[int]] = [[] for _ in parents]
    for v, p in enumerate(parents):
        if p >= 0:
            children[p].append(v)
    result, added = np.zeros_like(values), np.zeros_like(values)
    gone = [False] * len(parents)
    size = [0] * len(parents)
    pending = [0] if parents else []
    while pending:
        top = pending.pop()
        members = [top]
        for v in members:
            members.extend(c for c in children[v] if not gone[c])
        for v in members:
            size[v] = 1
        for v in reversed(members):
            if v != top:
                size[parents[v]] += size[v]
        x, whole = top, size[top]
        while heavy := next((c for c in children[x] if not gone[c] and 2 * size[c] > whole), None):
            x = heavy
        below = [x]
        for v in below:
            below.extend(c for c in children[v] if not gone[c])
        total = values[below].sum(axis=0)
        result[x] = total + added[x]
        gone[x] = True
        v = x
        while v != top:
            v = parents[v]
            added[v] += total
        pending.extend(c for c in children[x] if not gone[c])
        if x != top:
            pending.append(top)
    return result


def _rolled_up_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components, each in rows that follow one another from the top down; no component has more than LOCAL nodes."""

    def whole(columns: dict[str, list]) -> tuple[list, np.ndarray]:
        number = {n: i for i, n in enumerate(columns["node"])}
        parents = [number.get(p, -1) if i else -1 for i, p in enumerate(columns["parent"])]
        values = np.array([columns["leaf"], columns["saved"]], np.int64).T
        more = np.array([columns["more_leaves"], columns["more_saved"]], np.int64).T
        return columns["node"], rolled_up(parents, values) + more

    def out(found):
        sums = np.concatenate([s for _, s in found])
        return pa.record_batch(
            [pa.array([n for names, _ in found for n in names], pa.binary()), pa.array(sums[:, 0]), pa.array(sums[:, 1])],
            names=["node", "n_leaves", "saved_tokens"])

    held: dict[str, list] = {}
    for batch in batches:
        columns = batch.to_pydict()
        for name, values in columns.items():
            columns[name] = held.get(name, []) + values
        part_of, found, begin = columns["part_of"], [], 0
        for i in range(1, len(part_of)):
            if part_of[i] != part_of[begin]:
                found.append(whole({n: v[begin:i] for n, v in columns.items()}))
                begin = i
        held = {n: v[begin:] for n, v in columns.items()}
        if found:
            yield out(found)
    if held.get("node"):
        yield out([whole(held)])


def subtree_totals(nodes: DataFrame, paths: DataFrame, local: int = LOCAL) -> DataFrame:
    """``node, n_leaves, saved_tokens`` over all nodes: leaves and saved tokens of each subtree."""
    zero = F.lit(0).cast("long")
    state = nodes.withColumns({"part_of": F.lit(ROOT), "more_leaves": zero, "more_saved": zero}).select(*_STATE)
    finished, totals = [], []
    while True:
        state = written_once(state, "trie-state")
        sizes = written_once(state.groupBy("part_of").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
        large = sizes.where(F.col("n") > local).select("part_of")
        if large.isEmpty():
            finished.append(state)
            break
        large = joinable(large)
        finished.append(state.join(large, "part_of", "left_anti").select(*_STATE))
        done, state = split_by_centroids(state.join(large, "part_of", "left_semi").select(*_STATE), paths)
        totals.append(done)
    rest = reduce(DataFrame.unionByName, finished).repartition("part_of").sortWithinPartitions("part_of", "depth")
    rest = rest.mapInArrow(_rolled_up_components, "node binary, n_leaves long, saved_tokens long")
    return reduce(DataFrame.unionByName, [*totals, rest])


# --- ends -----------------------------------------------------------------------------------------------------------


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a task, sorted by node and id, as texts of at most LISTED ids."""
    for batch in batches:
        nodes, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows, begin = [], 0
        for i in range(1, len(nodes) + 1):
            if i == len(nodes) or nodes[i] != nodes[begin] or i - begin == LISTED:
                rows.append((nodes[begin], convs[begin], ",".join(map(str, convs[begin:i]))))
                begin = i
        names, first, text = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.record_batch([pa.array(names, pa.binary()), pa.array(first, pa.int64()), pa.array(text, pa.string())], names=["node", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each node, in order, as one hash; only one text is held at a time."""
    node, sha = None, None
    for batch in batches:
        done = []
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if n == node:
                sha.update(b",")
            else:
                if sha:
                    done.append((node, sha.hexdigest()))
                node, sha = n, hashlib.sha256()
            sha.update(ids.encode())
        yield pa.record_batch([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"])
    if sha:
        yield pa.record_batch([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], names=["node", "ends_sha256"])


def ends(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes where conversations end.

    A node where a third of all conversations end is listed by many tasks; only the hash itself, which has one order, is
    made of these texts by one.
    """
    last = paths.where("depth = turns").select("node", "conv_id")
    last = last.unionByName(convs.where("turns = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    listed = last.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _listed, "node binary, first long, ids string")
    return listed.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node binary, ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Add ``parent_conv_id``. Parents of many children are few; they are looked up apart, so none makes a hot key."""
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    many = parents.where(F.col("n_children") > MANY_CHILDREN).select("parent", F.col("parent_conv_id").alias("_many"))
    few = parents.where(F.col("n_children") <= MANY_CHILDREN).drop("n_children")
    known = nodes.join(joinable(written_once(many, "trie-parents")), "parent", "left")
    apart = known.where("_many IS NOT NULL OR parent IS NULL").withColumnRenamed("_many", "parent_conv_id")
    rest = known.where("_many IS NULL AND parent IS NOT NULL").drop("_many").join(few, "parent", "left")
    return apart.unionByName(rest)


def prefix_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node of the rebuilt conversations' trie, the root included.

    Null roles and texts are empty; rows without conversation id belong to no conversation and are left out; rows of one turn
    follow by role and digest of the text, and repeated rows are turns of their own; a conversation may be of any length
    and have no turn left; other columns are not read. An empty table has no node. ``local`` changes where components are
    split, never a result.
    """
    convs, rows = rebuilt(conversations)
    paths = written_once(prefixes(rows), "trie-prefixes")
    nodes = written_once(nodes_of(convs, paths), "trie-weights")
    totals = subtree_totals(nodes, paths, local)
    whole = _with_parents(nodes).join(totals, "node").join(ends(convs, paths), "node", "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
