"""Alignment, quality and prefix trie against plain Python, and their edge cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelake.llm import alignment, prefix_trie, quality
from hirelake.llm.queries import QUERIES

# --- alignment ------------------------------------------------------------------------------------------------------


def plain_alignment(texts):
    """All figures from character loops over both token lists, A by the public library for its file."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    shown = {}  # the printable sign of each byte in a byte-level vocabulary
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in visible]
    shown = {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(rest)}
    del decoders
    found = []
    for text in texts:
        ia = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ib = b.encode(text or "")
        ba = [bytes(shown[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
        whole = (" " + (text or "")).encode()
        found.append(None if not text or b"".join(ba) != whole or b"".join(bb) != whole else (ia, ba, ib, bb))
    counts, rows = Counter(), []
    for f in found:
        links, groups = [], []
        if f:
            ia, ba, ib, bb = f
            spans = []
            for tokens in (ba, bb):
                at, own = 0, []
                for t in tokens:
                    own.append((at, at + len(t)))
                    at += len(t)
                spans.append(own)
            links = [(x, y) for x, (s, e) in zip(ia, spans[0], strict=True) for y, (p, q) in zip(ib, spans[1], strict=True) if s < q and p < e]
            cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
            at = 0
            for cut in cuts:
                sides = [",".join(str(i) for i, (s, e) in zip(ids, own, strict=True) if at <= s < cut) for ids, own in zip((ia, ib), spans, strict=True)]
                groups.append("|".join(sides))
                at = cut
        counts.update(links)
        rows.append((f, links, groups))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (len(f[0]) if f else 0, len(f[2]) if f else 0, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links),
         sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if f else "")
        for f, links, groups in rows]


TEXTS = [None, "", " ", "the the the cat", "the the the cat", "naïve “quotes” 😀 ünïcode", "a▁b", "<s> </s> <|endoftext|> <0x41>", "\n\n\t x  y\u0000z",
         "日本語のテキスト", "x" * 700, "Two  spaces\r\nand 12345 numbers, punctuation!? é", "<unk>", "ﬁ ½ ①", " leading", "trailing "]


@pytest.mark.parametrize("held", [alignment.HELD_PAIRS, 3, 0])
def test_alignment_is_that_of_plain_loops(spark, make, held):
    docs = make([(i, t) for i, t in enumerate(TEXTS)])
    got = alignment.alignment(docs, held=held).orderBy("doc_id").collect()
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [tuple(r[c] for c in columns) for r in got] == plain_alignment(TEXTS)


def test_alignment_of_a_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    docs = [r for r in docs if r.text is None or len(r.text) < 1500]
    frame = spark.createDataFrame(docs)
    got = alignment.alignment(frame).orderBy("doc_id").collect()
    assert [tuple(r[1:5]) + tuple(r[5:]) for r in got] == plain_alignment([r.text for r in docs])
    whole = QUERIES["op11_align"](spark, sf_dir)
    assert whole.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_alignment_edges(spark, make):
    assert alignment.alignment(make([])).collect() == []
    rows = alignment.alignment(make([(None, "a b"), (None, "a b"), (7, None)])).collect()
    assert sorted(r.n_a for r in rows) == [0, rows[0].n_a or rows[1].n_a, rows[1].n_a or rows[2].n_a]
    long = alignment.alignment(make([(1, "word " * 400_000)])).head()
    assert long.n_groups > 300_000 and long.count_sum >= long.n_links


def test_chunks_cover_all_texts(monkeypatch):
    monkeypatch.setattr(alignment, "BATCH_BYTES", 5)
    assert list(alignment._chunks(["aaa", "bb", None, "cccccccc", "d"])) == [(0, 3), (3, 4), (4, 5)]
    assert list(alignment._chunks([])) == []


# --- quality --------------------------------------------------------------------------------------------------------


def test_quality_scores_are_those_of_the_formula(spark, sf_dir):
    import zstandard

    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit(docs.select("doc_id", "text"), labels)
    rows = quality.scored(docs.select("doc_id", "text"), model).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    assert len(rows) == len(texts) and model.dictionaries
    for r in rows[:60]:
        text, sizes = texts[r.doc_id], []
        for d in model.dictionaries:
            c = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
            n = max(1, -(-len(text) // quality.BLOCK))
            step = max(1, -(-len(text) // n))
            sizes.append(sum(len(c.compress(text[i:i + step])) for i in range(0, len(text), step)))
        good, bad = sizes
        f = 10 * (bad - good) / (bad + good) if text else 0
        length = np.log2(1 + len(text)) / 10
        z = model.coefficients @ [1, f, length, f * length]
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-6


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    found = QUERIES["op12_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = found[found.held_out]
    ranks, good = held.score.rank(), held.quality == 1
    auc = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc >= 0.95
    assert (held.predicted[good] == 1).mean() >= 0.98 and (held.predicted[~good] == 0).mean() >= 0.75
    assert abs(held.score.mean() - good.mean()) < 0.05


def test_quality_never_learns_from_held_out_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality.quality(docs, x).collect())) for x in (labels, flipped))
    assert a == b and {r[1] for r in a} == {True, False}


def test_quality_edges(spark, make):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    docs = make([(1, "a b"), (2, None), (2, ""), (None, "x " * 500_000)])
    rows = quality.quality(docs, labels).collect()
    assert len(rows) == 4 and len({r.score for r in rows}) == 1 and 0 < rows[0].score < 1
    assert quality.quality(docs, labels.limit(0)).head().score == 0.5
    assert quality.quality(make([]), labels).collect() == []


def test_blocks_are_the_whole_text():
    for n in (0, 1, 2047, 2048, 2049, 5000, 4097):
        text = bytes(i % 251 for i in range(n))
        parts = quality.blocks(text)
        assert b"".join(parts) == text and max(map(len, parts)) <= quality.BLOCK


# --- prefix trie ----------------------------------------------------------------------------------------------------


def plain_trie(rows):
    """Rows (conv_id, turn, role, text) → set of result rows."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", hashlib.sha256(f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest(), x or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(ts)] for c, ts in turns.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    import re
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0)
        kids = children[node]
        totals[node] = (sum(totals[k][0] for k in kids) or 1 if kids else 1, saved + sum(totals[k][1] for k in kids))
    return sorted(
        (min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), len(children[n]), *totals[n],
         hashlib.sha256(",".join(map(str, sorted(c for c in cs if len(whole[c]) == len(n)))).encode()).hexdigest())
        for n, cs in members.items())


def trie(df, **options):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, prefix_trie.prefix_trie(df, **options).select(*columns).collect()))


SCHEMA = "conv_id long, turn long, role string, text string, node string, part int"


@pytest.mark.parametrize("local", [prefix_trie.LOCAL, 12])
def test_trie_is_that_of_plain_loops(spark, sf_dir, local):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert trie(df, local=local) == plain_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_trie_of_hot_long_and_odd_conversations(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(40, 160) for t in range(3)]  # copies
    rows += [(c, 0, "user", "t0") for c in range(200, 260)]  # a hot first turn
    rows += [(c, 1, "user", f"own {c}") for c in range(200, 260)]
    rows += [(500, t, "user", "a  b") for t in range(300)]  # one long conversation, over several tasks
    rows += [(501, t, "user", "a  b") for t in range(150)]
    rows += [(-7, 0, "user", None), (-7, 1, None, ""), (-20, 0, "x", "y"), (-27, None, "n", "n"), (-27, 0, "n", "m"), (None, 0, "a", "b")]
    rows += [(600, 1, "b", "x"), (600, 1, "a", "x"), (600, 1, "a", "x"), (600, None, "z", "  \t")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    expected = plain_trie(rows)
    for local in (prefix_trie.LOCAL, 25, 1):
        assert trie(df.repartition(5), local=local) == expected


def test_trie_of_nothing(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []
    assert trie(spark.createDataFrame([(None, 0, "a", "b", "", 0)], SCHEMA)) == []


def test_local_rollup_is_the_subtree_sum():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 200):
        for shape in ("chain", "star", "random"):
            parents = [-1] + [i - 1 if shape == "chain" else 0 if shape == "star" else int(rng.integers(i)) for i in range(1, n)]
            values = rng.integers(0, 9, (n, 2))
            sums = values.copy()
            for v in range(n - 1, 0, -1):
                sums[parents[v]] += sums[v]
            assert (prefix_trie.rolled_up(parents, values) == sums).all()


# --- PII: what the trees add ----------------------------------------------------------------------------------------


def test_trees_add_masked_and_grouped_forms_and_little_else(spark):
    """Forms that the base does not match, planted in whole documents; grouped numbers that are no phones beside them."""
    from hirelake.llm import pii

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    docs = docs.where("text is not null").orderBy(F.xxhash64("doc_id")).limit(4000).collect()
    rng = np.random.default_rng(5)
    ways = [lambda i: f"john.{i} (at) example (dot) com", lambda i: f"anna{i}[at]mail[dot]example[dot]org", lambda i: f"bob{i} [at] example.net",
            lambda i: f"(212) 555-{1000 + i}", lambda i: f"212-555-{1000 + i}", lambda i: f"415.555.{2000 + i}",
            lambda i: f"in {1900 + i % 100}-01-15 or 12 345 678", lambda i: f"4{i:03d} 1234 5678 9010"]
    rows, wanted = [], {}
    for i, r in enumerate(docs):
        words = r.text.split(" ")
        text = r.text
        if i < 400:
            at = int(rng.integers(len(words) + 1))
            form = ways[i % len(ways)](i)
            start = sum(len(w) + 1 for w in words[:at])
            text = " ".join([*words[:at], form, *words[at:]])
            if i % len(ways) < 6:
                wanted[r.doc_id] = (start, start + len(form))
        rows.append((r.doc_id, text))
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = [(r.doc_id, s["start"], s["end"]) for r in found for s in r.added]
    caught = sum((d, *span) in set(added) for d, span in wanted.items())
    assert caught >= 0.9 * len(wanted)
    assert sum(wanted.get(d) == (a, b) for d, a, b in added) >= 0.98 * len(added)


# --- sharding: rounds end by themselves -----------------------------------------------------------------------------


def test_no_request_that_fits_is_open_and_cuts_are_told(spark, make):
    from hirelake.llm import sharding

    rows = [(i, "big") for i in range(60)] + [(100 + i, f"pair {i // 2}") for i in range(60)] + [(300 + i, f"own {i}") for i in range(40)]
    out = sharding.shards(make(rows), number=8).collect()
    groups = {}
    for r, (doc, text) in zip(sorted(out, key=lambda r: r.doc_id), sorted(rows), strict=True):
        assert r.doc_id == doc and r.size == len(text) + 1 and r.text_crc32 == zlib.crc32(text.encode())
        groups.setdefault(text, []).append(r)
    for text, members in groups.items():
        cut = len({r.shard for r in members}) - 1
        assert {r.cut_edges for r in members} == {cut}
    linked = make([r for r in rows if not r[1].startswith("own")])
    linked = linked.select(F.col("doc_id").alias("uid"), F.col("text").alias("digest"))
    quota = np.array([20] * 8)
    placed = sharding.propagate(linked, quota).collect()
    free = quota - np.bincount([r.shard for r in placed], minlength=8)
    blocks = defaultdict(Counter)
    for r in placed:
        blocks[dict(rows)[r.uid]][r.shard] += 1
    for own in blocks.values():
        for a in own:
            for b in own:
                assert a == b or own[b] < own[a] or free[b] <= 1  # a shard with room has called all that fits
    sizes = Counter(r.shard for r in out)
    assert set(sizes.values()) == {20}
