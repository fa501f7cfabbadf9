import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from orbitlens.llm import prefix_trie as P


def rebuilt(rows):
    """{conv_id: [(role, text), ...]} of (conv_id, turn, role, text) rows without ties."""
    own = defaultdict(list)
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out, sums = [], {}
    for p in sorted(members, key=len, reverse=True):
        m = members[p]
        saved = (len(m) - 1) * (len(p[-1][1]) if p else 0) + sum(sums[k][0] for k in kids[p])
        leaves = sum(sums[k][1] for k in kids[p]) if kids[p] else 1
        sums[p] = saved, leaves
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_conversations_match_brute_force(spark, sf01):
    t = spark.read.parquet(f"{sf01}/conversations.parquet")
    rows = [tuple(r) for r in t.select("conv_id", "turn", "role", "text").collect()]
    assert got(P.conversation_trie(t)) == trie(rebuilt(rows))


@pytest.mark.parametrize("block", [7, 20_000])
def test_copies_long_conversations_and_small_blocks(spark, monkeypatch, block):
    """Few different turns: deep shared prefixes over segments, blocks and partitions; copies; one very long conversation."""
    rng = random.Random(block)
    rows = []
    for c in range(400):
        n = rng.choice([1, 2, 3, 5, 8, 15, 16, 17, 31, 32, 33, 70]) if c != 205 else 900
        branch = random.Random(c % 7)
        for t in range(n):
            text = "hello" * branch.randint(1, 3) if c % 3 else rng.choice(["a", "bb", "ccc"])
            rows.append((c, t, "user" if t % 2 == 0 else None, text))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    if block == 7:                                       # workers import the shipped module: hand the size over by closure
        monkeypatch.setattr(P, "_tries", small_blocks(block))
    assert got(P.conversation_trie(df)) == trie(rebuilt(rows))


def small_blocks(size):
    def run(batches):
        import pyarrow as pa

        from orbitlens.llm import prefix_trie
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                yield prefix_trie._nodes(pa.Table.from_batches([batch.slice(at, size)]))
    return run


def test_edges(spark):
    rows = [(1, None, "user", "x"), (1, 0, None, None), (1, 1, "user", "é" * 40_000), (-5, 3, "", ""), (300, 0, "a", "b"), (None, 0, "a", "b"),
            (2**40, 0, "user", "x"), (7, -3, "user", "x"), (7, 2, "assistant", "y"), (8, 1, "u", "ab"), (9, 1, "ua", "b")]
    df = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], SCHEMA + ", length int, pos string, size int")
    assert got(P.conversation_trie(df)) == trie(rebuilt(rows))
    assert P.conversation_trie(df.limit(0)).count() == 0
    # a conversation whose own turns all lie in its missing head has no turns, and ends at the root
    c = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 > 1)
    lone = P.conversation_trie(spark.createDataFrame([(c, 0, "user", "x")], SCHEMA)).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in lone] == [(c, 0, 1, 0, 1, 0)]
    assert lone[0].ends_sha256 == hashlib.sha256(str(c).encode()).hexdigest()


def test_repeated_rows_each_count(spark):
    rows = [(100, 0, "user", "x")] * 3 + [(200, 0, "user", "x")] * 2
    out = got(P.conversation_trie(spark.createDataFrame(rows, SCHEMA)))
    assert [(r[0], r[1], r[3]) for r in out] == [(100, 0, 2), (100, 1, 2), (100, 2, 2), (100, 3, 1)]


def test_extents_are_those_of_a_scan():
    rng = np.random.default_rng(3)
    lcp = rng.integers(0, 5, 300)
    lcp[0] = 0
    table = P.sparse_table(lcp)
    row, depth = np.repeat(np.arange(300), 5), np.tile(np.arange(1, 6), 300)
    lo, hi = P.left_extent(table, row, depth), P.right_extent(table, row, depth)
    for i, d, a, z in zip(row, depth, lo, hi):
        x = i
        while x >= 1 and lcp[x] >= d:
            x -= 1
        y = i
        while y + 1 < 300 and lcp[y + 1] >= d:
            y += 1
        assert (a, z) == (x, y)
