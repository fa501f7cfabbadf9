import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import brute
from orbitlens.llm import arrays as A
from orbitlens.llm import bbit_minhash as B
from orbitlens.llm.jaccard_join import shingle_sets


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("rounds", [0, 2])
def test_documents_match_brute_force(spark, sf01, rounds):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    out = B.near_duplicates(docs, star_rounds=rounds)
    assert got(out) == brute.jaccard_components(rows, 3, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_group_of_variants(spark):
    """Chains of edits whose ends do not link directly, and copies of one base that link only through it."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(800)]
    base = [rng.choice(vocab) for _ in range(120)]
    rows, now = [], list(base)
    for i in range(60):
        now = list(now)
        now[rng.randrange(len(now))] = rng.choice(vocab)
        rows.append((300 - i, " ".join(now)))
    other = [rng.choice(vocab) for _ in range(200)]
    rows.append((999, " ".join(other)))
    for i in range(60):
        now = list(other)
        for _ in range(rng.choice([2, 4, 6, 12])):
            now[rng.randrange(len(now))] = rng.choice(vocab)
        rows.append((400 + i, " ".join(now)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute.jaccard_components(rows, 3, 85)
    assert len({c for _, _, c in want}) > 3
    for rounds in (0, 1, 2):
        assert got(B.near_duplicates(df, star_rounds=rounds)) == want


def test_edges(spark):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, base), (2, base.upper()), (3, ""), (4, " \n\t"), (5, "one two"), (6, "One  two"), (7, "one two three"),
            (8, base + " x"), (10, "a " * 30_000), (11, "A " * 29_000), (12, "é " * 2), (13, "É " * 2), (14, base), (14, base)]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows] + [(15, None, 1, "c"), (None, base, 1, "c"), (5, None, 1, "c")],
                               "doc_id long, text string, n int, cls string")
    out = B.near_duplicates(df).collect()
    null = [r for r in out if r.doc_id is None]
    assert len(null) == 1 and null[0].component_id is None and null[0].n_shingles == 38 and null[0].kept
    # rows that share an id are documents of their own: (5, null) links with nothing
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out if r.doc_id is not None) == \
        sorted([*brute.jaccard_components(rows, 3, 85), (15, 0, 15), (5, 0, 5)])
    assert B.near_duplicates(df.limit(0)).count() == 0
    assert got(B.near_duplicates(df.where("doc_id in (3, 4)"))) == [(3, 0, 3), (4, 0, 4)]


def test_shared_id_does_not_link(spark):
    df = spark.createDataFrame([(3, "a b c d"), (5, "a b c d"), (5, "x y z"), (4, "x y z")], "doc_id long, text string")
    assert got(B.near_duplicates(df)) == [(3, 2, 3), (4, 1, 4), (5, 1, 4), (5, 2, 3)]


def pairs_at(share, n, count, rng):
    """``count`` pairs of sets of about ``n`` hashes with similarity just at ``share``."""
    for _ in range(count):
        both = int(np.ceil(share * n))
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        a, b = x[:both + (n - both) // 2], np.concatenate([x[:both], x[both + (n - both) // 2:]])
        yield a, b


@pytest.mark.parametrize("n", [8, 40, 400])
def test_pairs_at_the_threshold_meet_and_pass_the_estimate(spark, n):
    rng = np.random.default_rng(n)
    rows = []
    for a, b in pairs_at(0.85, n, 400, rng):
        low = B.minima(np.concatenate([a, b]), np.array([0, len(a)]))
        keys, sig = B.band_keys(low), B.signatures(low)
        assert (keys[0] == keys[1]).any()
        rows.append((sig[0].tolist(), sig[1].tolist()))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    est = [r[0] for r in df.select(B.estimate([F.col("a")[i] for i in range(B.LONGS)], [F.col("b")[i] for i in range(B.LONGS)])).collect()]
    assert min(est) >= 0.85 - B.SLACK
    assert abs(np.mean(est) - 0.85) < 0.03


def test_unrelated_sets_estimate_near_zero(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(200):
        low = B.minima(rng.integers(0, 2**63, 100, dtype=np.uint64), np.array([0, 50]))
        s = B.signatures(low)
        rows.append((s[0].tolist(), s[1].tolist()))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    est = [r[0] for r in df.select(B.estimate([F.col("a")[i] for i in range(B.LONGS)], [F.col("b")[i] for i in range(B.LONGS)])).collect()]
    assert abs(np.mean(est)) < 0.02 and max(est) < 0.25


def test_minima_are_those_of_the_sets():
    texts = [b"a b c d e", b"", b"a b c d f", b"one"]
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    h, d = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), off, 3)
    first, count = A.spans(d)
    low = B.minima(h, first)
    for j, (a, m) in enumerate(zip(first, count)):
        x = (h[a:a + m] >> np.uint64(32)).astype(np.uint32)
        assert (low[:, j] == [((x ^ B._XOR[i]) * B._MUL[i]).min() for i in range(B.HASHES)]).all()
