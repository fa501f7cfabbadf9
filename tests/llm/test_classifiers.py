import zlib

import numpy as np

from orbitlens.llm.quality_crf import Chains, line_features, quality_crf
from orbitlens.llm.queries import QUERIES
from orbitlens.llm.toxicity import toxicity_chain


def out_of_sample(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def labelled(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}


def test_quality_on_held_out_labels(spark, sf01):
    labels = labelled(spark, sf01)
    rows = QUERIES["op2_quality_crf"](spark, sf01).collect()
    assert len(rows) == spark.read.parquet(f"{sf01}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == out_of_sample(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id].quality for r in held]) >= 0.95


def test_toxicity_on_held_out_labels(spark, sf01):
    labels = labelled(spark, sf01)
    held = [r for r in QUERIES["op1_toxicity"](spark, sf01).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.toxic == labels[r.doc_id].toxic for r in held]) >= 0.93


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    doc = np.array([0, 0, 0, 1, 2, 2])
    unary, trans = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
    marginal, pair, _ = Chains(doc).run(unary, trans)
    want, pairs = np.zeros((6, 2)), np.zeros((2, 2))
    for a, z in ((0, 3), (3, 4), (4, 6)):
        paths = []
        for code in range(2 ** (z - a)):
            y = [(code >> i) & 1 for i in range(z - a)]
            paths.append((y, np.exp(sum(unary[a + i, v] for i, v in enumerate(y)) + sum(trans[u, v] for u, v in zip(y, y[1:])))))
        total = sum(w for _, w in paths)
        for y, w in paths:
            for i, v in enumerate(y):
                want[a + i, v] += w / total
            for u, v in zip(y, y[1:]):
                pairs[u, v] += w / total
    assert np.allclose(marginal, want) and np.allclose(pair, pairs)


def test_lines_of_odd_texts():
    texts = ["", "a\n\nb\n", "\n", "one line", "x\nx"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    x, doc, weight = line_features(raw, off)
    assert np.bincount(doc).tolist() == [1, 4, 2, 1, 2] and np.isfinite(x).all()
    assert weight.tolist() == [1, 2, 1, 2, 1, 1, 1, 8, 2, 1]           # a line counts with its line feed
    assert x[-1, 10] == 1 and x[-2, 10] == 0                     # the second x repeats a line


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "a b\nc", 1), (3, "a " * 60_000, 1), (3, "a " * 60_000, 1)],
                               "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, None), (1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for f, p in ((lambda d, s: quality_crf(d, s), "score"), (lambda d, s: toxicity_chain(d, s, ["quality", "toxic"]), "p_toxic")):
        rows = f(df, labels).collect()
        assert len(rows) == 5 and all(0 <= r[p] <= 1 for r in rows)
        assert [r.held_out for r in rows if r.doc_id is None] == [False]
        assert f(df.limit(0), labels).count() == 0 and f(df, labels.limit(0)).count() == 5


def plain_probability(link, parts, earlier):
    """A link's output for one document, word part by word part."""
    if not link.ready:
        return min(max(link.share, 1e-4), 1 - 1e-4)
    s = link.b + sum(v * e for v, e in zip(link.v, earlier)) + sum(link.w[link.slot[p]] for p in set(parts) if link.slot[p] >= 0)
    return 1 / (1 + np.exp(-s))


def test_chain_equals_a_plain_one():
    """Three categories: each link is the one fitted on out-of-fold probabilities of those before it, and scores run down the chain."""
    from orbitlens.llm import toxicity as T
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words, rng.integers(5, 30))) + (" bad" * int(i % 3 == 0)) + (" worse" * int(i % 5 == 0)) for i in range(200)] + ["", "w1"]
    y = np.array([["bad" in t, "worse" in t, "bad" in t and "worse" in t] for t in texts], float)
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    part, doc = T.distinct(*T.parts(raw, off))
    rows = [part[doc == i].astype(np.int64) for i in range(len(texts))]
    weight = np.ones(len(texts))
    chain = T.train(rows, y, weight, features=50)
    earlier = np.zeros((len(texts), 0))
    for k in range(3):
        want = T.Link(rows, y[:, k], earlier, 50, weight)
        assert np.allclose(want.w, chain[k].w) and np.allclose(want.v, chain[k].v) and np.isclose(want.b, chain[k].b)
        out = np.zeros(len(texts))
        for f in range(5):
            i = [j for j in range(len(texts)) if j % 5 != f]
            link = T.Link([rows[j] for j in i], y[i, k], earlier[i], 50, weight[i])
            for j in range(f, len(texts), 5):
                out[j] = plain_probability(link, rows[j].tolist(), earlier[j])
        earlier = np.column_stack([earlier, out])
    got = T.score(chain, raw, off)
    for i, r in enumerate(rows):
        before = []
        for k in range(3):
            before.append(plain_probability(chain[k], r.tolist(), before))
        assert np.allclose(got[i], before)
    assert ((got[:, 2] >= 0.5) == (y[:, 2] == 1)).mean() > 0.95


def test_trained_models_score_odd_texts(spark):
    """Labels of both values: a trained model meets nulls, empty and very long texts."""
    rows = [(i, ("nice words of a day\nmore lines here\n" if i % 2 else "awful xx zz junk\nxx\n") * (i % 4 + 1), 1) for i in range(120)]
    rows += [(1000, None, 1), (1001, "", 1), (None, "awful xx", 1), (1002, "xx " * 60_000, 1), (1002, "xx " * 60_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(120)], "doc_id long, quality int, toxic int")
    for f, p in ((lambda d, s: quality_crf(d, s), "score"), (lambda d, s: toxicity_chain(d, s, ["quality", "toxic"]), "p_toxic")):
        out = f(df, labels).collect()
        assert len(out) == len(rows) and all(0 <= r[p] <= 1 for r in out)
        by = {r.doc_id: r[p] for r in out}
        assert abs(by[0] - by[1]) > 0.3 and len({r[p] for r in out if r.doc_id == 1002}) == 1
