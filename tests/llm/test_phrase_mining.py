import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orbitlens.llm import phrase_mining as P


def pieces(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def mined(rows, max_words=3, min_count=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        covered = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    covered[p[i:i + m]] = max(covered[p[i:i + m]], a)
        best = []
        for p, a in cand.items():
            if 100 * covered[p] >= 50 * a:
                continue
            s, _, l, r = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            best.append((-s, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(best)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_documents_match_brute_force(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").select("text", "lang")
    want = mined([tuple(r) for r in docs.collect()])
    assert len(want) > 1000
    assert got(P.phrase_mining(docs.repartition(5))) == want


def text(rng, n, vocab):
    return "".join(rng.choice(vocab) + rng.choice([" ", " ", "  ", "\t", " ", ". ", "\n", ",", "\x1f", " "]) for _ in range(n))


@pytest.mark.parametrize("max_words", [2, 3, 5])
def test_random_texts(spark, max_words):
    rng = random.Random(max_words)
    vocab = ["a", "B", "b", "cc", "é", "É", "日本", "x.y", "-", "tok'en", "\U0001f600"]
    rows = [(text(rng, rng.randint(0, 120), vocab), rng.choice(["en", "de", None, "", "und"])) for _ in range(150)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert got(P.phrase_mining(df, max_words=max_words, min_count=4, top=300)) == mined(rows, max_words, 4, 300)


def test_edges(spark):
    rows = [(None, "en"), ("", "en"), (" ,.\n", None), ("new york " * 20_000, "en"), ("New York!" * 30, "en")] + [("one two three", "fr")] * 12
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, phrase string, n int")
    assert got(P.phrase_mining(df)) == mined(rows)
    assert P.phrase_mining(df.limit(0)).count() == 0
    assert P.phrase_mining(df.where("lang is null or text = ''")).count() == 0


@pytest.mark.parametrize("words", [3, 50])
def test_index_counts_every_ngram_once(words):
    rng = np.random.default_rng(words)
    t = rng.integers(0, words, 3000)
    t[0] = t[-1] = 0
    _, dense = np.unique(t, return_inverse=True)
    for m, (at, n) in enumerate(P.ngrams(dense, 5)):
        grams = Counter(tuple(g) for g in np.lib.stride_tricks.sliding_window_view(dense, m + 1).tolist() if 0 not in g)
        assert len(at) == len(grams)
        assert {tuple(dense[a:a + m + 1].tolist()): k for a, k in zip(at, n)} == grams


def test_scores_pass_64_bits(spark):
    """a * a * 1000000 over 2**63: the counts are joined as they would come from a large corpus."""
    from pyspark.sql import functions as F
    e = ("cast((cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) "
         "div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as long)")
    vals = [(10**12 + 7, 10**13 + 1, 3 * 10**12), (999999999999999, 999999999999999, 999999999999999), (10, 17, 13)]
    df = spark.createDataFrame(vals, "a long, l long, r long").withColumn("s", F.expr(e))
    assert [r.s for r in df.collect()] == [1000000 * a * a // (x * y) for a, x, y in vals]
