import math
import random

from pyspark.sql import functions as F

from llm import brute
from orbitlens.llm.quality_rules import ngram_buckets, quality_rules, words_of

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_columns_equal_brute_force(spark, sf01):
    docs, labels = (spark.read.parquet(f"{sf01}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = quality_rules(docs, labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in BASE) == brute.quality_base(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.llr >= -0.2)
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert all(r.kept or r.base_failed for r in rows if r.doc_id in good)
    assert sum(not r.kept for r in rows if r.doc_id in bad) >= 0.6 * len(bad)


def test_score_equals_its_definition(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    grams = {r.doc_id: r.g for r in df.withColumn("w", words_of(F.col("text"))).select("doc_id", ngram_buckets(F.col("w"), 50).alias("g")).collect()}
    raw, target = [1.0] * 50, [1.0] * 50
    for doc, g in grams.items():
        for b in g:
            raw[b] += 1
            target[b] += doc < 20 and doc % 2 == 1
    weight = [math.log(t / sum(target)) - math.log(r / sum(raw)) for t, r in zip(target, raw)]
    for r in quality_rules(df, labels, buckets=50).collect():
        g = grams[r.doc_id]
        assert abs(r.llr - (sum(weight[b] for b in g) / len(g) if g else 0.0)) < 1e-6


def test_edges(spark):
    texts = [None, "", " \n ", "a b c a b c", "x\n\nx\n x", "a a a a", "é # $" * 40, "same " * 60, "one\x0btwo\x0cthree\r\nfour", "w " * 60_000]
    df = spark.createDataFrame([(i, t, 1, "l") for i, t in enumerate(texts)] + [(None, "a b", 2, "l"), (3, texts[3], 1, "l")],
                               "doc_id long, text string, words int, lines string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_rules(df, none).collect()
    assert len(rows) == len(texts) + 2 and all(r.llr == 0 for r in rows)
    for r in rows:
        if r.doc_id is not None:
            assert tuple(r[c] for c in BASE) == brute.quality_base(texts[r.doc_id])
    assert quality_rules(df.limit(0), none).count() == 0
