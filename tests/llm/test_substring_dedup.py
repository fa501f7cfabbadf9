from llm import brute
from orbitlens.llm.substring_dedup import substring_dedup

SCHEMA = "doc_id long, text string, n_words int, part string"


def got(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect() if r.doc_id is not None)


def test_matches_brute_force_on_documents(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(substring_dedup(docs)) == sorted(brute.substring_dedup(rows))
    assert got(substring_dedup(docs, buckets=3)) == sorted(brute.substring_dedup(rows))


def test_edges(spark):
    base = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(base)), (2, "x y " + " ".join(base[5:25]) + " z"), (2, " ".join(base)), (3, None), (4, ""),
            (5, "\t\n "), (6, " ".join(["a"] * 30)), (7, " ".join(["a"] * 14)), (8, "é ü " * 13), (-9, "é ü  " * 20),
            (10, " ".join(base[:12])), (11, " ".join(base)), (12, " ".join(base * 400)), (12, " ".join(base * 400))]
    df = spark.createDataFrame([(i, t, 7, "p") for i, t in rows] + [(None, " ".join(base), 1, None)], SCHEMA)
    out = substring_dedup(df, buckets=4)
    assert got(out) == sorted(brute.substring_dedup(rows))
    null = [r for r in out.collect() if r.doc_id is None]
    assert len(null) == 1 and null[0].n_removed == 0 and null[0].n_words == 40
    assert substring_dedup(df.limit(0)).count() == 0


def test_intervals_merge(spark):
    base = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, base, 0, ""), (2, "q " + base, 0, "")], SCHEMA)
    row = {r.doc_id: r for r in substring_dedup(df, buckets=2).collect()}[2]
    assert [(i.start, i.end) for i in row.intervals] == [(1, 41)]
