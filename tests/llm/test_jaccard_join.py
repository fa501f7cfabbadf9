import random

import pytest

from llm import brute
from orbitlens.llm.components import components
from orbitlens.llm.jaccard_join import jaccard_join


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("rounds", [0, 2])
def test_documents_match_brute_force(spark, sf01, rounds):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert got(jaccard_join(docs, star_rounds=rounds)) == brute.jaccard_components(rows)


def test_group_of_variants_and_a_common_passage(spark):
    """Chains of edits whose ends do not link directly, beside texts that share most of a passage."""
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocab) for _ in range(90)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, now = [], list(base)
    for i in range(70):
        now = list(now)
        now[rng.randrange(len(now))] = rng.choice(vocab)
        rows.append((100 - i, " ".join(now)))
    for i in range(70):
        rows.append((200 + i, " ".join(passage[: rng.randint(45, 60)] + [rng.choice(vocab) for _ in range(rng.randint(0, 40))])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.jaccard_components(rows)
    assert len({c for _, _, c in want}) > 5
    for rounds in (0, 1, 3):
        assert got(jaccard_join(df, star_rounds=rounds, buckets=5)) == want


def test_edges(spark):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, base), (2, base.upper()), (3, ""), (4, " \n\t"), (5, "one two"), (6, "One  two"), (7, "one two three"),
            (8, base + " x"), (9, base), (9, "one two"), (10, "a " * 30_000), (11, "A " * 29_000), (12, "é " * 7), (13, "É " * 7)]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows] + [(14, None, 1, "c"), (None, base, 1, "c")],
                               "doc_id long, text string, n int, cls string")
    out = jaccard_join(df, buckets=3).collect()
    null = [r for r in out if r.doc_id is None]
    assert len(null) == 1 and null[0].component_id is None and null[0].n_shingles == 36
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out if r.doc_id is not None) == \
        sorted([*brute.jaccard_components(rows), (14, 0, 14)])
    assert jaccard_join(df.limit(0)).count() == 0
    assert got(jaccard_join(df.where("doc_id in (3, 4)"))) == [(3, 0, 3), (4, 0, 4)]


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    order = rng.sample(range(1000), 400)
    links = [(order[i], order[i + 1]) for i in range(399) if i % 100 != 99]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    for k in range(4):
        part = order[100 * k:100 * k + 100]
        assert {got[x] for x in part} == {min(part)}
