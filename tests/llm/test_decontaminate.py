import random

from orbitlens.llm.decontaminate import Items, drop_leaks, find_leaks, nearest, normal


def plain(pattern, text):
    """Least edit distance of the pattern to any substring, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


def test_distance_equals_the_table():
    rng = random.Random(3)
    for _ in range(300):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 90)))
        bits = {}
        for i, c in enumerate(p):
            bits[c] = bits.get(c, 0) | 1 << i
        assert nearest(bits, len(p), t, 0)[0] == min(plain(p, t), len(p))


def edited(text, n, rng):
    t = list(text)
    for _ in range(n):
        i = rng.randrange(len(t))
        t[i:i + 1] = rng.choice([[], [t[i], "q"], ["z"]])
    return "".join(t)


def test_finds_exactly_the_texts_within_budget():
    rng = random.Random(5)
    words = ["the", "tion", "and", "erre", "onto", "ing", "hea", "shwh"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(10, 25)))) for i in range(12)]
    block = Items(items, 0.08)
    hits = 0
    for _ in range(60):
        n = rng.randrange(12)
        k = block.budget[n]
        text = normal(" ".join(rng.choice(words) for _ in range(20)) + edited(items[n][1], rng.randint(0, k + 3), rng)
                      + " ".join(rng.choice(words) for _ in range(20)))
        want = {i: x for i in range(12) if (x := plain(items[i][1], text)) <= block.budget[i]}
        assert {i: x for i, x, _, _ in block.matches(text)} == want
        hits += bool(want)
    assert hits > 20


def test_documents(spark, sf01):
    docs, bench = spark.read.parquet(f"{sf01}/documents.parquet"), spark.read.parquet(f"{sf01}/benchmark.parquet")
    items = {r.item_id: normal(r.text) for r in bench.collect()}
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in normal(r.text)}
    found = find_leaks(docs, bench).collect()
    assert exact and exact <= {(r.doc_id, r.item_id) for r in found}
    assert {(r.doc_id, r.item_id) for r in found if r.distance == 0} == exact
    small = find_leaks(docs, bench, block_chars=1000).collect()          # many blocks, the same rows
    assert sorted(small) == sorted(found)
    left = {r.doc_id for r in drop_leaks(docs, bench).collect()}
    assert left == {r.doc_id for r in docs.collect()} - {r.doc_id for r in found}


def test_edges(spark):
    item = "The Quick  brown fox jumps over\nthe lazy dog again and again"
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, "short"), (None, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "x " * 40_000 + item.upper() + " y" * 40_000, 1),
                                  (3, "the quick brwn fox jumps over the lazy dogg again and again", 2), (None, item, 3)],
                                 "doc_id long, text string, distance int")
    rows = sorted(((r.doc_id or -1), r.item_id, r.distance) for r in find_leaks(docs, bench).collect())
    assert rows == [(-1, 1, 0), (-1, 2, 0), (3, 1, 0), (3, 1, 2), (3, 2, 0), (3, 2, 2)]
    assert find_leaks(docs, bench.limit(0)).count() == 0 and find_leaks(docs.limit(0), bench).count() == 0
    assert drop_leaks(docs, bench).count() == 2 and drop_leaks(docs, bench.limit(0)).count() == 5


def test_items_without_an_id_and_short_items(spark):
    item = "an item that has no id and is long enough to be sought with edits"
    bench = spark.createDataFrame([(None, item), (1, "Short  question?"), (2, "  "), (3, "\u4f60\u597d\u5417"), (4, "cat")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so {item} it goes"), (2, "a short question? yes"), (3, "SHORT QUESTION?"), (4, "a short questionable"), (5, "unshort question?"),
                                  (6, "x\u4f60\u597d\u5417\u6211"), (7, "concatenate cats"), (8, "no-cat."), (9, f"so {item.replace('long', 'lng')}"), (10, "")],
                                 "doc_id long, text string")
    assert sorted(r.doc_id for r in drop_leaks(docs, bench).collect()) == [4, 5, 7, 10]
    rows = sorted((r.doc_id, r.item_id, r.distance, r.budget, r.start, r.end) for r in find_leaks(docs, bench).collect())
    assert rows == [(2, 1, 0, 0, 2, 17), (3, 1, 0, 0, 0, 15), (6, 3, 0, 0, 1, 4), (8, 4, 0, 0, 3, 6)]
