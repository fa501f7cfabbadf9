"""Phrase collocations from one FM-index per shard over word ids.

Method
------
A shard is a bounded amount of text of one language.  Its words become ids in a
sequence T, with 0 between pieces.  Two indexes are built, of T and of T reversed:
suffixes in the order of their first ``max_words`` symbols, and the symbol before
each (the Burrows-Wheeler transform).  The n-grams of one length are disjoint
intervals in both.  A right extension regroups the reversed transform by (symbol,
interval): every group is the interval of one longer n-gram, its size is the count,
and the symbols below it in the group give the place in the other index; a left
extension does the same with the roles exchanged.  Levels alternate, so the
n-grams of every length up to ``max_words`` come with their counts, each exactly
once and with no string compared.  An order by ``max_words`` symbols is enough for
intervals up to that depth.

How it runs
-----------
1. Tasks write shards (word ids and dictionary) to the shared folder.
2. Every shard's n-grams go to hash buckets (64-bit hashes, plus the bucket's bits,
   and counts); their number follows the words of the corpus.  A bucket adds up
   the shards and answers, for n-grams of ``min_count`` or more, one shard that
   holds each with its total.
3. That shard spells them; everything later is joins of the phrases' counts.
   A phrase that a longer one contains is at most as frequent as that one's
   extension by a single word, so left and right extensions settle containment.

Defined results: null text is empty, a null language is ``und``; copies and
repeated rows count; an empty table gives an empty result; other columns are
ignored; n-grams are added up by hash, phrases are spelled from the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbitlens.llm import arrays as A
from orbitlens.llm.shared import stored

SHARD_BYTES = 8 << 20
BUCKET_ROWS = 1 << 18           # n-grams that one bucket adds up, about
PIECE = A.SPACE.copy()          # bytes that end a piece
PIECE[:] = False
PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BREAK = PIECE.copy()            # bytes that end a word
BREAK[[0x20, 0x09]] = True


# ------------------------------------------------------------------ shards
def word_ids(raw: np.ndarray, off: np.ndarray):
    """(T, dictionary): ids from 1 in the order of the words' hashes, 0 before every piece and at the end."""
    raw = A.LOWER[raw]
    s, e, doc, h = A.words(raw, off, space=BREAK)
    if not len(s):
        return np.zeros(1, np.int64), []
    ends = np.concatenate(([0], np.cumsum(PIECE[raw], dtype=np.int32)))
    new = np.ones(len(s), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (ends[s[1:]] != ends[e[:-1]])
    _, at, ids = np.unique(h, return_index=True, return_inverse=True)
    t = np.zeros(len(s) + int(new.sum()) + 1, np.int64)
    t[np.arange(len(s)) + np.cumsum(new)] = ids + 1
    return t, [raw[a:z].tobytes() for a, z in zip(s[at], e[at])]


def _shards(batches):
    """(shard, lang, n_words, ids, words): texts of one language, SHARD_BYTES at most (a longer text alone)."""
    from pyspark import TaskContext

    pid, made = TaskContext.get().partitionId(), 0
    held: dict[str, list] = {}
    size: dict[str, int] = {}

    def flush(lang):
        nonlocal made
        raw, off = A.utf8(pa.chunked_array(held.pop(lang)))
        size.pop(lang)
        t, words = word_ids(raw, off)
        made += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([(pid << 32) + made]), pa.array([lang]), pa.array([int((t > 0).sum())]),
             pa.array([A.pack(t.astype(np.uint32))], pa.binary()), pa.array([A.pack(np.frombuffer(b"\n".join(words), np.uint8))], pa.binary())],
            names=["shard", "lang", "n_words", "ids", "words"])

    for batch in batches:
        lang = batch.column(0)
        for name in pc.unique(lang).to_pylist():
            own = batch.filter(pc.equal(lang, name)).select([1])
            for part in A.chunks(iter([own]), "text", SHARD_BYTES):
                n = part["text"].nbytes
                if name in size and size[name] + n > SHARD_BYTES:
                    yield flush(name)
                held.setdefault(name, []).extend(part["text"].chunks)
                size[name] = size.get(name, 0) + n
        while sum(size.values()) > 4 * SHARD_BYTES:                   # many languages share the room
            yield flush(max(size, key=size.get))
    for name in list(held):
        yield flush(name)


def _load(ids: bytes, words: bytes):
    """(T, dictionary, hash of every id; 0 has none)."""
    t = A.unpack(ids, np.uint32)[0].astype(np.int64)
    text = A.unpack(words, np.uint8)[0]
    dictionary = text.tobytes().split(b"\n") if len(text) else []
    newline = np.zeros(256, bool)
    newline[10] = True
    _, _, _, h = A.words(text, np.array([0, len(text)]), space=newline)
    return t, dictionary, np.concatenate((np.zeros(1, np.uint64), h))


# ------------------------------------------------------------------ FM-index
class Index:
    """Suffixes of ``t`` by their first ``depth`` symbols, the symbol before each, and the order of these."""

    def __init__(self, t: np.ndarray, depth: int):
        wide = int(t.max()) + 1
        key = t.copy()
        for d in range(1, depth):
            if int(key.max()) >= (1 << 62) // wide:
                key = np.unique(key, return_inverse=True)[1]
            key = key * wide + np.concatenate((t[d:], np.zeros(min(d, len(t)), np.int64)))
        self.suffix = np.argsort(key, kind="stable").astype(np.int32)
        del key
        self.before = t[self.suffix - 1].astype(np.int32)             # of the first suffix: the last symbol, a 0
        self.order = np.argsort(self.before, kind="stable").astype(np.int32)      # row i: suffix order[i] with its symbol in front


def extend(index: Index, lo: np.ndarray, other: np.ndarray, count: np.ndarray):
    """Every one-symbol extension of disjoint intervals: (lo, other, count) of the longer n-grams and their parents.

    ``lo`` is the intervals' place in ``index``, ``other`` their place in the opposite index."""
    label = np.full(len(index.order), -1, np.int32)
    rows = np.arange(int(count.sum())) + np.repeat(lo - (np.cumsum(count) - count), count)
    label[rows] = np.repeat(np.arange(len(lo), dtype=np.int32), count)
    del rows
    c, of = index.before[index.order], label[index.order]
    first = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (of[1:] != of[:-1]))))
    n = np.diff(np.append(first, len(c)))
    first, n = first[of[first] >= 0], n[of[first] >= 0]
    of, c = of[first], c[first]
    o = np.argsort(of, kind="stable")                                 # by interval, then symbol
    below = np.cumsum(n[o]) - n[o]
    start, size = A.spans(of[o])
    place = np.empty(len(o), np.int64)
    place[o] = other[of[o]] + below - np.repeat(below[start], size)
    word = c > 0
    return first[word], place[word], n[word], of[word]


def ngrams(t: np.ndarray, max_words: int):
    """For every length 1..max_words: (text positions of one occurrence of each n-gram, counts)."""
    if not (t > 0).any():
        return
    ahead, back = Index(t, max_words), Index(t[::-1].copy(), max_words)
    size = np.bincount(t)
    lo = (np.cumsum(size) - size)[1:]
    a, b, n = lo, lo.copy(), size[1:]                                 # words: the same interval in both indexes
    yield ahead.suffix[a], n
    for level in range(2, max_words + 1):
        if level % 2 == 0:
            b, a, n, _ = extend(back, b, a, n)                        # one word more on the right
        else:
            a, b, n, _ = extend(ahead, a, b, n)                       # one word more on the left
        yield ahead.suffix[a], n


def gram_hashes(t: np.ndarray, wh: np.ndarray, at: np.ndarray, size: int, lang: str):
    """Two independent hashes of the ``size`` words from every position ``at``."""
    import xxhash

    salt = np.uint64(xxhash.xxh64_intdigest(f"{size} {lang}"))
    out = []
    for which in range(2):
        h = np.full(len(at), salt, np.uint64)
        for j in range(size):
            h = h * A.ROLL[which] + wh[t[at + j]]
        out.append(A.mix(h))
    return out


# ------------------------------------------------------------------ counts
def _count(max_words: int, buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                t, _, wh = _load(row["ids"], row["words"])
                found = [(*gram_hashes(t, wh, at, m + 1, row["lang"]), n) for m, (at, n) in enumerate(ngrams(t, max_words))]
                if not found:
                    continue
                key, other, n = (np.concatenate(x) for x in zip(*found))
                bucket = (other >> np.uint64(20)) % np.uint64(buckets)
                o = np.lexsort((key, bucket))
                key, n, bucket = key[o], n[o].astype(np.uint32), bucket[o]
                first, size = A.spans(bucket)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[first].astype(np.int64)), pa.array(np.full(len(first), row["shard"])),
                     pa.array([A.pack(np.diff(key[f:f + k], prepend=np.uint64(0)), n[f:f + k]) for f, k in zip(first, size)], pa.binary())],
                    names=["bucket", "shard", "body"])
    return run


def _add_up(min_count: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"].to_numpy()
        parts = [A.unpack(b, np.uint64, np.uint32) for b in table["body"].to_pylist()]
        size = [len(k) for k, _ in parts]
        key = np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _ in parts])
        n = np.concatenate([c for _, c in parts]).astype(np.int64)
        o = np.argsort(key, kind="stable")
        first, _ = A.spans(key[o])
        total = np.add.reduceat(n[o], first)
        owner = np.minimum.reduceat(np.repeat(shard, size)[o], first)
        many = np.flatnonzero(total >= min_count)
        many = many[np.argsort(owner[many], kind="stable")]
        at, count = A.spans(owner[many])
        return pa.table({"shard": pa.array(owner[many][at], pa.int64()),
                         "found": pa.array([A.pack(key[o][first[many[a:a + k]]], total[many[a:a + k]]) for a, k in zip(at, count)], pa.binary())})
    return run


def _spell(max_words: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                t, words, wh = _load(row["ids"], row["words"])
                want, total = (np.concatenate(x) for x in zip(*(A.unpack(b, np.uint64, np.int64) for b in row["found"])))
                o = np.argsort(want)
                want, total = want[o], total[o]
                inside = np.ones(len(t), bool)
                phrase, size, a = [], [], []
                for m in range(1, max_words + 1):
                    inside[len(t) - m + 1:] = False
                    inside[:len(t) - m + 1] &= t[m - 1:] > 0
                    at = np.flatnonzero(inside)
                    key, _ = gram_hashes(t, wh, at, m, row["lang"])
                    hit = np.minimum(np.searchsorted(want, key), len(want) - 1)
                    ok = np.flatnonzero(want[hit] == key)
                    which, once = np.unique(hit[ok], return_index=True)
                    where = at[ok[once]]
                    phrase += [b" ".join([words[i - 1] for i in ids]) for ids in t[where[:, None] + np.arange(m)].tolist()]
                    size += [m] * len(which)
                    a.append(total[which])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(phrase), pa.string()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(size, pa.int32()),
                     pa.array(np.concatenate(a))], names=["lang", "phrase", "words", "a"])
    return run


def phrase_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = 3,
                  min_count: int = 10) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a) of every phrase of up to ``max_words`` words found ``min_count`` times, and (lang, n)."""
    spark = docs.sparkSession
    d = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    shards = stored(d.mapInArrow(_shards, "shard long, lang string, n_words long, ids binary, words binary"), "shards")
    n = shards.groupBy("lang").agg(F.sum("n_words").alias("n"))
    words = shards.agg(F.sum("n_words")).first()[0] or 0              # one number
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), max_words * words // BUCKET_ROWS)
    found = (shards.select("shard", "lang", "ids", "words").mapInArrow(_count(max_words, buckets), "bucket long, shard long, body binary")
             .groupBy("bucket").applyInArrow(_add_up(min_count), "shard long, found binary"))
    owned = found.groupBy("shard").agg(F.collect_list("found").alias("found"))          # a shard's own n-grams at most
    counts = stored(shards.join(owned, "shard").select("lang", "ids", "words", "found")
                    .mapInArrow(_spell(max_words), "lang string, phrase string, words int, a long"), "phrases")
    return counts, n


def phrase_mining(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, min_count: int = 10,
                  contained_percent: int = 50, top: int = 2000) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``max_words`` words: lang, rank, phrase, a, l, r, n, score, and the counts of
    the most frequent extensions by one word to the left and right (best_left, best_right; null if under ``min_count``)."""
    counts, n = phrase_counts(docs, text_col=text_col, lang_col=lang_col, max_words=max_words, min_count=min_count)
    part = lambda first, size: F.array_join(F.slice(F.split("phrase", " "), first, size), " ")
    cand = counts.where("words > 1")
    cuts = (cand.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .select("lang", "phrase", "words", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words")).alias("right")))
    side = lambda name, out: counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(out))
    # exact integers of up to 38 digits
    score = F.expr("cast((cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) "
                   "div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as long)")
    scored = (cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
              .withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")))
    longer = cand.where("words > 2")
    inner = (longer.select("lang", part(F.lit(1), F.col("words") - 1).alias("phrase"), F.lit(None).cast("long").alias("left"), F.col("a").alias("right"))
             .unionByName(longer.select("lang", part(F.lit(2), F.col("words") - 1).alias("phrase"), F.col("a").alias("left"),
                                        F.lit(None).cast("long").alias("right")))
             .groupBy("lang", "phrase").agg(F.max("left").alias("best_left"), F.max("right").alias("best_right")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .where(100 * F.coalesce(F.greatest("best_left", "best_right"), F.lit(0)) < contained_percent * F.col("a"))
            .select("lang", "phrase", "a", "c.l", "c.r", "c.score", "best_left", "best_right"))
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "best_left", "best_right")
