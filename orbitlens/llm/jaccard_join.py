"""N-gram Jaccard join with adaptive multi-match prefixes.

Two texts link when the Jaccard similarity of their word-shingle sets is at
least ``percent`` / 100; the result is exact.

Method
------
* Sets are ordered by one global order: tokens that a count sketch of fixed
  size finds frequent come last, the others by hash.  In that order, sets that
  link share at least L tokens among their first ``n - ceil(t n) + L`` tokens.
* L is chosen per text: the sketch estimates how many rows and candidates each
  prefix length would bring, and the cheapest of ``LEVELS`` wins.  A pair is
  held to the smaller L of its two texts, and verified only with that many
  shared prefix tokens (and lengths that allow the similarity).
* Equal sets are one class and enter once; copies never make pairs.
* Prefix tokens meet in hash buckets; tokens of a single class are done with.

Groups: only connectedness is asked for, so no group emits its pairs.  In each
star round every class is verified against its best match among the tokens'
pivots, classes that fall into one component need no more links, and only
tokens that still touch several components go on.  The last round is exact:
all remaining candidate pairs across components are verified.

Defined results: a set of fewer than ``size`` words is the whole sequence as one
shingle; null, empty and blank texts have no shingles and link with nothing
(component: their own id); a null id gets a null component and links with
nothing; rows with one id share a component if any of their texts links;
repeated rows each give their row; an empty table gives an empty result; other
columns are ignored.  Shingles and sets are compared by 64-bit hash while
candidates are sought and verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import arrays as A
from orbitlens.llm.components import components
from orbitlens.llm.shared import bucket_number, stored

LEVELS = (1, 2, 4, 8)
VERIFY_COST = 20               # a verification in units of one prefix row
SKETCH_BITS, SKETCH_GROUPS = 18, 32
BUCKET_BYTES = 16 << 20        # input bytes per bucket of prefix tokens


def shingle_sets(raw: np.ndarray, off: np.ndarray, size: int):
    """(hash, text index) of every distinct shingle, by text and hash; ASCII letters in lower case."""
    _, _, doc, wh = A.words(A.LOWER[raw], off)
    n = len(off) - 1
    h = A.rolling(wh, size)
    ok = A.within(doc, size)
    h, d = h[ok], doc[:len(ok)][ok]
    count = np.bincount(doc, minlength=n)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.concatenate(([0], np.cumsum(count)))
        extra = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            has = count[short] > j
            at = np.minimum(first[short] + j, len(wh) - 1)
            extra = np.where(has, extra * A.ROLL[1] + wh[at], extra)
        h = np.concatenate([h, A.mix(extra + count[short].astype(np.uint64))])
        d = np.concatenate([d, short])
        o = np.argsort(d, kind="stable")
        h, d = h[o], d[o]
    for a, m in zip(*A.spans(d)):
        h[a:a + m].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[keep], d[keep]


def set_keys(h: np.ndarray, d: np.ndarray, n: int):
    """(set size, 64-bit key of the set) by text."""
    size = np.bincount(d, minlength=n)
    key = np.zeros(n, np.uint64)
    first, _ = A.spans(d)
    if len(first):
        key[d[first]] = np.add.reduceat(A.mix(h + A.ROLL[0]), first)
    return size, A.mix(key + size.astype(np.uint64)).view(np.int64)


# ------------------------------------------------------- pass 1: classes, sketch
def _survey(size: int):
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for table in A.chunks(batches, "text"):
            raw, off = A.utf8(table["text"])
            h, d = shingle_sets(raw, off, size)
            n, key = set_keys(h, d, table.num_rows)
            total += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
            rows = table.num_rows
            yield pa.RecordBatch.from_arrays(
                [table["doc_id"].combine_chunks(), pa.array(n), pa.array(key), table["mark"].combine_chunks(),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                names=["doc_id", "n", "cls", "mark", "slot", "body"])
        if total.any():
            body = [A.pack(x) for x in np.split(total, SKETCH_GROUPS)]
            k = len(body)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64())] * 4 + [pa.array(range(k), pa.int32()), pa.array(body, pa.binary())],
                names=["doc_id", "n", "cls", "mark", "slot", "body"])
    return run


def _sum_slots(table: pa.Table) -> pa.Table:
    total = sum(A.unpack(b, np.int64)[0] for b in table["body"].to_pylist())
    return pa.table({"slot": table["slot"][:1], "body": pa.array([A.pack(total)], pa.binary())})


# ------------------------------------------------------ pass 2: adaptive prefixes
def prefix_length(n, level, percent):
    return np.minimum(n, n - -(-percent * n // 100) + level)


def prefixes(h, d, n, sketch, percent):
    """(token, text index, place, level) of every text's prefix in the global order."""
    mean = sketch.sum() / len(sketch)
    seen = sketch[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    others = np.maximum(seen - mean - 4 * np.sqrt(mean) - 1, 0)        # texts beside this one that may hold the token
    band = np.where(others > 16, np.log2(np.maximum(others, 1)).astype(np.int64), 0)
    o = np.argsort(d * 128 + band, kind="stable")                      # already by text and hash
    h, d, others = h[o], d[o], others[o]
    size = n[d]
    begin = np.concatenate(([0], np.cumsum(n)))[:-1]
    place = np.arange(len(h)) - begin[d]
    rows = np.concatenate(([0.], np.cumsum(1 + others)))
    cost = np.full((len(LEVELS), len(n)), np.inf)
    for i, level in enumerate(LEVELS):
        end = begin + prefix_length(n, level, percent)
        s = rows[end] - rows[begin]
        met = s - (end - begin)
        fits = level <= np.maximum(-(-percent * n // 100), 1)
        cost[i] = np.where(fits, s + VERIFY_COST * met / level, np.inf)
    level = np.array(LEVELS)[np.argmin(cost, axis=0)]
    keep = place < prefix_length(size, level[d], percent)
    return h[keep], d[keep], place[keep], level


def _post(size: int, percent: int, sketch: np.ndarray, buckets: int):
    def run(batches):
        for table in A.chunks(batches, "text"):
            raw, off = A.utf8(table["text"])
            h, d = shingle_sets(raw, off, size)
            n, key = set_keys(h, d, table.num_rows)
            tok, doc, place, level = prefixes(h, d, n, sketch, percent)
            once = np.zeros(table.num_rows, bool)                      # equal sets of the chunk enter once
            once[np.unique(key, return_index=True)[1]] = True
            k = once[doc]
            tok, doc, place = tok[k], doc[k], place[k]
            bucket = (A.mix(tok) % np.uint64(buckets)).astype(np.int32)
            o = np.argsort(bucket, kind="stable")
            bucket, tok, doc, place = bucket[o], tok[o], doc[o], place[o]
            out = []
            for a, m in zip(*A.spans(bucket)):
                first, count = A.spans(doc[a:a + m])
                own = doc[a:a + m][first]
                out.append((int(bucket[a]), A.pack(n[own].astype(np.int32), level[own].astype(np.uint8), count.astype(np.uint32),
                                                   np.diff(place[a:a + m], prepend=0).astype(np.int32)),
                            key[own].tobytes(), tok[a:a + m].tobytes()))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32()] + [pa.binary()] * 3)],
                                             names=["bucket", "body", "cls", "tok"])
    return run


def _shared_tokens(table: pa.Table) -> pa.Table:
    """Prefix rows of tokens that more than one class holds."""
    parts = []
    for body, cls, tok in zip(table["body"].to_pylist(), table["cls"].to_pylist(), table["tok"].to_pylist()):
        n, level, count, gap = A.unpack(body, np.int32, np.uint8, np.uint32, np.int32)
        parts.append((np.frombuffer(tok, np.int64), np.repeat(np.frombuffer(cls, np.int64), count), np.repeat(n, count),
                      np.cumsum(gap).astype(np.int32), np.repeat(level, count).astype(np.int32)))
    tok, cls, n, place, level = (np.concatenate(x) for x in zip(*parts))
    o = np.lexsort((cls, tok))
    tok, cls = tok[o], cls[o]
    keep = np.ones(len(o), bool)
    keep[1:] = (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])           # a class may come from several chunks
    o, tok, cls = o[keep], tok[keep], cls[keep]
    _, m = A.spans(tok)
    many = np.repeat(m > 1, m)
    o = o[many]
    return pa.table({"tok": tok[many], "cls": cls[many], "n": n[o], "place": place[o], "level": level[o]})


# -------------------------------------------------------------- verification
def _squeeze(batches):
    """Texts of representatives, compressed."""
    import zstandard
    small = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raw, off = A.utf8(batch.column(1))
        z = [small.compress(raw[off[i]:off[i + 1]].tobytes()) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.binary())], names=["cls", "z"])


def _verified(size: int, percent: int):
    def run(batches):
        import zstandard
        big = zstandard.ZstdDecompressor()

        def sets(values):
            """Set of every distinct text of a column, and which one each row has."""
            known: dict[bytes, int] = {}
            which = [known.setdefault(z, len(known)) for z in values]
            texts = [big.decompress(z) for z in known]
            off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
            h, d = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), off, size)
            at = np.searchsorted(d, np.arange(len(texts) + 1))
            return which, [h[at[i]:at[i + 1]] for i in range(len(texts))]

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                (wa, sa), (wb, sb) = (sets(part.column(i).to_pylist()) for i in (2, 3))
                ok = []
                for i, j in zip(wa, wb):
                    x, y = sa[i], sb[j]
                    if len(x) > len(y):
                        x, y = y, x
                    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0
                    ok.append(100 * common >= percent * (len(x) + len(y) - common))
                mask = pa.array(ok, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(mask), part.column(1).filter(mask)], names=["a", "b"])
    return run


def _links(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that do link."""
    a = texts.select(F.col("cls").alias("a"), F.col("z").alias("za"))
    b = texts.select(F.col("cls").alias("b"), F.col("z").alias("zb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "za", "zb").mapInArrow(_verified(size, percent), "a long, b long")


def _candidate(percent: int) -> tuple:
    """(condition on a shared token, level) of rows x and y: lengths allow the similarity, and the token lies in
    both prefixes that the pair's own least overlap and level ask for."""
    n_x, n_y = F.col("n_x"), F.col("n_y")
    overlap = F.ceil(percent * (n_x + n_y) / (100 + percent) - F.lit(1e-9))
    level = F.least("level_x", "level_y")
    fits = 100 * F.least(n_x, n_y) >= percent * F.greatest(n_x, n_y)
    return (fits & (F.col("place_x") < n_x - overlap + level) & (F.col("place_y") < n_y - overlap + level)), level


COLUMNS = ("cls", "n", "place", "level", "comp")


def _star(rows: DataFrame, salt: int, percent: int) -> DataFrame:
    """For every class its best match among the pivots of its tokens, one pair per class at most.

    First round: a token's pivot is the class that holds it earliest, that is with fewest rarer tokens, the
    likeliest origin of its group.  Later rounds: another class per token."""
    order = F.col("place").cast("long") if salt == 0 else F.xxhash64("cls", "tok", F.lit(salt))
    pivot = (rows.groupBy("tok").agg(F.min(F.struct(order.alias("o"), F.xxhash64("cls").alias("h"), *COLUMNS)).alias("p"),
                                     F.min("comp").alias("c1"), F.max("comp").alias("c2"))
             .where("c1 <> c2").select("tok", *[F.col(f"p.{c}").alias(f"{c}_y") for c in COLUMNS]))
    x = rows.select("tok", *[F.col(c).alias(f"{c}_x") for c in COLUMNS])
    inside, _ = _candidate(percent)
    met = (x.join(pivot, "tok").where((F.col("comp_x") != F.col("comp_y")) & inside)
           .groupBy("cls_x", "cls_y").agg(F.count("*").alias("k")))
    best = met.groupBy("cls_x").agg(F.max(F.struct("k", "cls_y")).alias("m"))
    return best.select(F.least("cls_x", "m.cls_y").alias("a"), F.greatest("cls_x", "m.cls_y").alias("b")).distinct()


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Every candidate pair of classes of different components (exact).

    In each token the component with most classes is the ground; every row off
    the ground meets the rows of other components, so a large component's own
    pairs are never made."""
    ground = (rows.groupBy("tok", "comp").agg(F.count("*").alias("k"))
              .groupBy("tok").agg(F.max(F.struct("k", "comp")).alias("g"), F.count("*").alias("m"))
              .where("m > 1").select("tok", F.col("g.comp").alias("ground")))
    live = rows.join(ground, "tok")
    x = live.where("comp <> ground").select("tok", *[F.col(c).alias(f"{c}_x") for c in COLUMNS])
    y = live.select("tok", "ground", *[F.col(c).alias(f"{c}_y") for c in COLUMNS])
    inside, level = _candidate(percent)
    met = x.join(y, (x.tok == y.tok) & (F.col("comp_x") != F.col("comp_y")) & inside
                 & ((F.col("comp_y") == F.col("ground")) | (F.col("cls_x") < F.col("cls_y"))))
    return (met.groupBy(F.least("cls_x", "cls_y").alias("a"), F.greatest("cls_x", "cls_y").alias("b"))
            .agg(F.count("*").alias("k"), F.min(level).alias("need")).where("k >= need").select("a", "b"))


def jaccard_join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75,
                 star_rounds: int = 2, buckets: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links, itself included)."""
    buckets = buckets or bucket_number(docs, text_col, BUCKET_BYTES)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = d.withColumn("mark", F.xxhash64("text"))                  # tells apart texts of one id
    survey = stored(marked.mapInArrow(_survey(size), "doc_id long, n long, cls long, mark long, slot int, body binary"), "survey")
    sums = (survey.where("slot is not null").select("slot", "body").groupBy("slot")
            .applyInArrow(_sum_slots, "slot int, body binary").collect())              # a sketch of fixed size
    members = survey.where("slot is null").select("doc_id", "n", "cls", "mark")
    if not sums:
        return members.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    sketch = np.concatenate([A.unpack(r.body, np.int64)[0] for r in sorted(sums, key=lambda r: r.slot)])

    named = d.where("doc_id is not null")
    rows = stored(named.mapInArrow(_post(size, percent, sketch, buckets), "bucket int, body binary, cls binary, tok binary")
                  .groupBy("bucket").applyInArrow(_shared_tokens, "tok long, cls long, n int, place int, level int"), "prefixes")
    reps = (members.where("doc_id is not null and n > 0").groupBy("cls").agg(F.min(F.struct("doc_id", "mark")).alias("r"))
            .select("cls", "r.doc_id", "r.mark"))
    wanted = rows.select("cls").distinct().join(reps, "cls")
    texts = stored(marked.join(wanted, ["doc_id", "mark"]).select("cls", "text").mapInArrow(_squeeze, "cls long, z binary")
                   .dropDuplicates(["cls"]), "texts")

    links = None
    comp = rows.withColumn("comp", F.col("cls"))
    for r in range(star_rounds + 1):
        pairs = stored(_star(comp, r, percent) if r < star_rounds else _across(comp, percent), "pairs")
        if r < star_rounds and pairs.isEmpty():
            continue
        found = stored(_links(pairs, texts, size, percent), "links")
        links = found if links is None else links.unionByName(found)
        roots = components(links)
        comp = rows.join(roots, F.col("cls") == F.col("node"), "left").select(
            *rows.columns, F.coalesce("root", "cls").alias("comp"))
    # rows of one id hang together too; classes and ids meet in one small table
    least = (members.where("doc_id is not null and n > 0").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
             .select("doc_id", "cls", F.coalesce("root", "cls").alias("root")))
    return _smallest(members, least)


def _smallest(members: DataFrame, least: DataFrame) -> DataFrame:
    """Component by smallest id; ids that several rows carry join their rows' components."""
    top = least.groupBy("root").agg(F.min("doc_id").alias("low"))
    doubled = least.groupBy("doc_id").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2")
    if not doubled.isEmpty():
        pairs = least.join(doubled.select("doc_id"), "doc_id").join(top, "root").select(F.col("doc_id").alias("a"), F.col("low").alias("b"))
        deeper = components(pairs).select(F.col("node").alias("low"), F.col("root").alias("lowest"))
        top = top.join(deeper, "low", "left").select("root", F.coalesce("lowest", "low").alias("low"))
    final = least.join(top, "root").groupBy("cls").agg(F.min("low").alias("component_id"))
    return (members.join(final, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), "doc_id"))
                    .alias("component_id")))
