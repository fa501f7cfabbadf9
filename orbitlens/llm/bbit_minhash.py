"""MinHash near-duplicates with b-bit signatures.

Method
------
* A text's set is its distinct word shingles.  ``BANDS`` x ``ROWS`` hash functions
  each keep their minimum over the set; ``ROWS`` minima make one band key.  Two
  sets of similarity s share no band with probability ``(1 - s**ROWS)**BANDS``:
  6e-11 at 0.85.
* Of every minimum only the ``BITS`` low bits are kept, packed into four longs.
  For a candidate pair the equal fields are counted by bit counts; sets that are
  unrelated agree in ``2**-BITS`` of them, so the estimate is
  ``(equal share - 2**-BITS) / (1 - 2**-BITS)``.  A pair goes on when the estimate
  is no more than ``SLACK`` (about 6.5 standard errors) below the threshold.
* What goes on is confirmed on the full sets.

No group of copies emits its pairs: equal sets are one class.  In a star round
every class meets one pivot per shared band (first the class that shares most,
the likeliest origin of a group of near copies), classes that hang together need
no more links, and only bands that still touch several components go on.  The
last round is exact: all candidates across components that share a band.

Defined results: a set of fewer than ``size`` words is the whole sequence as one
shingle; null, empty and blank texts have no shingles and link with nothing.
Links are between texts: a row's component is the smallest id of all rows whose
texts hang together with its own, so rows that share an id may lie in different
components.  A null id takes part in no link, has a null component and is kept.
Repeated rows each give their row; an empty table gives an empty result; other
columns are ignored.  Shingles and sets are compared by 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import arrays as A
from orbitlens.llm.components import components
from orbitlens.llm.jaccard_join import _links, _squeeze, set_keys, shingle_sets
from orbitlens.llm.shared import stored

BANDS, ROWS, BITS = 32, 4, 2
HASHES = BANDS * ROWS
LONGS = HASHES * BITS // 64
SLACK = 0.25
CELL = 500_000             # shingles on either side of a cell

_rng = np.random.default_rng(0xB17)
_XOR = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_MUL = _rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(HASHES, sets) minima of every hash function over the sets that begin at ``first``."""
    x = (h >> np.uint64(32)).astype(np.uint32)
    out = np.empty((HASHES, len(first)), np.uint32)
    for i in range(HASHES):
        out[i] = np.minimum.reduceat((x ^ _XOR[i]) * _MUL[i], first)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """(sets, BANDS) 64-bit keys, each of ROWS minima and the band's number."""
    key = np.empty((low.shape[1], BANDS), np.uint64)
    for band in range(BANDS):
        k = np.full(low.shape[1], band + 1, np.uint64)
        for row in low[band * ROWS:(band + 1) * ROWS]:
            k = A.mix(k * A.ROLL[0] + row)
        key[:, band] = k
    return key.view(np.int64)


def signatures(low: np.ndarray) -> np.ndarray:
    """(sets, LONGS) packed low bits of the scrambled minima."""
    bits = ((low * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64)
    out = np.zeros((low.shape[1], LONGS), np.uint64)
    per = 64 // BITS
    for i in range(HASHES):
        out[:, i // per] |= bits[i] << np.uint64(BITS * (i % per))
    return out.view(np.int64)


def estimate(a: list[Column], b: list[Column]) -> Column:
    """Collision-corrected similarity of two packed signatures."""
    low = int("01" * (64 // BITS), 2)                    # the lowest bit of every field (BITS = 2)
    differ = sum(F.bit_count((x.bitwiseXOR(y)).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1)).bitwiseAND(F.lit(low)))
                 for x, y in zip(a, b))
    chance = 2.0 ** -BITS
    return (1 - differ / F.lit(float(HASHES)) - F.lit(chance)) / F.lit(1 - chance)


def _survey(size: int):
    """One row per text; the first of equal sets of a chunk brings its signature and band keys."""
    def run(batches):
        for table in A.chunks(batches, "text"):
            raw, off = A.utf8(table["text"])
            h, d = shingle_sets(raw, off, size)
            n, key = set_keys(h, d, table.num_rows)
            first, _ = A.spans(d)
            sig, bands = [None] * table.num_rows, [None] * table.num_rows
            if len(first):
                low = minima(h, first)
                s, b = signatures(low), band_keys(low)
                named = table["doc_id"].is_valid().to_numpy()
                own = d[first]
                at = np.flatnonzero(named[own])
                for j in at[np.unique(key[own[at]], return_index=True)[1]]:
                    sig[own[j]], bands[own[j]] = s[j], b[j]
            yield pa.RecordBatch.from_arrays(
                [table["doc_id"].combine_chunks(), pa.array(n), pa.array(key), table["mark"].combine_chunks(),
                 pa.array(sig, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n", "cls", "mark", "sig", "bands"])
    return run


def _close(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose lengths and signatures allow a link."""
    side = lambda c: classes.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"s_{c}"))
    sig = lambda c: [F.col(f"s_{c}")[i] for i in range(LONGS)]
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .where(estimate(sig("a"), sig("b")) >= F.lit(percent / 100 - SLACK)).select("a", "b"))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _star(rows: DataFrame, order: Column) -> DataFrame:
    """Every class with the pivot (least ``order``) of each of its bands."""
    pivot = (rows.groupBy("key").agg(F.min(F.struct(order.alias("o"), "cls", "comp")).alias("p"),
                                     F.min("comp").alias("c1"), F.max("comp").alias("c2"))
             .where("c1 <> c2").select("key", F.col("p.cls").alias("pivot"), F.col("p.comp").alias("ground")))
    return rows.join(pivot, "key").where("comp <> ground").select(*_pair("cls", "pivot")).distinct()


def _open(rows: DataFrame) -> DataFrame:
    """Rows of bands that touch several components."""
    live = rows.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("key")
    return rows.join(live, "key", "left_semi")


def _explode(size: int):
    def run(batches):
        import zstandard
        big = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = [big.decompress(z) for z in batch.column(2).to_pylist()]
            off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
            h, d = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), off, size)
            for at in range(0, len(h), 100_000):
                k = pa.array(d[at:at + 100_000])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(k), batch.column(1).take(k), pa.array(h[at:at + 100_000].view(np.int64))],
                                                 names=["cls", "comp", "h"])
    return run


def _common(rows: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(cls, common): shingles of every open class that also occur in an open class of another component."""
    own = rows.select("cls", "comp").distinct().join(texts, "cls").mapInArrow(_explode(size), "cls long, comp long, h long")
    across = own.groupBy("h").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("h")
    return own.join(across, "h").groupBy("cls").agg(F.count("*").alias("common"))


def _look_up(size: int, percent: int):
    """Links (a, b) between the components of a cell's questions and members."""
    def sets(z: pa.ChunkedArray):
        import zstandard
        big = zstandard.ZstdDecompressor()
        texts = [big.decompress(x) for x in z.to_pylist()]
        off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        h, d = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), off, size)
        return h, d, np.bincount(d, minlength=len(texts))

    def run(members: pa.Table, asks: pa.Table) -> pa.Table:
        a, b = [], []
        if members.num_rows and asks.num_rows:
            h, d, n = sets(members["z"])
            o = np.argsort(h, kind="stable")
            h, d = h[o], d[o]
            comp = members["comp"].to_numpy()
            qh, qd, qn = sets(asks["z_"])
            begin = np.concatenate(([0], np.cumsum(qn)))
            lo, hi = np.searchsorted(h, qh, "left"), np.searchsorted(h, qh, "right")
            for i, its in enumerate(asks["comp_"].to_pylist()):
                x, y = lo[begin[i]:begin[i + 1]], hi[begin[i]:begin[i + 1]]
                k = y - x
                both = np.bincount(d[np.repeat(x - np.cumsum(k) + k, k) + np.arange(int(k.sum()))], minlength=len(n))
                hit = np.unique(comp[(100 * both >= percent * (n + qn[i] - both)) & (comp != its)])
                a += [its] * len(hit)
                b += hit.tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _across(rows: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of components that a link joins, among the open rows (key, cls, n, comp)."""
    ground = (rows.groupBy("key", "comp").agg(F.count("*").alias("k"))
              .groupBy("key").agg(F.max(F.struct("k", "comp")).alias("g"), F.count("*").alias("m"))
              .where("m > 1").select("key", F.col("g.comp").alias("ground")))
    live = stored(rows.join(ground, "key").select("ground", "cls", "comp", "n").distinct(), "cells")
    off = F.col("comp") != F.col("ground")
    many = lambda c: F.greatest(F.ceil(F.coalesce(F.sum(c), F.lit(0)) / CELL), F.lit(1)).cast("int")
    shape = live.groupBy("ground").agg(many(F.col("n")).alias("deep"), many(F.when(off, F.col("n"))).alias("wide"))
    rows = live.join(shape, "ground").join(texts, "cls")
    slot = lambda c: F.pmod(F.xxhash64("cls"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    cell = ["ground", "p", "q"]
    members = rows.withColumn("p", slot("deep")).withColumn("q", every("wide")).select("ground", "p", "q", "comp", "z")
    asks = rows.where(off).withColumn("q", slot("wide")).withColumn("p", every("deep"))
    asks = asks.select(*[F.col(c).alias(f"{c}_") for c in (*cell, "comp", "z")])
    return members.groupBy(*cell).cogroup(asks.groupBy(*[f"{c}_" for c in cell])).applyInArrow(_look_up(size, percent), "a long, b long")


def _resolved(df: DataFrame, node: str, roots: DataFrame, out: str = "comp") -> DataFrame:
    """``df`` with the root of its column ``node``; a node without links is its own."""
    r = roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
    return df.join(r, node, "left").withColumn(out, F.coalesce("_root", node)).drop("_root")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 85,
                    star_rounds: int = 1) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept (it is its component's smallest id)."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = d.withColumn("mark", F.xxhash64("text"))
    survey = stored(marked.mapInArrow(_survey(size), "doc_id long, n long, cls long, mark long, sig array<long>, bands array<long>"),
                    "minhash")
    members = survey.select("doc_id", "n", "cls", "mark")
    linked = members.where("doc_id is not null and n > 0")
    classes = stored(survey.where("sig is not null").select("cls", "n", "sig", "bands").dropDuplicates(["cls"]), "classes")

    every = classes.select("cls", "n", F.explode("bands").alias("key"))
    shared = every.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    met = stored(every.join(shared, "key"), "bands")
    weight = met.groupBy("cls").agg(F.sum("m").alias("weight"))        # how much of its neighbourhood a class shares
    rows = stored(met.join(weight, "cls").select("key", "cls", "n", "weight"), "bands")
    reps = linked.groupBy("cls").agg(F.min(F.struct("doc_id", "mark")).alias("r")).select("cls", "r.doc_id", "r.mark")
    texts = stored(marked.join(reps.join(weight, "cls", "left_semi"), ["doc_id", "mark"]).select("cls", "text")
                   .mapInArrow(_squeeze, "cls long, z binary").dropDuplicates(["cls"]), "texts")

    links, top = None, rows.select("cls").distinct().withColumn("comp", F.col("cls"))
    for r in range(star_rounds + 1):
        comp = rows.withColumn("comp", F.col("cls")) if r == 0 else rows.join(top, "cls")
        if r == 0 and star_rounds:
            pairs = _star(comp, -F.col("weight"))
        else:
            live = _open(comp)
            live = stored(live.join(_common(live, texts, size), "cls").where(100 * F.col("common") >= percent * F.col("n")), "open")
            if r == star_rounds:
                break
            # the fewer shingles of its own, the nearer a class is to its group's origin
            pairs = _star(live, F.struct(F.col("n") - F.col("common"), F.xxhash64("cls", F.lit(r))))
        found = stored(_links(_close(pairs, classes, percent), texts, size, percent), "links")
        links = found if links is None else links.unionByName(found)
        top = stored(_resolved(top.drop("comp"), "cls", components(links)), "components")
    joined = components(stored(_across(live, texts, size, percent), "links"))          # of components

    # smallest id by class, then by component, then back to the rows
    own = linked.groupBy("cls").agg(F.min("doc_id").alias("own")).join(top, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    own = stored(_resolved(own, "comp", joined, "top"), "tops")
    low = own.groupBy("top").agg(F.min("own").alias("least"))
    final = own.join(low, "top").select("cls", "least")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("least")), "doc_id"))
    return (members.join(final, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
