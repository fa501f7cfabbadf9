"""Conversation prefix trie from sorted prefixes and range-minimum tables.

Every distinct sequence of first d turns (role, text) of a conversation is a node
of depth d, from the textless root; the conversations that begin with it are its
members.

Method
------
* Conversations are sorted by their turns.  The longest common prefixes (LCP) of
  neighbours stand in a sparse table of range minima.  Every candidate prefix
  (row, depth) binary-searches its left and its right extent on its own: as far
  as the minimum of the LCPs stays at the depth.  The extents are the member
  interval; counts come from prefix sums and the smallest member from a second
  sparse table.  Subtrees are runs of the intervals in preorder.

How it runs
-----------
1. Turns are numbered by a range sort, so one conversation may spread over many
   tasks; a turn becomes a 128-bit digest that holds its position, and a prefix
   the exclusive or of its turns' digests.
2. A conversation is cut into segments of ``SEGMENT`` turns; a segment hangs under
   the prefix before it, so rows stay small however long a conversation is.  Equal
   segments below one prefix are one row with a weight.
3. Segments are range-partitioned and sorted; a task takes them in blocks.  An
   interval that touches a block's edge is open: its parts, at most 2 * SEGMENT a
   block, are added up by prefix.
4. What later segments save is summed along each conversation and added to the
   nodes of its earlier ones.  Ids that end at a node are hashed as a stream of
   sorted blocks.

Defined results: null role or text is empty; rows without a conversation id are
ignored; null turns come first; turns with one number are ordered by their
digests, and equal turns each count; an empty table gives an empty result; other
columns are ignored.  Turns and prefixes are compared by 128-bit hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbitlens.llm import arrays as A
from orbitlens.llm.shared import stored

SEGMENT = 16               # turns of one segment
BLOCK = 20_000             # segments of one pair of sparse tables
ENDS_BITS = 12             # ids of one block of ends: 2**ENDS_BITS consecutive numbers

NODE = ("a long, b long, depth long, conv_id long, parent long, pa long, pb long, far boolean, n_convs long, n_children long, "
        "n_leaves long, saved long, ends long, first_end long, size long, open boolean, path array<struct<a:long,b:long>>")


# ------------------------------------------------------------------ turns
def _number(batches):
    """Place of every row among its conversation's rows of this partition (sorted)."""
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy(zero_copy_only=False)
        first, n = A.spans(conv)
        local = np.arange(len(conv)) - np.repeat(first, n)
        if conv[0] == last:
            local[:n[0]] += seen
        last, seen = conv[-1], int(local[-1]) + 1
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(conv), pid, np.int32)), pa.array(local),
                                          *(batch.column(i) for i in (1, 2, 3))],
                                         names=["conv_id", "pid", "local", "a", "b", "size"])


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns: conv_id, pid, local, a, b, size; places: conv_id, pid, before, n_turns).

    A turn's rank is ``local`` plus the ``before`` of its conversation's part ``pid``."""
    d = (conversations.where("conv_id is not null")
         .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
         .select("conv_id", "turn", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"),
                 F.length("text").cast("long").alias("size"), F.monotonically_increasing_id().alias("tie")))
    order = ["conv_id", F.asc_nulls_first("turn"), "a", "b", "tie"]
    turns = stored(d.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "a", "b", "size")
                   .mapInArrow(_number, "conv_id long, pid int, local long, a long, b long, size long"), "turns")
    parts = turns.groupBy("conv_id", "pid").agg(F.count("*").alias("k"))      # a few parts a conversation, one a partition at most
    w = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("k").over(w.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return turns, stored(parts.select("conv_id", "pid", before.alias("before"), F.sum("k").over(w).alias("n_turns")), "places")


def shared_heads(turns: DataFrame, places: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin alike: c takes the first h turns of conversation ``c - c % every`` and keeps its own
    after its first h, with ``h = crc32(c) % most``.

    Returns (rows: conv_id, length, pos, a, b, size; convs: conv_id, length)."""
    convs = places.groupBy("conv_id").agg(F.first("n_turns").alias("n"))
    base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")).where(F.col("base") % every == 0)
    info = (convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
            .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
            .join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
            .select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    info = stored(info, "conversations")
    first = (turns.where((F.col("conv_id") % every == 0) & (F.col("local") < most)).join(places, ["conv_id", "pid"])
             .select(F.col("conv_id").alias("base"), (F.col("local") + F.col("before")).alias("pos"), "a", "b", "size").where(F.col("pos") < most))
    heads = info.where("taken > 0").join(first, "base").where("pos < taken").select("conv_id", "length", "pos", "a", "b", "size")
    own = (turns.join(places.join(info, "conv_id"), ["conv_id", "pid"]).withColumn("rank", F.col("local") + F.col("before"))
           .where("rank >= h").select("conv_id", "length", (F.col("rank") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "size"))
    return heads.unionByName(own), info.select("conv_id", "length")


# ------------------------------------------------------------------ intervals
def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of every run of 1, 2, 4, ... values."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def left_extent(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First row from which the LCPs up to ``row`` all reach ``depth``."""
    at = row.copy()
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        start = at - step + 1
        ok = (start >= 1) & (table[k][np.clip(start, 0, len(table[k]) - 1)] >= depth)
        at = np.where(ok, at - step, at)
    return at


def right_extent(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Last row up to which the LCPs after ``row`` all reach ``depth``."""
    at, n = row.copy(), len(table[0])
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        ok = (at + step < n) & (table[k][np.clip(at + 1, 0, len(table[k]) - 1)] >= depth)
        at = np.where(ok, at + step, at)
    return at


def _least(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum over [lo, hi] from two runs of one power of two."""
    k = np.floor(np.log2(hi - lo + 1)).astype(np.int64)
    out = np.empty(len(lo), table[0].dtype)
    for i in np.unique(k):
        m = k == i
        out[m] = np.minimum(table[i][lo[m]], table[i][hi[m] - (1 << int(i)) + 1])
    return out


def _nodes(t: pa.Table) -> pa.RecordBatch:
    """Nodes of a block of sorted segments (seg, pa, pb, turns, weight, low, ends, first_end)."""
    t = t.combine_chunks()
    col = lambda c: t[c].to_numpy().astype(np.int64)
    seg, pre, prb, weight, low, e = (col(c) for c in ("seg", "pa", "pb", "weight", "low", "ends"))
    fe = t["first_end"].fill_null(np.iinfo(np.int64).max).to_numpy()
    turns = t["turns"].chunk(0)
    off = turns.offsets.to_numpy().astype(np.int64)
    size = np.diff(off)
    n, width = len(seg), int(size.max())
    inside = np.arange(width) < size[:, None]
    grids = []
    for name in ("a", "b", "size"):
        g = np.zeros((n, width), np.int64)
        g[inside] = turns.values.field(name).to_numpy()[off[0]:off[-1]]
        grids.append(g)
    ga, gb, chars = grids
    same = (seg[1:] == seg[:-1]) & (pre[1:] == pre[:-1]) & (prb[1:] == prb[:-1])
    equal = (ga[1:] == ga[:-1]) & (gb[1:] == gb[:-1]) & inside[1:] & inside[:-1] & same[:, None]
    lcp = np.zeros(n + 1, np.int64)
    lcp[1:n] = np.logical_and.accumulate(equal, axis=1).sum(axis=1)
    ha = pre[:, None] ^ np.bitwise_xor.accumulate(ga, axis=1)
    hb = prb[:, None] ^ np.bitwise_xor.accumulate(gb, axis=1)

    # every node once: the candidate at its last row
    table = sparse_table(lcp[:n])
    count = size - lcp[1:]
    row = np.repeat(np.arange(n), count)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lcp[1:], count) + 1
    lo, hi = left_extent(table, row, depth), right_extent(table, row, depth)
    order = np.lexsort((depth, lo))                                   # preorder
    lo, hi, depth = lo[order], hi[order], depth[order]
    key = lo * (width + 1) + depth
    inner = depth > 1
    parent = np.searchsorted(key, np.where(inner, left_extent(table, lo, depth - 1) * (width + 1) + depth - 1, key))
    end = np.searchsorted(lo, hi, side="right")

    total = np.concatenate(([0], np.cumsum(weight)))
    n_convs = total[hi + 1] - total[lo]
    conv = _least(sparse_table(low), lo, hi)
    ending = size[lo] == depth                                        # the shortest member is first
    ends, first_end = np.where(ending, e[lo], 0), np.where(ending, fe[lo], np.iinfo(np.int64).max)
    last = chars[lo, depth - 1]
    is_open = (lo == 0) | (hi == n - 1)
    far = ~inner | is_open[parent]
    sums = [np.concatenate(([0], np.cumsum(np.where(is_open, 0, x)))) for x in ((n_convs - 1) * last, (ends == n_convs).astype(np.int64))]
    at = np.arange(len(lo))
    saved, leaves = (s[end] - s[at] for s in sums)
    kids = np.bincount(parent[~far], minlength=len(lo))
    pha = np.where(inner, ha[lo, np.maximum(depth - 2, 0)], pre[lo])
    phb = np.where(inner, hb[lo, np.maximum(depth - 2, 0)], prb[lo])
    path = [[{"a": int(x), "b": int(y)} for x, y in zip(ha[r, :d], hb[r, :d])] if o else None
            for r, d, o in zip(lo.tolist(), depth.tolist(), is_open.tolist())]
    longs = [ha[lo, depth - 1], hb[lo, depth - 1], seg[lo] * SEGMENT + depth, conv]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, longs), pa.array(conv[parent], mask=far), pa.array(pha), pa.array(phb), pa.array(far),
         *map(pa.array, (n_convs, kids, leaves, saved, ends, first_end, last)), pa.array(is_open),
         pa.array(path, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
        names=[c.split()[0] for c in NODE.split(", ")])


def _tries(batches):
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            held.append(part)
            n += part.num_rows
            if n >= BLOCK:
                yield _nodes(pa.Table.from_batches(held))
                held, n = [], 0
    if held:
        yield _nodes(pa.Table.from_batches(held))


def _spread(batches):
    """What later segments add to every prefix of a segment."""
    for batch in batches:
        t = pa.Table.from_batches([batch]).combine_chunks()
        if not t.num_rows:
            continue
        turns = t["turns"].chunk(0)
        off = turns.offsets.to_numpy().astype(np.int64)
        size = np.diff(off)
        out = []
        for name, prefix in (("a", "pa"), ("b", "pb")):
            run = np.bitwise_xor.accumulate(np.concatenate(([0], turns.values.field(name).to_numpy()[off[0]:off[-1]])))
            start = off[:-1] - off[0]
            out.append(run[1:] ^ np.repeat(run[start] ^ t[prefix].to_numpy(), size))
        yield pa.RecordBatch.from_arrays([*map(pa.array, out), *(pa.array(np.repeat(t[c].to_numpy(), size)) for c in ("saved", "leaves"))],
                                         names=["a", "b", "saved", "leaves"])


def _end_digests(batches):
    """SHA-256 over the blocks of ids of every node, as a stream (sorted by node and block)."""
    now, sha = None, None
    for batch in batches:
        a, b, digest = [], [], []
        for x, y, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (x, y) != now:
                if now is not None:
                    a.append(now[0]), b.append(now[1]), digest.append(sha.hexdigest())
                now, sha = (x, y), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digest, pa.string())],
                                         names=["a", "b", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([sha.hexdigest()])], names=["a", "b", "ends_sha256"])


# ------------------------------------------------------------------ the trie
def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv_id, length, pos, a, b, size); ``convs`` (conv_id, length) also
    holds the conversations without turns.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves (childless nodes of the
    subtree), saved_tokens (over the subtree, members beyond the first times the last text's code points),
    ends_sha256 (ids of the members that end at the node)."""
    here = rows.withColumns({"seg": F.expr(f"pos div {SEGMENT}"), "xa": F.xxhash64("a", "b", "pos"),
                             "xb": F.xxhash64(F.lit(2), "pos", "b", "a")})
    turn = F.struct("pos", F.col("xa").alias("a"), F.col("xb").alias("b"), "size")
    segs = (here.groupBy("conv_id", "length", "seg")
            .agg(F.sort_array(F.collect_list(turn)).alias("t"), F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"))   # SEGMENT turns at most
            .withColumn("turns", F.expr("transform(t, x -> struct(x.a, x.b, x.size))")).drop("t"))
    segs = stored(segs.withColumn("last", F.col("seg") == F.expr(f"(length - 1) div {SEGMENT}")), "segments")
    earlier = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    prefix = lambda c: F.coalesce(F.bit_xor(c).over(earlier), F.lit(0))
    longer = segs.where(f"length > {SEGMENT}").withColumns({"pa": prefix("xa"), "pb": prefix("xb")})
    segs = segs.where(f"length <= {SEGMENT}").withColumns({"pa": F.lit(0).cast("long"), "pb": F.lit(0).cast("long")}).unionByName(longer)

    place = ["seg", "pa", "pb", "turns"]
    nodes = stored(segs.groupBy(*place).agg(F.count("*").alias("weight"), F.min("conv_id").alias("low"),
                                            F.sum(F.col("last").cast("long")).alias("ends"),
                                            F.min(F.when(F.col("last"), F.col("conv_id"))).alias("first_end"))
                   .repartitionByRange(*place).sortWithinPartitions(*place).mapInArrow(_tries, NODE), "nodes")
    own = {"own_saved": (F.col("n_convs") - 1) * F.col("size"), "own_leaf": (F.col("ends") == F.col("n_convs")).cast("long")}
    closed = nodes.where("not open").withColumns(own)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved", "ends")]
    spread = (nodes.where("open").groupBy("a", "b")
              .agg(*[F.min(c).alias(c) for c in ("depth", "conv_id", "parent", "pa", "pb", "first_end", "size")], *sums,
                   F.max("far").alias("far"), F.max("open").alias("open"), F.min("path").alias("path")).withColumns(own))
    spread = stored(spread.select(*closed.columns), "open")
    every = closed.unionByName(spread)

    # additions: open nodes to their ancestors in the segment, later segments, children across blocks and segments
    zero = F.lit(0).cast("long")
    up = spread.select(F.explode("path").alias("p"), "own_saved", "own_leaf").select(
        "p.a", "p.b", F.col("own_saved").alias("saved"), F.col("own_leaf").alias("leaves"), zero.alias("kids"))
    owned = (every.where(f"depth > {SEGMENT}").groupBy("conv_id", F.expr(f"(depth - 1) div {SEGMENT}").alias("seg"))
             .agg(F.sum("own_saved").alias("s"), F.sum("own_leaf").alias("l")))
    later = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    tails = (longer.join(owned, ["conv_id", "seg"], "left")
             .select("pa", "pb", "turns", F.coalesce(F.sum("s").over(later), F.lit(0)).alias("saved"), F.coalesce(F.sum("l").over(later), F.lit(0)).alias("leaves"))
             .where("saved <> 0 or leaves <> 0").mapInArrow(_spread, "a long, b long, saved long, leaves long").withColumn("kids", zero))
    kids = every.where("far").groupBy("pa", "pb").agg(F.count("*").alias("kids")).select(
        F.col("pa").alias("a"), F.col("pb").alias("b"), zero.alias("saved"), zero.alias("leaves"), "kids")
    whole = every.agg(F.sum("own_saved").alias("saved"), F.sum("own_leaf").alias("leaves")).select(
        zero.alias("a"), zero.alias("b"), F.coalesce("saved", zero).alias("saved"), F.coalesce("leaves", zero).alias("leaves"), zero.alias("kids"))
    more = (up.unionByName(tails).unionByName(kids).unionByName(whole).groupBy("a", "b")
            .agg(F.sum("saved").alias("add_saved"), F.sum("leaves").alias("add_leaves"), F.sum("kids").alias("add_kids")))

    root = (convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
            .select(zero.alias("a"), zero.alias("b"), zero.alias("depth"), "conv_id", F.lit(None).cast("long").alias("parent"), "n_convs",
                    zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved")))
    keep = root.columns
    spine = (spread.select("a", "b", "conv_id").unionByName(closed.where(f"depth % {SEGMENT} = 0").select("a", "b", "conv_id"))
             .unionByName(root.select("a", "b", "conv_id")).select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("up")))
    far = every.where("far").drop("parent").join(spine, ["pa", "pb"]).withColumnRenamed("up", "parent")
    table = every.where("not far").select(*keep).unionByName(far.select(*keep)).unionByName(root)

    ended = (segs.where("last").select(F.col("pa").bitwiseXOR(F.col("xa")).alias("a"), F.col("pb").bitwiseXOR(F.col("xb")).alias("b"), "conv_id")
             .unionByName(convs.where("length = 0").select(zero.alias("a"), zero.alias("b"), "conv_id")))
    ends = (ended.groupBy("a", "b", F.shiftright("conv_id", ENDS_BITS).alias("block"))
            .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))           # 2**ENDS_BITS ids at most
            .repartition("a", "b").sortWithinPartitions("a", "b", "block").mapInArrow(_end_digests, "a long, b long, ends_sha256 string"))
    leaves = F.col("n_leaves") + F.coalesce("add_leaves", zero)
    kids = F.col("n_children") + F.coalesce("add_kids", zero)
    return (table.join(more, ["a", "b"], "left").join(ends, ["a", "b"], "left")
            .select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", kids.alias("n_children"),
                    F.when((F.col("depth") == 0) & (kids == 0), F.lit(1)).otherwise(leaves).cast("long").alias("n_leaves"),
                    (F.col("saved") + F.coalesce("add_saved", zero)).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations rebuilt by ``shared_heads``."""
    return prefix_trie(*shared_heads(*numbered_turns(conversations)))
