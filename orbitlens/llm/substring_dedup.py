"""Substring dedup: every fixed-length word window hashed, counted, cut out.

Method: Rabin-Karp hashes of every run of ``window`` words.  Windows that also
start in a text with a smaller id are found by a shuffle on the hash; repeated
windows of a text merge into maximal removal intervals.

How it runs
-----------
1. A task takes its texts in chunks of bounded size, hashes every window and
   settles what the chunk alone can settle: a window that a smaller id of the
   same chunk holds is removed here and now.  Only the windows of the smallest
   id go on, so a window that a third of all rows share leaves a chunk once.
2. The rest is dealt by a second, independent hash into buckets: one row per
   (chunk, bucket) with the 64-bit hashes and packed (id, position) pairs.  The
   bucket adds its bits to the hash, so chance hits stay negligible as both
   grow with the data.
3. A bucket returns, per part of the id space, the positions to remove.
4. Texts and positions meet by part; windows merge into intervals.

Defined results: null text has no words; a null id neither removes nor loses
words; rows with the same id never remove from each other; repeated rows each
get their row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import arrays as A
from orbitlens.llm.shared import bucket_number

SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, intervals array<struct<start:int,end:int>>"
MESSAGE = "part int, kind int, body binary, hashes binary"
WINDOWS, REMOVED = 0, 1
BUCKET_BYTES = 16 << 20        # input bytes per bucket of windows and per part of the id space


def _removal_rows(doc, tag, pos, parts: int):
    """One message per part of the id space: (id, tag, count) and positions."""
    part = _part(doc, parts)
    o = np.lexsort((pos, tag, doc, part))
    doc, tag, pos, part = doc[o], tag[o], pos[o], part[o]
    for a, n in zip(*A.spans(part)):
        d, t, p = doc[a:a + n], tag[a:a + n], pos[a:a + n]
        first = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]))))
        count = np.diff(np.append(first, n)).astype(np.uint32)
        yield int(part[a]), A.pack(np.diff(d[first], prepend=0), t[first], count,
                                   np.diff(p.astype(np.int64), prepend=0).astype(np.int32))


def _part(doc, parts: int):
    x = doc.astype(np.int64).view(np.uint64)
    x = x ^ (x >> np.uint64(15))
    x = x ^ (x >> np.uint64(7))
    return (x.view(np.int64) % parts).astype(np.int32)


def _part_column(doc, parts: int):
    """The same part in a Spark expression."""
    x = F.coalesce(doc, F.lit(0))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 15))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
    return F.pmod(x, F.lit(parts)).cast("int")


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                                       pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                                      names=["part", "kind", "body", "hashes"])


def _tag(raw, off) -> np.ndarray:
    """Tells apart texts that carry the same id."""
    import xxhash

    view = memoryview(raw)
    return np.fromiter((xxhash.xxh32_intdigest(view[off[i]:off[i + 1]]) for i in range(len(off) - 1)),
                       np.uint32, len(off) - 1)


def _hash_windows(window: int, buckets: int):
    def run(batches):
        for table in A.chunks(batches, "text", 8 << 20):
            table = table.filter(table["doc_id"].is_valid()).sort_by("doc_id")
            ids = table["doc_id"].to_numpy()
            raw, off = A.utf8(table["text"])
            tag = _tag(raw, off)
            _, _, doc, wh = A.words(raw, off)
            ok = np.flatnonzero(A.within(doc, window))
            if not len(ok):
                continue
            key, other = A.rolling(wh, window)[ok], A.rolling(wh, window, 1)[ok]
            doc = doc[ok]
            begin = np.full(len(ids), -1, np.int64)
            first, _ = A.spans(doc)
            begin[doc[first]] = ok[first]
            pos = (ok - begin[doc]).astype(np.uint32)
            # smallest id of the chunk that holds the window: rows are in id order, the sort is stable
            order = np.argsort(key, kind="stable")
            head, size = A.spans(key[order])
            least = np.empty(len(key), np.int64)
            least[order] = np.repeat(ids[doc[order[head]]], size)
            later = ids[doc] > least
            rows = [(p, REMOVED, body, None) for p, body in
                    _removal_rows(ids[doc[later]], tag[doc[later]], pos[later], buckets)]
            keep = np.flatnonzero(~later)
            bucket = ((other[keep] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
            keep = keep[np.argsort(bucket, kind="stable")]
            bucket = np.sort(bucket)
            for a, n in zip(*A.spans(bucket)):
                k = keep[a:a + n]
                first, count = A.spans(doc[k])
                d = doc[k[first]]
                rows.append((int(bucket[a]), WINDOWS,
                             A.pack(np.diff(ids[d], prepend=0), tag[d], count.astype(np.uint32),
                                    np.diff(pos[k].astype(np.int64), prepend=0).astype(np.int32)),
                             key[k].tobytes()))
            yield _emit(rows)
    return run


def _read(body):
    step, tag, count, gap = A.unpack(body, np.int64, np.uint32, np.uint32, np.int32)
    return np.repeat(np.cumsum(step), count), np.repeat(tag, count), np.cumsum(gap.astype(np.int64)).astype(np.uint32)


def _settle(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_pylist()
        body, hashes = table["body"], table["hashes"]
        rows = [(table["part"][i].as_py(), REMOVED, body[i].as_py(), None) for i in range(len(kind)) if kind[i] == REMOVED]
        held = [i for i in range(len(kind)) if kind[i] == WINDOWS]
        if held:
            doc, tag, pos = (np.concatenate(x) for x in zip(*(_read(body[i].as_py()) for i in held)))
            key = np.concatenate([np.frombuffer(hashes[i].as_buffer(), np.uint64) for i in held])
            order = np.argsort(key)
            head, size = A.spans(key[order])
            many = np.repeat(size > 1, size)                     # windows seen once are done with
            order, lone = order[many], size[size > 1]
            if len(order):
                start = np.concatenate(([0], np.cumsum(lone)[:-1]))
                least = np.repeat(np.minimum.reduceat(doc[order], start), lone)
                gone = order[doc[order] > least]
                rows += [(p, REMOVED, b, None) for p, b in _removal_rows(doc[gone], tag[gone], pos[gone], buckets)]
        return pa.Table.from_batches([_emit(rows)])
    return run


def _cut(window: int):
    def run(texts: pa.Table, removed: pa.Table) -> pa.Table:
        gone: dict[tuple[int, int], list] = {}
        for body in removed["body"].to_pylist():
            doc, tag, pos = _read(body)
            first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))) if len(doc) else []
            for a, z in zip(first, np.append(first[1:], len(doc)).astype(int)):
                gone.setdefault((int(doc[a]), int(tag[a])), []).append(pos[a:z])
        out = {n: [] for n in ("doc_id", "n_words", "n_removed", "kept_sha256", "intervals")}
        for table in A.chunks(iter(texts.to_batches()), "text"):
            raw, off = A.utf8(table["text"])
            tag = _tag(raw, off)
            for i, doc in enumerate(table["doc_id"].to_pylist()):
                found = raw[off[i]:off[i + 1]].tobytes().split()
                runs = []
                hit = gone.get((doc, int(tag[i]))) if doc is not None else None
                if hit:
                    start = np.unique(np.concatenate(hit)).astype(np.int64)
                    split = np.flatnonzero(np.diff(start) > window)      # windows that touch or overlap merge
                    runs = list(zip(start[np.append(0, split + 1)].tolist(),
                                    (start[np.append(split, len(start) - 1)] + window).tolist()))
                    left = np.ones(len(found), bool)
                    for a, z in runs:
                        left[a:z] = False
                    kept = list(compress(found, left.tolist()))
                else:
                    kept = found
                out["doc_id"].append(doc)
                out["n_words"].append(len(found))
                out["n_removed"].append(len(found) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
                out["intervals"].append([{"start": a, "end": z} for a, z in runs])
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
                 pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))
    return run


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                    buckets: int | None = None) -> DataFrame:
    """Remove words covered by a window that also starts in a text with a smaller id.

    Returns one row per input row: ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_sha256`` (of the kept words joined by one space) and ``intervals``
    (removed word ranges, end exclusive).  ``buckets`` follows the input's
    bytes by default and only sizes the work.
    """
    n = buckets or bucket_number(docs, text_col, BUCKET_BYTES)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sent = d.mapInArrow(_hash_windows(window, n), MESSAGE)
    removed = sent.groupBy("part").applyInArrow(_settle(n), MESSAGE).select("part", "body")

    parted = d.withColumn("part", _part_column(F.col("doc_id"), n))
    return parted.groupBy("part").cogroup(removed.groupBy("part")).applyInArrow(_cut(window), SCHEMA)
