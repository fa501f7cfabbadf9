"""Arrow string columns as flat byte arrays: words, hashes, packed integers.

Python tasks get Arrow batches; these helpers cut them into chunks of bounded
size and tokenise a whole chunk with array operations.  A word is a maximal run
of bytes outside ``{0x20, 0x09-0x0D}`` (all ASCII, so UTF-8 needs no decoding).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20          # bytes that one array pass works on
CHUNK_BYTES = 4 << 20      # text bytes that one chunk of rows holds (a longer row is a chunk of its own)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: multipliers of two independent rolling hashes
ROLL = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0xD1342543DE82EF95))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def release() -> None:
    """Give freed memory back to the system: an idle worker process otherwise keeps its largest chunk."""
    import ctypes
    import sys

    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """Re-cut a stream of batches into tables of at most ``limit`` text bytes."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + limit - size, side="right")) - 1
            end = min(max(end, at + (not held)), batch.num_rows)
            if end > at:
                held.append(batch.slice(at, end - at))
                size += int(off[end] - off[at])
            if end < batch.num_rows or size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            at = end
    if held:
        yield pa.Table.from_batches(held)
    held = None
    release()


def words(raw: np.ndarray, off: np.ndarray, hashed: bool = True, space: np.ndarray = SPACE):
    """(start, end, text index, hash) of every word, in order; ``space`` marks the bytes between words."""
    n = len(raw)
    out: list[tuple] = []
    lo = 0
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    while lo < n:
        hi = min(lo + SEGMENT, n)
        while hi < n and not cut[hi] and not space[raw[hi]]:     # never inside a word
            stop = min(hi + SEGMENT, n)
            gap = np.flatnonzero(space[raw[hi:stop]] | cut[hi:stop])
            hi = hi + int(gap[0]) if len(gap) else stop
        seg = raw[lo:hi]
        inside = ~space[seg]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | cut[lo + 1:hi]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | cut[lo + 1:hi]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(s):
            h = None
            if hashed:
                at = np.flatnonzero(inside)
                size = e - s
                begin = np.concatenate(([0], np.cumsum(size)[:-1]))
                place = np.arange(len(at), dtype=np.int32) - np.repeat(begin, size).astype(np.int32)
                power = np.ones(int(size.max()), np.uint64)
                power[1:] = _BASE
                power = np.multiply.accumulate(power)
                h = mix(np.add.reduceat(_BYTE[seg[at]] * power[place], begin) + size.astype(np.uint64))
            out.append((s + lo, e + lo, h))
        lo = hi
    if not out:
        z = np.empty(0, np.int64)
        return z, z, z, np.empty(0, np.uint64)
    s = np.concatenate([o[0] for o in out])
    e = np.concatenate([o[1] for o in out])
    h = np.concatenate([o[2] for o in out]) if hashed else None
    return s, e, np.searchsorted(off, s, side="right") - 1, h


def rolling(h: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every run of ``k`` consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= ROLL[which]
        out += h[j:j + n]
    return mix(out)


def within(doc: np.ndarray, k: int) -> np.ndarray:
    """Which runs of ``k`` words stay inside one text."""
    n = len(doc) - k + 1
    return doc[:n] == doc[k - 1:] if n > 0 else np.empty(0, bool)


def spans(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of every run of equal values."""
    if not len(key):
        z = np.empty(0, np.int64)
        return z, z
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return first, np.diff(np.append(first, len(key)))


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as one compressed value: byte planes, so that small numbers cost about a byte."""
    import zstandard

    head = np.array([len(arrays)] + [x for a in arrays for x in (len(a), a.dtype.itemsize)], np.int64).tobytes()
    body = b"".join(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes()
                    if len(a) else b"" for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def unpack(value: bytes, *dtypes) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, 2 * n, 8).reshape(n, 2)
    at, out = 8 + 16 * n, []
    for (count, width), kind in zip(sizes, dtypes, strict=True):
        raw = np.frombuffer(data, np.uint8, count * width, at).reshape(width, count)
        out.append(np.ascontiguousarray(raw.T).reshape(-1).view(kind) if count else np.empty(0, kind))
        at += int(count * width)
    return out
