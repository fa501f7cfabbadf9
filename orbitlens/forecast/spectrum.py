"""Fourier transforms of whole series, spread over tasks (M2, M4).

A transform of length M = P * Q runs as the four-step algorithm on blocks:

1. columns: the points ``j = j1 * Q + j2`` of a block of columns ``j2`` meet in a
   group; transforms of length P run down the columns, then the phase factors;
2. the result is dealt out by blocks of ``k1`` (a distributed transposition) and
   transforms of length Q run over ``j2``; a group now holds ``k1 + P * k2``.

The second transform of a pair starts where the first ends: its columns are the
groups of step 2, so there and back costs three shuffles.  A group holds about
``block`` points, whatever the series' length; all series run in one plan.

* Autocorrelation: the padded series' power spectrum, transformed once more.
* Spectrum at a length n that is no power of two: the chirp form, a convolution
  with ``exp(i pi j**2 / n)``, whose own transform each group makes for itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.operators.windows import join_null_safe

BLOCK = 1 << 16            # points of one group
CURVE = 8192               # consecutive points of one block of a curve or series
INFO = ["n", "mean", "c0"]
INFO_TYPES = "n long, mean double, c0 double"


def shape(n: int) -> tuple[int, int]:
    """(P, Q), powers of two with P * Q >= 2 n - 1."""
    p = max(2, (2 * n - 1).bit_length())
    return 1 << ((p + 1) // 2), 1 << (p // 2)


def _wide(rows: int, cols: int, block: int) -> int:
    """Columns of one group."""
    return max(1, min(cols, block // rows))


def _phase(num: np.ndarray, den: int) -> np.ndarray:
    """exp(-2 pi i num / den) for integers, reduced before the division."""
    return np.exp(-2j * np.pi * ((num % den) / den))


def _chirp(j: np.ndarray, n: int) -> np.ndarray:
    """exp(i pi j**2 / n)."""
    return np.exp(1j * np.pi * ((j * j) % (2 * n)) / n)


def _batch(head: dict, cols: dict) -> pa.RecordBatch:
    """One record batch: constant columns (value, type) before the others."""
    n = len(next(iter(cols.values())))
    names = [*head, *cols]
    return pa.RecordBatch.from_arrays([pa.array([v] * n, t) for v, t in head.values()] + list(cols.values()), names=names)


def _head(table: pa.Table, names: list[str], row: int = 0) -> dict:
    return {c: (table[c][row].as_py(), table.schema.field(c).type) for c in names}


# ------------------------------------------------------------------ blocks
def series_blocks(reg: DataFrame, keys: list[str], *, value: str = "value", idx: str = "idx", first_fraction: float = 1.0) -> DataFrame:
    """Keys, n, mean, c0 (sum of squares about the mean), blk, x: the first ``first_fraction`` of each series in blocks."""
    n = reg.groupBy(*keys).agg(F.floor(F.count(F.lit(1)) * first_fraction).cast("long").alias("n"))
    part = join_null_safe(reg.select(*keys, F.col(idx).cast("long").alias("_i"), F.col(value).cast("double").alias("_v")), n, keys, "inner").where("_i < n")
    about = part.groupBy(*keys, "n").agg(F.avg("_v").alias("mean"), (F.var_pop("_v") * F.count(F.lit(1))).alias("c0"))
    blocks = (part.groupBy(*keys, "n", F.expr(f"_i div {CURVE}").alias("blk"))
              .agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("p")))        # CURVE points at most
    x = F.transform("p", lambda e: e["_v"])
    return join_null_safe(blocks, about.drop("n"), keys, "inner").select(*keys, *INFO, "blk", x.alias("x"))


# ------------------------------------------------------------------ transforms
def _to_columns(keys: list[str], block: int, chirp: bool):
    """Step 1's messages: what a block of points has of each column block."""
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for r in range(t.num_rows):
                head = _head(t, [*keys, *INFO], r)
                n, mean = head["n"][0], head["mean"][0]
                P, Q = shape(n)
                c = _wide(P, Q, block)
                j = t["blk"][r].as_py() * CURVE + np.arange(len(t["x"][r]))
                x = np.asarray(t["x"][r].values.to_numpy(zero_copy_only=False))
                v = x * np.conj(_chirp(j, n)) if chirp else (x - mean).astype(complex)
                part = (j % Q) // c
                o = np.argsort(part, kind="stable")
                cut = np.flatnonzero(np.diff(part[o])) + 1
                pieces = [(part[k[0]], j[k].tobytes(), v[k].tobytes()) for k in np.split(o, cut)]
                yield _batch(head, {"part": pa.array([p for p, _, _ in pieces], pa.int64()), "at": pa.array([a for _, a, _ in pieces], pa.binary()),
                                    "body": pa.array([b for _, _, b in pieces], pa.binary())})
    return run


def _messages(head: dict, y: np.ndarray, first: int, block_of: int) -> pa.Table:
    """Rows of ``y`` (new index, columns) dealt out by blocks of ``block_of`` rows; ``first`` is the first column's number."""
    parts = range(0, y.shape[-2], block_of)
    body = [np.ascontiguousarray(y[..., a:a + block_of, :]).tobytes() for a in parts]
    at = np.array([first, y.shape[-1]], np.int64).tobytes()
    return pa.Table.from_batches([_batch(head, {"part": pa.array(range(len(body)), pa.int64()), "at": pa.array([at] * len(body), pa.binary()),
                                                "body": pa.array(body, pa.binary())})])


def _gather(table: pa.Table, channels: int, rows: int, cols: int) -> np.ndarray:
    """(channels, rows, cols) of a group from messages that each hold some rows (as columns there)."""
    out = np.zeros((channels, rows, cols), complex)
    for at, body in zip(table["at"].to_pylist(), table["body"].to_pylist()):
        first, k = np.frombuffer(at, np.int64)
        out[:, first:first + k, :] = np.frombuffer(body, complex).reshape(channels, -1, k).transpose(0, 2, 1)[:, :, :cols]
    return out


def _down_columns(keys: list[str], block: int, chirp: bool):
    def run(table: pa.Table) -> pa.Table:
        head = _head(table, [*keys, *INFO])
        n, part = head["n"][0], table["part"][0].as_py()
        P, Q = shape(n)
        c = _wide(P, Q, block)
        first = part * c
        c = min(c, Q - first)
        x = np.zeros((1 + chirp, P, c), complex)
        for at, body in zip(table["at"].to_pylist(), table["body"].to_pylist()):
            j = np.frombuffer(at, np.int64)
            x[0, j // Q, j % Q - first] = np.frombuffer(body, complex)
        cols = first + np.arange(c)
        if chirp:                                        # the chirp over -(n-1) .. n-1, wrapped round
            j = np.arange(P)[:, None] * Q + cols
            back = P * Q - j
            near = np.where(j < n, j, np.where(back < n, back, 0))
            x[1] = np.where((j < n) | (back < n), _chirp(near, n), 0)
        y = np.fft.fft(x, axis=1) * _phase(np.arange(P)[:, None] * cols, P * Q)
        return _messages(head, y, first, _wide(Q, P, block))
    return run


def _turn(keys: list[str], block: int, chirp: bool):
    """Finish the first transform, multiply, and start the second one on the same group."""
    def run(table: pa.Table) -> pa.Table:
        head = _head(table, [*keys, *INFO])
        n, part = head["n"][0], table["part"][0].as_py()
        P, Q = shape(n)
        c = _wide(Q, P, block)
        first = part * c
        c = min(c, P - first)
        x = np.fft.fft(_gather(table, 1 + chirp, Q, c), axis=1)
        z = np.conj(x[0] * x[1]) if chirp else np.abs(x[0]) ** 2
        y = np.fft.fft(z, axis=0) * _phase(np.arange(Q)[:, None] * (first + np.arange(c)), P * Q)
        return _messages(head, y[None], first, _wide(P, Q, block))
    return run


def _finish(keys: list[str], block: int, chirp: bool):
    def run(table: pa.Table) -> pa.Table:
        head = _head(table, [*keys, *INFO])
        n, part = head["n"][0], table["part"][0].as_py()
        P, Q = shape(n)
        c = _wide(P, Q, block)
        first = part * c
        c = min(c, Q - first)
        out = np.fft.fft(_gather(table, 1, P, c)[0], axis=0) / (P * Q)
        place = np.arange(P)[:, None] * Q + first + np.arange(c)
        if chirp:
            keep, v = (place >= 1) & (place <= (n - 1) // 2), np.abs(out)
        else:
            keep, v = place < n, out.real / head["c0"][0]
        return pa.Table.from_batches([_batch({k: head[k] for k in [*keys, "n"]}, {"place": pa.array(place[keep]), "y": pa.array(v[keep])})])
    return run


def _transformed(blocks: DataFrame, keys: list[str], chirp: bool, block: int) -> DataFrame:
    key_types = "".join(f"`{k}` {blocks.schema[k].dataType.simpleString()}, " for k in keys)
    message = f"{key_types}{INFO_TYPES}, part long, at binary, body binary"
    group = [*keys, *INFO, "part"]
    x = blocks.select(*keys, *INFO, "blk", "x").mapInArrow(_to_columns(keys, block, chirp), message)
    x = x.groupBy(*group).applyInArrow(_down_columns(keys, block, chirp), message)
    x = x.groupBy(*group).applyInArrow(_turn(keys, block, chirp), message)
    return x.groupBy(*group).applyInArrow(_finish(keys, block, chirp), f"{key_types}n long, place long, y double")


def autocorrelation_of(blocks: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """Keys, n, place (lag 0 .. n - 1), y; a constant series has none."""
    return _transformed(blocks.where("c0 > 0"), keys, False, block)


def spectrum_of(blocks: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """Keys, n, place (frequency 1 .. (n - 1) / 2), y (magnitude)."""
    return _transformed(blocks, keys, True, block)
