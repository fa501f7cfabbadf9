"""Zero-phase low-pass filter over blocks (M5).

A fourth-order Butterworth filter, run forward and backward over a series that is
extended by its odd mirror image at both ends.  The filter is a linear system of
four states, so a block's effect on the state is one matrix and one vector: every
block is run from rest, the states are carried over the blocks of a series (a
matrix product a block), and each block is then run from its own first state.  No
task holds more of a series than a block and its states.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.forecast.spectrum import CURVE, INFO, _batch, _head
from orbitlens.operators.windows import join_null_safe

ORDER = 4
PAD = 3 * (ORDER + 1)      # mirrored points at each end
STEP = 64                  # points that one matrix product filters


def system(period: int):
    """(A, B, C, D) of the filter with its cut-off at ``1 / period`` of the highest frequency: two second-order sections."""
    warped = 4 * np.tan(np.pi / period / 2)
    poles = warped * np.exp(1j * np.pi * (2 * np.arange(ORDER) + ORDER + 1) / (2 * ORDER))
    gain = (warped ** ORDER / np.prod(4 - poles)).real
    z = (4 + poles) / (4 - poles)
    up = z[z.imag > 0]
    A, B, C, D = np.zeros((0, 0)), np.zeros(0), np.zeros(0), 1.0
    for i, p in enumerate(up):                           # a section: gain * (1 + 2 q + q**2) / (1 + a1 q + a2 q**2)
        g = gain if i == 0 else 1.0
        a1, a2 = -2 * p.real, abs(p) ** 2
        a = np.array([[-a1, 1.0], [-a2, 0.0]])
        b, c, d = g * np.array([2 - a1, 1 - a2]), np.array([1.0, 0.0]), g
        A = np.block([[A, np.zeros((len(B), 2))], [np.outer(b, C), a]])
        B, C, D = np.concatenate([B, b * D]), np.concatenate([d * C, c]), d * D
    return A, B, C, D


class Filter:
    def __init__(self, period: int):
        self.A, self.B, self.C, self.D = system(period)
        self.rest = np.linalg.solve(np.eye(ORDER) - self.A, self.B)       # state under a constant input of 1
        powers = [np.eye(ORDER)]
        for _ in range(STEP):
            powers.append(powers[-1] @ self.A)
        self.over = powers[STEP]
        self.read = np.array([self.C @ p for p in powers[:STEP]])         # what a state adds to the next outputs
        self.write = np.array([p @ self.B for p in powers[STEP - 1::-1]]).T
        h = np.concatenate([[self.D], self.read[:-1] @ self.B])
        self.impulse = np.array([[h[i - j] if i >= j else 0.0 for j in range(STEP)] for i in range(STEP)])

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(outputs, last state)."""
        whole = len(x) // STEP * STEP
        rows = x[:whole].reshape(-1, STEP)
        add = rows @ self.write.T
        starts = np.empty((len(rows), ORDER))
        for i in range(len(rows)):
            starts[i] = state
            state = self.over @ state + add[i]
        out = [(rows @ self.impulse.T + starts @ self.read.T).ravel()]
        for v in x[whole:]:
            out.append([self.C @ state + self.D * v])
            state = self.A @ state + self.B * v
        return np.concatenate(out), state


def _finals(keys: list[str], back: bool):
    """A block's last state from rest, its length and its first point in running order."""
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for r in range(t.num_rows):
                x = t["x"][r].values.to_numpy(zero_copy_only=False)
                x = x[::-1] if back else x
                _, s = Filter(t["period"][r].as_py()).run(x, np.zeros(ORDER))
                yield _batch(_head(t, [*keys, "period", "blk"], r), {"len": pa.array([len(x)], pa.int64()), "start": pa.array([float(x[0])]),
                                                                    "state": pa.array([s.tolist()], pa.list_(pa.float64()))})
    return run


def _carry(keys: list[str], back: bool):
    """First state of every block of a series, in running order."""
    def run(table: pa.Table) -> pa.Table:
        f = Filter(table["period"][0].as_py())
        order = np.argsort(table["blk"].to_numpy())
        order = order[::-1] if back else order
        size, adds = table["len"].to_numpy(), table["state"].to_pylist()
        state, over, firsts = f.rest * table["start"][int(order[0])].as_py(), {}, {}
        for i in order:
            firsts[i] = state.tolist()
            n = int(size[i])
            if n not in over:
                over[n] = np.linalg.matrix_power(f.A, n)
            state = over[n] @ state + np.array(adds[i])
        head = {k: table[k] for k in [*keys, "blk"]}
        return pa.table({**head, "first": pa.array([firsts[i] for i in range(len(size))], pa.list_(pa.float64()))})
    return run


def _filtered(keys: list[str], names: list[str], back: bool):
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for r in range(t.num_rows):
                x = t["x"][r].values.to_numpy(zero_copy_only=False)
                y, _ = Filter(t["period"][r].as_py()).run(x[::-1] if back else x, np.array(t["first"][r].as_py()))
                yield _batch(_head(t, names, r), {"x": pa.array([(y[::-1] if back else y).tolist()], pa.list_(pa.float64()))})
    return run


def low_pass(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks of ``spectrum.series_blocks`` with a column ``period``: the same blocks, filtered.  A series needs more
    than PAD points."""
    from orbitlens.session import checkpoint_dir
    checkpoint_dir(blocks.sparkSession)
    blocks = blocks.where(F.col("n") > PAD)
    key_types = "".join(f"`{k}` {blocks.schema[k].dataType.simpleString()}, " for k in keys)
    # the odd mirror image: 2 x[0] - x[15 .. 1] before, 2 x[n-1] - x[n-2 .. n-16] after
    edge = (blocks.where((F.col("blk") == 0) | (F.col("blk") >= F.expr(f"(n - {PAD + 1}) div {CURVE}")))
            .select(*keys, *INFO, "period", F.posexplode("x").alias("i", "v"), (F.col("blk") * CURVE).alias("at")))
    edge = edge.withColumn("i", F.col("at") + F.col("i")).where((F.col("i") <= PAD) | (F.col("i") >= F.col("n") - PAD - 1))
    ends = edge.groupBy(*keys, *INFO, "period").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("e"))
    head = F.transform(F.slice("e", 1, PAD + 1), lambda p: p["v"])
    tail = F.transform(F.slice("e", -(PAD + 1), PAD + 1), lambda p: p["v"])
    cols = [*keys, *INFO, "period"]
    before = ends.select(*cols, F.lit(-1).cast("long").alias("blk"), F.reverse(F.transform(F.slice(head, 2, PAD), lambda v: 2 * F.get(head, F.lit(0)) - v)).alias("x"))
    after = ends.select(*cols, (F.expr(f"(n - 1) div {CURVE}") + 1).alias("blk"), F.reverse(F.transform(F.slice(tail, 1, PAD), lambda v: 2 * F.get(tail, F.lit(PAD)) - v)).alias("x"))
    x = blocks.select(*cols, "blk", "x").unionByName(before).unionByName(after)
    names = [*cols, "blk"]
    types = f"{key_types}n long, mean double, c0 double, period long, blk long"
    for back in (False, True):
        x = x.checkpoint()
        ends = x.mapInArrow(_finals(keys, back), f"{key_types}period long, blk long, len long, start double, state array<double>")
        firsts = ends.groupBy(*keys).applyInArrow(_carry(keys, back), f"{key_types}blk long, first array<double>")
        x = (join_null_safe(x, firsts, [*keys, "blk"], "inner").select(*names, "x", "first")
             .mapInArrow(_filtered(keys, names, back), f"{types}, x array<double>"))
    return x.where(F.col("blk").between(0, F.expr(f"(n - 1) div {CURVE}"))).drop("period")
