"""Rolling isolation forest (D2) and its normalised score (D3).

Semantics (per series, rows with a NULL dropped first): for row i at time t,
the training window is every row from the last one at or before
``max(t - W, first ts)`` up to, but not including, row i.  With at least
``min_periods`` rows a forest is fitted on the window and row i is scored;
the score is ``2^(-E[h(x)]/c(psi)) - 0.5`` (the negated decision function of
the usual isolation forest: 100 trees, subsample ``min(256, n)`` without
replacement, depth limit ``ceil(log2(psi))``; Liu, Ting & Zhou 2008).
Optionally the forest is refitted once per time slot (``refit_every``).

Distribution.  Row j is needed by the rows in ``[t_j, next_ts_j + W)``
(it stays the window's first row until a later row passes ``t - W``).  Each
row is copied into every time block that range touches, so the work is
keyed by (series, block): a long series is scored by many tasks, each with
its home rows plus a bounded halo.  ``next_ts`` across block edges comes
from a one-row-per-block summary.  Each block is scored by numpy inside
``applyInPandas``; a path is followed only for the scored point, for all
trees at once (no tree is materialised), and a subsample is drawn without
touching the rest of its window.  The seed of each row's forest is
derived from (series, ts), so results are repeatable.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbitlens.functions.time import duration_us, epoch_us

EULER = 0.5772156649015329


def avg_path_length(n):
    """c(n): average path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


_M64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix64(z: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (vectorised): a 64-bit hash of each element."""
    with np.errstate(over="ignore"):
        z = z + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _node_draws(seed: int, trees: np.ndarray, nodes: np.ndarray, d: int):
    """Split draws of tree ``t`` at node ``k``: a uniform in [0, 1) and a
    feature index - a pure function of (seed, tree, node), so the forest is
    fixed once seeded and any point follows the same trees."""
    with np.errstate(over="ignore"):
        base = np.uint64(seed) * np.uint64(0xD1B54A32D192ED03)
        h = _mix64(base ^ (trees.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ nodes.astype(np.uint64))
        q = (_mix64(h) % np.uint64(d)).astype(np.int64) if d > 1 else np.zeros(len(h), dtype=np.int64)
    u = (h >> np.uint64(11)).astype(np.float64) * (1.0 / 9007199254740992.0)
    return u, q


class Forest:
    """An isolation forest fixed by (training rows, seed).

    Trees are never materialised: a point's path is followed lazily, all
    trees at once; node ``k`` splits with draws ``_node_draws(seed, t, k)``
    on the training samples that reached it (a random feature, a uniform
    split between that feature's min and max), children ``2k+1`` / ``2k+2``.
    """

    def __init__(self, window: np.ndarray, seed: int, n_trees: int = 100, max_samples: int = 256):
        n, d = window.shape
        self.psi = min(max_samples, n)
        self.d, self.n_trees, self.seed = d, n_trees, seed
        self.limit = int(math.ceil(math.log2(max(self.psi, 2))))
        if n <= max_samples:
            # the subsample is the whole window (order does not change a tree)
            self.S = np.broadcast_to(window, (n_trees, n, d))
        else:
            self.S = window[_subsamples(np.random.default_rng(seed), n, n_trees, self.psi)]   # [trees, psi, d]
        self.c_psi = avg_path_length(np.array([self.psi]))[0]
        # one feature: a node's samples are a stretch of the sorted ones
        self.V = np.sort(self.S[:1, :, 0] if n <= max_samples else self.S[:, :, 0], axis=1) if d == 1 else None

    def score(self, x: np.ndarray) -> float:
        """2^(-E[h(x)]/c(psi)) - 0.5 (the negated decision function)."""
        if self.psi <= 1:
            return 0.0  # a single-sample forest: every path has length c(1) = 0
        if self.V is not None:
            return self._score_sorted(float(x[0]))
        T = self.n_trees
        trees = np.arange(T)
        alive = np.ones((T, self.psi), dtype=bool)
        node = np.zeros(T, dtype=np.int64)
        depth = np.zeros(T)
        active = np.ones(T, dtype=bool)
        for _ in range(self.limit):
            active &= alive.sum(axis=1) > 1
            if not active.any():
                break
            u, q = _node_draws(self.seed, trees, node, self.d)
            vals = self.S[trees, :, q]                                     # [trees, psi]
            lo = np.where(alive, vals, np.inf).min(axis=1)
            hi = np.where(alive, vals, -np.inf).max(axis=1)
            with np.errstate(invalid="ignore"):
                p = lo + u * (hi - lo)
            go_left = x[q] < p
            side = np.where(go_left[:, None], vals < p[:, None], vals >= p[:, None])
            split = active & (hi > lo)
            alive = np.where(split[:, None], alive & side, alive)
            node = np.where(split, 2 * node + np.where(go_left, 1, 2), node)
            depth += split
            active &= split
        h = depth + avg_path_length(alive.sum(axis=1))
        return float(2.0 ** (-h.mean() / self.c_psi) - 0.5)


    def _score_sorted(self, x: float) -> float:
        """``score`` for one feature: a node is a stretch ``a .. b`` of the tree's sorted samples."""
        T = self.n_trees
        trees = np.arange(T)
        row = trees if len(self.V) == T else np.zeros(T, dtype=np.int64)
        a, b = np.zeros(T, dtype=np.int64), np.full(T, self.psi, dtype=np.int64)
        node = np.zeros(T, dtype=np.int64)
        depth = np.zeros(T)
        active = np.ones(T, dtype=bool)
        for _ in range(self.limit):
            active &= b - a > 1
            if not active.any():
                break
            u, _q = _node_draws(self.seed, trees, node, 1)
            lo, hi = self.V[row, a], self.V[row, b - 1]
            with np.errstate(invalid="ignore"):
                p = lo + u * (hi - lo)
            go_left = x < p
            split = active & (hi > lo)
            below = np.searchsorted(self.V[0], p) if len(self.V) == 1 else np.count_nonzero(self.V < p[:, None], axis=1)
            a = np.where(split & ~go_left, np.maximum(below, a), a)
            b = np.where(split & go_left, np.minimum(below, b), b)
            node = np.where(split, 2 * node + np.where(go_left, 1, 2), node)
            depth += split
            active &= split
        h = depth + avg_path_length(b - a)
        return float(2.0 ** (-h.mean() / self.c_psi) - 0.5)


def _subsamples(rng, n: int, n_trees: int, psi: int) -> np.ndarray:
    """``psi`` of ``n`` positions for every tree, without replacement, in any order.

    Of a long window positions are drawn one by one and drawn again where a tree has them already, so the work depends
    on ``psi`` and not on ``n``; of a short one (up to 4 ``psi``) those with the smallest of ``n`` random numbers."""
    if n <= 4 * psi:
        return np.argpartition(rng.random((n_trees, n)), psi - 1, axis=1)[:, :psi]
    kind = np.int32 if n < 2**31 else np.int64
    idx = np.sort(rng.integers(0, n, (n_trees, psi), dtype=kind), axis=1)
    todo = np.arange(n_trees)
    while len(todo):
        some = idx[todo]
        again = np.zeros(some.shape, dtype=bool)
        again[:, 1:] = some[:, 1:] == some[:, :-1]
        some[again] = rng.integers(0, n, int(again.sum()), dtype=kind)
        some.sort(axis=1)
        idx[todo] = some
        todo = todo[again.any(axis=1)]
    return idx


def isolation_score(window: np.ndarray, x: np.ndarray, rng_or_seed, n_trees: int = 100,
                    max_samples: int = 256) -> float:
    """Score one point ``x`` ([d]) against a forest trained on ``window`` ([n, d])."""
    seed = rng_or_seed if isinstance(rng_or_seed, (int, np.integer)) else int(rng_or_seed.integers(0, 2**31 - 1))
    return Forest(window, seed, n_trees, max_samples).score(x)


def _seed(series_hash: int, t_us: int) -> int:
    return (int(series_hash) * 1_000_003 + int(t_us)) & 0x7FFFFFFF


def _score_block_fn(feature_cols, W, min_periods, n_trees, max_samples, out_col, keys, refit_us):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t", kind="stable")
        t = pdf["_t"].to_numpy(np.int64)
        X = pdf[feature_cols].to_numpy(np.float64)
        home = pdf["_is_home"].to_numpy(bool)
        sh = pdf["_sh"].to_numpy(np.int64)
        res = []
        forest, slot = None, None

        def start(j):
            # first row of the window of row j: the last one with ts <= t_j - W, else the first
            return max(int(np.searchsorted(t, t[j] - W, side="right")) - 1, 0)

        for i in np.nonzero(home)[0]:
            s = start(i)
            if i - s < min_periods or i - s < 1:
                continue
            if refit_us:
                # fitted at the slot's first scored row, which may be a halo row of this block
                my_slot = int(t[i] // refit_us)
                if forest is None or my_slot != slot:
                    j = int(np.searchsorted(t, my_slot * refit_us, side="left"))
                    while j < i and (j - start(j) < min_periods or j - start(j) < 1):
                        j += 1
                    forest, slot = Forest(X[start(j):j], _seed(sh[j], t[j]), n_trees, max_samples), my_slot
                res.append((i, forest.score(X[i])))
            else:
                res.append((i, Forest(X[s:i], _seed(sh[i], t[i]), n_trees, max_samples).score(X[i])))
        if not res:
            return pd.DataFrame({**{k: pd.Series([], dtype=object) for k in keys},
                                 "_t": pd.Series([], dtype=np.int64), out_col: pd.Series([], dtype=float)})
        ii = [r[0] for r in res]
        out = pdf.iloc[ii][keys + ["_t"]].copy()
        out[out_col] = [r[1] for r in res]
        return out
    return fn


def rolling_isolation_forest(df: DataFrame, keys: list[str], feature_cols: list[str], *,
                             window="30D", min_periods: int = 5, ts: str = "ts",
                             n_trees: int = 100, max_samples: int = 256, block=None,
                             refit_every=None, out_col: str = "iso_score") -> DataFrame:
    """One forest per row over its trailing window; returns keys, ts, score.

    Rows without enough history get no row (the score is attached to its own
    row, unlike the reference which shifts scores to the last rows, Q4).
    ``refit_every`` (a duration; default: every row, as the reference) fits
    a forest at the first scored row of each time slot and scores the
    following rows of the slot with it - rows x trees of work becomes
    slots x trees for the fitting part.  Slots are global, so the result does
    not depend on the block layout.
    """
    W = duration_us(window)
    # default block = W: only home rows are scored, so the halo copies cost
    # shuffle bytes, not forest work, while more (series, block) groups run
    # in parallel
    B = max(duration_us(block) if block else W, W)
    x = df.select(*keys, ts, *feature_cols).na.drop("any")
    x = x.withColumn("_t", epoch_us(ts)).withColumn("_home", F.floor(F.col("_t") / B).cast("bigint"))
    # next row's time inside the block, and across block edges from a block summary
    wl = Window.partitionBy(*keys, "_home").orderBy("_t")
    x = x.withColumn("_next", F.lead("_t").over(wl))
    firsts = x.groupBy(*keys, "_home").agg(F.min("_t").alias("_first"))
    nb = firsts.select(*keys, "_home", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_home"))
                       .alias("_next_blk_first"))
    from orbitlens.operators.windows import join_null_safe
    x = join_null_safe(x, nb, [*keys, "_home"])
    nxt = F.coalesce(F.col("_next"), F.col("_next_blk_first"), F.col("_t"))
    # with refitting, a slot that began before the block brings its own window along
    reach = W + (duration_us(refit_every) if refit_every else 0)
    reach_end = F.floor((nxt + F.lit(reach) - 1) / B).cast("bigint")
    x = x.withColumn("_blk", F.explode(F.sequence(F.col("_home"), F.greatest(reach_end, F.col("_home")))))
    x = x.withColumn("_is_home", F.col("_blk") == F.col("_home")) \
         .withColumn("_sh", F.xxhash64(*keys))
    schema = ", ".join([f"`{k}` string" for k in keys] + ["_t bigint", f"`{out_col}` double"])
    refit_us = duration_us(refit_every) if refit_every else None
    fn = _score_block_fn(feature_cols, W, min_periods, n_trees, max_samples, out_col, keys, refit_us)
    # CPU-bound Python: an explicit hash repartition keeps AQE from packing
    # all (series, block) groups - small in bytes - into one task
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scored = (x.select(*keys, "_blk", "_t", "_is_home", "_sh", *feature_cols)
              .repartition(n_parts, *keys, "_blk")
              .groupBy(*keys, "_blk").applyInPandas(fn, schema))
    from orbitlens.functions.time import from_epoch_us
    return scored.select(*keys, from_epoch_us("_t").alias(ts), out_col)


def isolation_forest_anomaly(df: DataFrame, keys: list[str], feature_cols: list[str], *,
                             window="30D", sigma: float = 3.0, min_periods: int = 5,
                             window_norm=None, min_periods_norm=None, ts: str = "ts",
                             base_name: str | None = None, tile_us: int | None = None,
                             materialize_input: bool = False, **forest_kw) -> DataFrame:
    """D3: D2, then the rolling z-score of the scores (W3, same window by
    default), added to the input as ``<base>_iso_score``; > 1 is an anomaly.
    Keyword arguments throughout (the reference passes min_periods in the
    sigma position, Q3).

    The input feeds three branches (forest rows, the forest's block summary,
    the final join).  For a derived input (e.g. hourly statistics) pass
    ``materialize_input=True``: it is written once with a reliable
    ``checkpoint()`` in the shared checkpoint folder, so the upstream plan is
    not recomputed per branch.  A raw parquet input is cheaper to re-scan.
    """
    from orbitlens.operators.windows import join_null_safe, rolling_zscore
    if materialize_input:
        from orbitlens.session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    window_norm = window_norm or window
    min_periods_norm = min_periods if min_periods_norm is None else min_periods_norm
    name = f"{base_name or feature_cols[0]}_iso_score"
    sc = rolling_isolation_forest(df, keys, feature_cols, window=window, min_periods=min_periods,
                                  ts=ts, out_col="_raw", **forest_kw)
    z = rolling_zscore(sc, keys, "_raw", window_norm, sigma=sigma, min_periods=min_periods_norm,
                       ts=ts, out=name, tile_us=tile_us)
    return join_null_safe(df, z.select(*keys, ts, name), [*keys, ts])
