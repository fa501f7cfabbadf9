"""Expression-based anomaly detectors: moving average bands (D1), bounds (D5),
out-of-bounds flag (F8).

D1 for every value column c, with W = window and s = sigma:

    m  = shifted rolling mean of c
    r  = |c - m|
    mr = shifted rolling mean of r,  sr = shifted rolling std of r
    score = ((r - mr - delta) / (sr + 1e-8)) / s
    anomaly = c where score > 1
    upper = s (sr + 1e-8) + mr + m + delta
    lower = -s (sr + 1e-8) - mr + m - delta

All columns are computed in one plan: the default layout has one hash
exchange on the series keys and one sort; the tiled layout (``tile_us``)
spreads a long series over (series, block) tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.functions.time import duration_us
from orbitlens.operators.windows import T, join_null_safe, rolling_stats, with_epoch

MA_EXT = ["_ma_anomaly_score", "_ma_anomaly", "_ma_upper_bound", "_ma_lower_bound", "_ma_aggregated"]


def moving_average_anomaly(df: DataFrame, keys: list[str], cols, *, window="30D",
                           min_periods: int = 48, sigma: float = 4.0, delta: float = 0.01,
                           return_aggregated: bool = False, return_bounds: bool = True,
                           ts: str = "ts", tile_us: int | None = None,
                           method: str = "frame", carry=()) -> DataFrame:
    """``ma(df, window, min_periods, sigma, delta, ...)`` per series.

    Output: keys, ts, then extension-major columns ``<col><ext>`` for every
    input column (score, anomaly, [upper, lower], [aggregated]), then the
    columns ``carry`` of the input row, unchanged (with one value column).
    """
    if isinstance(cols, str):
        cols = [cols]
    if len(cols) > 1:
        if carry:
            raise ValueError("carry needs one value column")
        return _ma_many(df, keys, cols, window=window, min_periods=min_periods, sigma=sigma, delta=delta,
                        return_aggregated=return_aggregated, return_bounds=return_bounds, ts=ts,
                        tile_us=tile_us, method=method)
    x = with_epoch(df.select(*keys, ts, *cols, *carry), ts)
    for c in cols:
        x = rolling_stats(x, keys, c, window, min_periods=min_periods, shift=1,
                          stats=("mean",), ts=ts, prefix=f"_m_{c}", tile_us=tile_us, method=method)
        x = x.withColumn(f"_r_{c}", F.abs(F.col(c) - F.col(f"_m_{c}_mean")))
        x = rolling_stats(x, keys, f"_r_{c}", window, min_periods=min_periods, shift=1,
                          stats=("mean", "std"), ts=ts, prefix=f"_rr_{c}", tile_us=tile_us, method=method)
    outs = {}
    sig = F.lit(float(sigma))
    d = F.lit(float(delta))
    for c in cols:
        m, r = F.col(f"_m_{c}_mean"), F.col(f"_r_{c}")
        mr, sr = F.col(f"_rr_{c}_mean"), F.col(f"_rr_{c}_std")
        score = ((r - mr - d) / (sr + F.lit(1e-8))) / sig
        outs[c] = {
            "_ma_anomaly_score": score,
            "_ma_anomaly": F.when(score > 1, F.col(c)),
            "_ma_upper_bound": sig * (sr + F.lit(1e-8)) + mr + m + d,
            "_ma_lower_bound": -sig * (sr + F.lit(1e-8)) - mr + m - d,
            "_ma_aggregated": F.col(c),
        }
    exts = ["_ma_anomaly_score", "_ma_anomaly"]
    if return_bounds:
        exts += ["_ma_upper_bound", "_ma_lower_bound"]
    if return_aggregated:
        exts += ["_ma_aggregated"]
    sel = [outs[c][e].alias(f"{c}{e}") for e in exts for c in cols]
    return x.select(*keys, ts, *sel, *carry)


def _ma_many(df, keys, cols, *, ts, return_aggregated, return_bounds, **kw):
    """D1 on several columns: the columns become a key (``unpivot``), one pair
    of rolling stages runs for all of them, and a pivot with the explicit
    column list restores the wide layout.  One window pipeline instead of
    one per column."""
    long = df.select(*keys, ts, *[F.col(c).cast("double").alias(c) for c in cols]) \
             .unpivot([*keys, ts], cols, "_col", "_x")
    one = moving_average_anomaly(long, [*keys, "_col"], ["_x"], ts=ts, return_aggregated=True,
                                 return_bounds=True, **kw)
    exts = ["_ma_anomaly_score", "_ma_anomaly"]
    if return_bounds:
        exts += ["_ma_upper_bound", "_ma_lower_bound"]
    if return_aggregated:
        exts += ["_ma_aggregated"]
    aggs = [F.first(f"_x{e}").alias(e[1:]) for e in exts]
    wide = one.groupBy(*keys, ts).pivot("_col", list(cols)).agg(*aggs)
    return wide.select(*keys, ts, *[F.col(f"{c}_{e[1:]}").alias(f"{c}{e}") for e in exts for c in cols])


def history_needed_us(window) -> int:
    """How far before a point the moving-average detector looks.

    A point's frame ends at the point before it and holds residuals, whose own
    frames end at the point before each: two windows and two steps between
    neighbouring points.  A third window covers the steps as long as the two
    together are no longer than that."""
    return 3 * duration_us(window)


def flag_out_of_bounds(x, lb, ub):
    """F8: the value when it lies outside [lb, ub], else NULL."""
    x, lb, ub = (F.col(c) if isinstance(c, str) else c for c in (x, lb, ub))
    return F.when((x < lb) | (x > ub), x)


def bounds_anomaly(values: DataFrame, bounds: DataFrame, keys: list[str], *, ts: str = "ts",
                   value: str = "value", lb: str = "LB", ub: str = "UB",
                   out: str = "bounds_score") -> DataFrame:
    """On common (series, ts): score = max(LB - x, x - UB); > 0 is outside.

    J1 inner equi-join on the series keys and the timestamp, both sides
    shuffled once on the same keys.  The value column is dropped.
    """
    j = join_null_safe(values.select(*keys, ts, value), bounds.select(*keys, ts, lb, ub), [*keys, ts], "inner")
    return j.select(*keys, ts, F.greatest(F.col(lb) - F.col(value), F.col(value) - F.col(ub)).alias(out))


__all__ = ["moving_average_anomaly", "flag_out_of_bounds", "bounds_anomaly", "MA_EXT", "T"]
