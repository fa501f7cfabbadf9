"""Incremental reads against a high-water-mark table.

The mark table has one row per (pipeline, output, series): the last time
written.  A read joins it on the series keys (null-safe; one row per series,
the planner decides how) and keeps rows at or after the mark, or after
``now - default_lookback`` for series without a mark.  ``lookback`` moves the
start earlier so windows see history.  The earliest start of all series is a
literal, so the scan is pruned by it before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.functions.time import duration_us, epoch_us, floor_us, from_epoch_us, ntz_of_us


def read_since(df: DataFrame, marks: DataFrame, keys: list[str], now, *, pipeline: str,
               output: str, lookback=None, default_lookback="1D", align=None,
               ts: str = "ts") -> DataFrame:
    """Rows with ``ts >= coalesce(mark, now - 24 h) - lookback``.

    ``align`` floors the default start to a bucket (the reference's default
    start is not aligned, so its first bucket is partial).
    """
    from orbitlens.operators.windows import join_null_safe
    from orbitlens.sources.telemetry import _ts_lit

    # The mark table has one row per series; the planner broadcasts it when its
    # (file or runtime) size is below the broadcast threshold, else shuffles.
    m = (marks.filter((F.col("pipeline") == pipeline) & (F.col("output") == output))
         .select(*keys, F.col("ts").alias("_mark")))
    now_us = epoch_us(_ts_lit(now))
    default = now_us - F.lit(duration_us(default_lookback))
    if align:
        default = floor_us(default, duration_us(align))
    back = F.lit(duration_us(lookback) if lookback else 0)
    # one scalar; series without a mark start at the default, so it takes part
    lowest = m.agg(F.min(F.least(epoch_us("_mark"), default) - back)).first()[0]
    low = from_epoch_us(default - back) if lowest is None else ntz_of_us(lowest)
    x = join_null_safe(df.filter(F.col(ts) >= low), m, keys)
    return x.filter(F.col(ts) >= from_epoch_us(F.coalesce(epoch_us("_mark"), default) - back)).drop("_mark")


def model_context_window(marks: DataFrame, registry: DataFrame, keys: list[str], now, *,
                         margin_s: int = 180, max_ahead="1H") -> DataFrame:
    """Per series, the history window a forecast needs:
    ``[min(mark, now) - length_needed - 3 min, mark]``; no window when the mark
    is more than an hour ahead of now."""
    from orbitlens.sources.telemetry import _ts_lit
    now_us = epoch_us(_ts_lit(now))
    from orbitlens.operators.windows import join_null_safe
    j = join_null_safe(marks, registry, keys, "inner")
    m = epoch_us("ts")
    start = F.least(m, now_us) - F.col("length_needed_s") * 1_000_000 - F.lit(margin_s * 1_000_000)
    ok = m - now_us <= F.lit(duration_us(max_ahead))
    return j.filter(ok).select(*keys, from_epoch_us(start).alias("ctx_start"), F.col("ts").alias("ctx_end"))
