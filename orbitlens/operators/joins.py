"""Joins (J1-J5) and the broadcast size check used across the library."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.functions.time import epoch_us
from orbitlens.operators.resample import fill_gaps
from orbitlens.operators.windows import join_null_safe


def is_small(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (the limit is pushed into the
    scan), so it costs little even for a big input; only a side that passes it
    is ever broadcast.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def align_series(left: DataFrame, right: DataFrame, keys: list[str], *, ts: str = "ts") -> DataFrame:
    """Inner equi-join of two frames on (series, ts); a NULL tag is a value."""
    return join_null_safe(left, right, [*keys, ts], "inner")


def merge_outer(left: DataFrame, right: DataFrame, keys: list[str], *, ts: str = "ts") -> DataFrame:
    """Full outer join on (series, ts), null-safe; columns: keys, ts, left's others, right's others."""
    on = [*keys, ts]
    a = left.withColumnsRenamed({c: f"_l_{c}" for c in on})
    b = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = reduce(and_, [F.col(f"_l_{c}").eqNullSafe(F.col(f"_r_{c}")) for c in on])
    both = [F.coalesce(f"_l_{c}", f"_r_{c}").alias(c) for c in on]
    return a.join(b, cond, "full_outer").select(*both, *[c for d in (left, right) for c in d.columns if c not in on])


def merge_exogenous(history: DataFrame, future: DataFrame, keys: list[str], cols: list[str], *, ts: str = "ts",
                    block_us: int | None = None) -> DataFrame:
    """History joined with (future) exogenous values on (series, ts), rows of
    both kept; then ``cols`` are filled forward and, where a series starts
    without a value, backward.  ``block_us`` tiles the fill (hot series)."""
    return fill_gaps(merge_outer(history, future, keys, ts=ts), keys, cols, ts=ts, order="ffill_bfill", block_us=block_us)


def fill_target_with_forecast(df: DataFrame, *, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """After J2, the target takes the forecast where one exists."""
    return df.withColumn(y, F.coalesce(F.col(yhat), F.col(y)))


def nearest_row(df: DataFrame, refs: DataFrame, keys: list[str], *, ts: str = "ts",
                ref: str = "ref_ts") -> DataFrame:
    """Per series, the row closest in time to a reference time (ties -> the
    earlier row) and the number of rows after it ("rows remaining").

    ``refs`` has one row per series.  Distance minimum by ``min_by`` over a
    struct (distance, ts) - a grouped aggregation with partial aggregation,
    no sort of the series.
    """
    x = join_null_safe(df.select(*keys, ts), refs.select(*keys, ref), keys, "inner")
    d = F.abs(epoch_us(ts) - epoch_us(ref))
    best = (x.groupBy(*keys)
            .agg(F.min(F.struct(d.alias("d"), F.col(ts).alias("t"))).alias("_m"),
                 F.count(F.lit(1)).alias("_n")))
    best = best.select(*keys, F.col("_m.t").alias("nearest_ts"), "_n")
    after = (join_null_safe(x, best, keys, "inner").filter(F.col(ts) > F.col("nearest_ts"))
             .groupBy(*keys).agg(F.count(F.lit(1)).alias("_after")))
    return (join_null_safe(best, after, keys)
            .select(*keys, "nearest_ts", F.coalesce("_after", F.lit(0)).cast("bigint").alias("rows_after")))


def series_fanout(metrics: DataFrame, tags: DataFrame, *, max_rows: int = 1_000_000) -> DataFrame:
    """Every (metric, tag set) pair, one plan for all series.

    Both inputs are configuration tables; the product is formed only after
    checking that both are small (the product is what the reference iterates
    over one run at a time).
    """
    if not (is_small(metrics, max_rows) and is_small(tags, max_rows)):
        raise ValueError("series_fanout expects small configuration tables")
    return metrics.crossJoin(F.broadcast(tags))
