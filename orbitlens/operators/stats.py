"""Per-bucket statistics (A1-A9) and report aggregates.

``bucket_stats`` = the reference's hourly statistics: tumbling buckets
``[t, t+every)`` labelled by the right edge, empty buckets kept, ten
statistics with pandas semantics (labels in their correct order).

Plan: one hash exchange on (series, bucket).  ``max_diff`` needs the
previous row inside the bucket, a window partitioned by (series, bucket);
the aggregate on the same keys reuses that distribution, so the raw rows
cross the network once.  A hot series is spread over all its buckets.
Empty buckets are added from the aggregated rows (``expand_gaps``): no grid
join and no second scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbitlens.functions.time import duration_us, epoch_us, floor_us, from_epoch_us
from orbitlens.operators.resample import DEFAULT_BLOCK_BUCKETS

STAT_NAMES = ["mean", "count", "median", "std", "skew", "min", "max", "energy", "kurt", "max_diff"]


def corrected_skew(n: Column, g1: Column) -> Column:
    """pandas/Fisher-Pearson adjusted skewness from Spark's population g1.

    NULL below 3 values, 0 for zero variance (Spark returns NULL there).
    """
    adj = F.sqrt(n * (n - 1)) / (n - 2) * g1
    return F.when(n >= 3, F.coalesce(adj, F.lit(0.0)))


def corrected_kurt(n: Column, g2: Column) -> Column:
    """pandas adjusted excess kurtosis from Spark's population excess g2.

    NULL below 4 values, 0 for zero variance.
    """
    adj = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    return F.when(n >= 4, F.coalesce(adj, F.lit(0.0)))


def bucket_stats(df: DataFrame, keys: list[str], every="60T", *, ts: str = "ts",
                 value: str = "value", label: str = "right", keep_empty: bool = True,
                 exact_median: bool = True, out_ts: str = "bucket_end",
                 block_buckets: int = DEFAULT_BLOCK_BUCKETS,
                 max_buckets_per_series: int | None = None) -> DataFrame:
    """A1-A9 per (series, bucket).

    NULL values belong to their bucket as in pandas: ``energy`` divides by all
    rows of the bucket, ``max_diff`` takes no step from or to a NULL, the other
    statistics skip them; a bucket of NULLs has count 0 and energy 0."""
    step = duration_us(every)
    x = df.select(*keys, ts, value, floor_us(epoch_us(ts), step).alias("_b"))
    # ties in ts (daily dates) are ordered by value so max_diff is deterministic
    w = Window.partitionBy(*keys, "_b").orderBy(ts, value)
    x = x.withColumn("_d", F.abs(F.col(value) - F.lag(value).over(w)))
    v = F.col(value)
    med = F.median(v) if exact_median else F.percentile_approx(v, 0.5, 10000).cast("double")
    agg = (x.groupBy(*keys, "_b")
           .agg(F.avg(v).alias("mean"), F.count(v).alias("count"), med.alias("median"),
                F.stddev_samp(v).alias("std"), F.skewness(v).alias("_g1"),
                F.min(v).alias("min"), F.max(v).alias("max"),
                (F.coalesce(F.sum(v * v), F.lit(0.0)) / F.count(F.lit(1))).alias("energy"),
                F.kurtosis(v).alias("_g2"), F.max("_d").alias("max_diff")))
    n = F.col("count").cast("double")
    agg = agg.select(*keys, "_b", "mean", "count", "median", "std",
                     corrected_skew(n, F.col("_g1")).alias("skew"), "min", "max", "energy",
                     corrected_kurt(n, F.col("_g2")).alias("kurt"), "max_diff")
    if keep_empty:
        agg = expand_gaps(agg, keys, step, STAT_NAMES, zero_cols=("count",),
                          max_buckets_per_series=max_buckets_per_series)
    lab = F.col("_b") + (step if label == "right" else 0)
    return agg.select(*keys, from_epoch_us(lab).alias(out_ts), *STAT_NAMES)


def drop_open_bucket(df: DataFrame, keys: list[str], *, ts: str = "bucket_end") -> DataFrame:
    """drop the last (still open) bucket of every series.

    ``max(ts) over (partition by series)`` on the statistics table: it reuses
    the series partitioning of the gap expansion and of the detectors that
    follow, so no extra exchange and no second scan.
    """
    last = F.max(ts).over(Window.partitionBy(*keys))
    return df.withColumn("_last", last).filter(F.col(ts) < F.col("_last")).drop("_last")


def expand_gaps(agg: DataFrame, keys: list[str], step, cols, *, b: str = "_b",
                zero_cols=(), fill_from_next=(), max_buckets_per_series: int | None = None,
                block: int | None = None) -> DataFrame:
    """T2 on an aggregated table: add the empty buckets between present ones.

    Each present bucket emits itself plus the empty buckets up to the next
    present one (``lead`` over the series, ``explode(sequence)``): no grid
    table, no join, no second scan of the input.  Columns in ``zero_cols``
    become 0 in empty buckets, columns in ``fill_from_next`` take the next
    present bucket's value (pandas bfill), all others NULL.  ``step`` is an
    int (µs) or the name of a per-row BIGINT column (per-series frequency).

    ``max_buckets_per_series`` guards against a dense grid exploding for a
    sparse series (first and last point years apart at a 10 s step): the
    series span is computed and the job fails with a clear message instead
    of generating the rows.  ``block`` (µs) finds the next bucket inside time
    blocks (``windows.next_row``): no task holds a whole series.
    """
    step_c = F.col(step) if isinstance(step, str) else F.lit(step).cast("bigint")
    wn = Window.partitionBy(*keys).orderBy(b)
    if block:
        from orbitlens.operators.windows import next_row
        x = next_row(agg, keys, list(dict.fromkeys([b, *fill_from_next])), order=b, block=block, prefix="_nv_").withColumnRenamed(f"_nv_{b}", "_next")
    else:
        x = agg.withColumn("_next", F.lead(b).over(wn)).withColumns({f"_nv_{c}": F.lead(c).over(wn) for c in fill_from_next})
    if max_buckets_per_series is not None:
        from orbitlens.operators.windows import join_null_safe
        span = agg.groupBy(*keys).agg((F.max(b) - F.min(b)).alias("_span"))
        x = join_null_safe(x, span, keys).withColumn("_next", F.when(F.col("_span") / step_c + 1 > F.lit(max_buckets_per_series), F.raise_error(
            F.lit(f"time grid exceeds {max_buckets_per_series} buckets for a series; "
                  "use a coarser step or split the time range"))).otherwise(F.col("_next")))
    last = F.coalesce(F.col("_next") - step_c, F.col(b))
    x = x.withColumn("_g", F.explode(F.sequence(F.col(b), last, step_c)))
    present = F.col("_g") == F.col(b)
    out = {}
    for c in cols:
        if c in zero_cols:
            out[c] = F.when(present, F.col(c)).otherwise(F.lit(0)).cast("bigint")
        elif c in fill_from_next:
            out[c] = F.when(present, F.col(c)).otherwise(F.col(f"_nv_{c}"))
        else:
            out[c] = F.when(present, F.col(c))
    return x.select(*keys, F.col("_g").alias(b), *[e.alias(c) for c, e in out.items()])


def anomaly_count(df: DataFrame, keys: list[str], *, col: str = "anomaly") -> DataFrame:
    """A10: number of flagged points per series."""
    return df.groupBy(*keys).agg(F.count(col).alias("anomaly_count"))


def smape(y: Column, yhat: Column) -> Column:
    """A11 aggregate: mean(|y - yhat| / ((|y| + |yhat|) / 2)) * 100."""
    return F.avg(F.abs(y - yhat) / ((F.abs(y) + F.abs(yhat)) / 2)) * 100


def rmse(y: Column, yhat: Column) -> Column:
    """A12 aggregate."""
    return F.sqrt(F.avg(F.pow(y - yhat, 2)))
