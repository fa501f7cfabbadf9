"""Projections and filters (F1-F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbitlens.functions.time import epoch_us
from orbitlens.operators.detect import flag_out_of_bounds  # noqa: F401  (F8)


def scale_metric(df: DataFrame, factor: float = 2, *, value: str = "value",
                 metric: str = "metric") -> DataFrame:
    """divide by ``factor``, rename the series to ``<metric>_processed_div<factor>``."""
    return df.withColumns({
        value: F.col(value) / F.lit(float(factor)),
        metric: F.concat(F.col(metric), F.lit(f"_processed_div{factor}")),
    })


def after_checkpoint(df: DataFrame, mark, *, ts: str = "ts") -> DataFrame:
    """rows strictly newer than ``mark`` (a literal or a column, e.g. a
    per-series mark joined in)."""
    from orbitlens.sources.telemetry import _ts_lit
    return df.filter(F.col(ts) > _ts_lit(mark))


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """drop rows with any NULL (or NaN) in ``subset`` (default all columns)."""
    return df.na.drop("any", subset=subset)


def interval_counts(df: DataFrame, intervals: DataFrame, *, ts: str = "ts", start: str = "start",
                    end: str = "end", out: str = "n_intervals") -> DataFrame:
    """Rows inside at least one closed [start, end] range, with the number of ranges that hold them.

    A sweep over the range boundaries, the same plan for ten ranges and for ten million.  Time is cut into
    slices; a boundary is one row of its slice, and the ranges open at a slice's start are a running sum over
    the slices (a small table, whatever the ranges' lengths).  Inside a slice a running sum over boundaries and
    rows in time order gives every row's count, so the work is rows + boundaries, not rows x ranges.  The one
    scalar job reads the ranges' extent, which also prunes the scan of ``df``.  Ranges that end before they
    start, or with a NULL end, hold nothing.
    """
    spark = df.sparkSession
    iv = (intervals.select(epoch_us(start).alias("s"), (epoch_us(end) + 1).alias("e")).where("s < e"))
    lo, hi = iv.agg(F.min("s"), F.max("e")).first()
    if lo is None:
        return df.limit(0).withColumn(out, F.lit(0).cast("bigint"))
    slices = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = max(1, -(-(hi - lo) // slices))
    part = lambda c: F.call_function("div", F.col(c) - F.lit(lo), F.lit(width))
    bounds = (iv.select(F.explode(F.array(F.struct(F.col("s").alias("t"), F.lit(1).alias("d")), F.struct(F.col("e").alias("t"), F.lit(-1).alias("d")))).alias("b"))
              .select("b.t", "b.d").groupBy("t").agg(F.sum("d").cast("bigint").alias("d")).withColumn("_slice", part("t")))
    opened = bounds.groupBy("_slice").agg(F.sum("d").alias("d")).unionByName(
        spark.range(slices + 1).select(F.col("id").alias("_slice"), F.lit(0).cast("bigint").alias("d")))
    opened = opened.groupBy("_slice").agg(F.sum("d").alias("d"))             # slices + 1 rows
    opened = opened.select("_slice", F.coalesce(F.sum("d").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_open"))
    cols = df.columns
    rows = (df.withColumn("_t", epoch_us(ts)).where((F.col("_t") >= lo) & (F.col("_t") < hi))
            .select(F.col("_t"), part("_t").alias("_slice"), F.lit(0).cast("bigint").alias("_d"), F.struct(*cols).alias("_row")))
    marks = bounds.select(F.col("t").alias("_t"), "_slice", F.col("d").alias("_d"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy("_slice").orderBy("_t", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    x = rows.unionByName(marks).withColumn("_n", F.sum("_d").over(w)).where("_row is not null").join(opened, "_slice")
    x = x.withColumn(out, (F.col("_n") + F.col("_open")).cast("bigint")).where(F.col(out) > 0)
    return x.select(*[F.col("_row")[c].alias(c) for c in cols], out)


def filter_intervals(df: DataFrame, intervals: DataFrame, *, ts: str = "ts",
                     start: str = "start", end: str = "end") -> DataFrame:
    """rows inside any closed [start, end] range, each repeated once per range that holds it."""
    cols = df.columns
    x = interval_counts(df, intervals, ts=ts, start=start, end=end, out="_times")
    return x.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).select(*cols)


def rename_columns(df: DataFrame, mapping: dict | None = None, *, drop_like: str | None = None) -> DataFrame:
    """rename by mapping; optionally drop columns whose name contains ``drop_like``."""
    if mapping:
        df = df.withColumnsRenamed(mapping)
    if drop_like:
        df = df.drop(*[c for c in df.columns if drop_like in c])
    return df
