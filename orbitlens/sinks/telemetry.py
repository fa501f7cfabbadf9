"""Sinks (K1-K11): derived series back to a telemetry table.

``write_metrics`` turns a wide result (time, tags, one column per derived
metric) into canonical long rows and appends them to a parquet table
partitioned by metric and day.  Batching (K11) is a file-size bound
(``maxRecordsPerFile``), not a driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.functions.time import epoch_us

# Default tag name/value when none is given, and the write
# slice sizes of the reference (values, traces, constellations per push).
DEFAULT_TAG = ("tag", "tag_1")
VALUES_PER_SLICE = 1_000_000
TRACES_PER_SLICE = 1_000
CONSTELLATIONS_PER_SLICE = 200


def metric_columns(df: DataFrame, exclude=("date", "satellite"), *, ts: str = "ts") -> list[str]:
    """K6: value columns = every column except time and the named tag columns."""
    return [c for c in df.columns if c not in set(exclude) | {ts}]


def to_metric_rows(df: DataFrame, *, ts: str = "ts", tag_cols: list[str] | None = None,
                   metrics: list[str] | None = None, extension: str = "", prefix: bool = False,
                   mapping: dict | None = None, tags: dict | None = None) -> DataFrame:
    """K1-K6: wide frame -> long rows ready to write.

    * ``mapping`` renames columns first (K1)
    * no tag columns -> constant tag ``tag = 'tag_1'`` (K2)
    * NULL values are dropped (K3)
    * ``extension`` appended to (or, with ``prefix=True``, put before) the
      metric names (K4, Q9)
    * ``tags`` adds constant tag columns (K5)
    * ``metrics`` lists the value columns (K6); default: all non-tag columns
    """
    if mapping:
        df = df.withColumnsRenamed(mapping)
    if tags:
        df = df.withColumns({k: F.lit(str(v)) for k, v in tags.items()})
        tag_cols = list(tag_cols or []) + [k for k in tags if k not in (tag_cols or [])]
    if not tag_cols:
        df = df.withColumn(DEFAULT_TAG[0], F.lit(DEFAULT_TAG[1]))
        tag_cols = [DEFAULT_TAG[0]]
    metrics = metrics or [c for c in df.columns if c not in set(tag_cols) | {ts}]
    df = df.select(ts, *[F.col(t).cast("string").alias(t) for t in tag_cols],
                   *[F.col(m).cast("double").alias(m) for m in metrics])
    long = df.unpivot([ts, *tag_cols], metrics, "metric", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    if extension:
        name = F.concat(F.lit(extension), F.col("metric")) if prefix else F.concat(F.col("metric"), F.lit(extension))
        long = long.withColumn("metric", name)
    return long.select("metric", *tag_cols, ts, "value")


def write_metrics(long: DataFrame, path: str, *, ts: str = "ts", mode: str = "append",
                  max_records_per_file: int = VALUES_PER_SLICE, batch_id: str | None = None) -> None:
    """Append long rows to a parquet table partitioned by metric and day.

    Rows meet by (metric, day) first, so a day of a metric is a few files, not one per task; adaptive
    execution splits a day that is too large for one task and merges small ones (rebalance).

    With ``batch_id`` the rows go to that batch's own ``batch_id=`` folder and
    replace what an earlier try of the batch left there (ST7); one table takes
    either all its writes with a batch id or none."""
    if batch_id is not None:
        path, mode = f"{path.rstrip('/')}/batch_id={batch_id}", "overwrite"
    (long.withColumn("date", F.to_date(ts)).hint("rebalance", "metric", "date")
     .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("metric", "date").parquet(path))


def delete_metric(df: DataFrame, metric: str) -> DataFrame:
    """The table without one series name (rewrite, or drop its partition)."""
    return df.filter(F.col("metric") != F.lit(metric))


def high_water_marks(written: DataFrame, keys: list[str], *, pipeline: str, output: str,
                     ts: str = "ts") -> DataFrame:
    """K9: the mark after a write = ``max(ts)`` per series of the written rows
    (the reference stores the last row's time; max is the correct reading).
    Empty outputs produce no mark."""
    return (written.groupBy(*keys).agg(F.max(ts).alias("ts"))
            .select(F.lit(pipeline).alias("pipeline"), F.lit(output).alias("output"), *keys, "ts"))


def mark_ms(marks: DataFrame) -> DataFrame:
    """Marks as epoch milliseconds, the reference's checkpoint unit."""
    return marks.withColumn("mark_ms", F.floor(epoch_us("ts") / 1000).cast("bigint"))


def validate_schema(df: DataFrame, data_type: str, extension: str = "") -> tuple[DataFrame, str | list]:
    """K8: column checks and canonical names for value / trace / constellation frames.

    Eager and free: only the schema is inspected, no job runs.
    """
    cols = df.columns
    if data_type == "value":
        return df, [extension + c for c in cols]
    if data_type == "constellation":
        if len(cols) != 2:
            raise ValueError(f"constellation data needs 2 columns, got {len(cols)}")
        return df.toDF("constellation", "sweep_time_seconds"), extension + cols[0]
    if len(cols) != 7:
        raise ValueError(f"trace data needs 7 columns, got {len(cols)}")
    return (df.toDF("trace", "start_frequency", "stop_frequency", "res_bw", "video_bw", "min_val", "max_val"),
            extension + cols[0])
