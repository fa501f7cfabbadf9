"""Structured Streaming versions of the incremental pipelines (ST1-ST7).

The reference's "real time" is a cron tick plus a stored mark; here:

* ST1 ``telemetry_stream``: ``readStream`` over a folder of files;
  ``trigger(availableNow=True)`` is one cron tick, the checkpoint folder is
  the mark.
* ST2 ``tumbling_stats_stream``: watermark + ``window()`` in append mode:
  a bucket is emitted once, when the watermark has passed its end (the
  batch pipeline's "drop the open bucket").  Exact median and max_diff are
  computed inside the streaming aggregate (the bucket's values are its state).
* ST3 ``lookback_detector``: ``foreachBatch``: history tail + new rows ->
  the batch detector -> only new rows appended -> marks updated.
* ST5 ``bounds_join_stream``: watermarked stream-stream inner join of values
  and bounds on (series, ts) -> bounds score; run it with ``STATE_ON_DISK``.
* ST6 late data: the watermark delay; rows behind it are dropped by the
  windowed aggregate (counted in the query progress as dropped rows).
* ST7 ``idempotent_batch_writer``: each micro-batch writes its own
  ``batch_id=`` partition with overwrite, so a replayed batch replaces its
  output instead of duplicating it; ``dedup_latest`` for readers.

Watermarks need a TIMESTAMP column: the canonical TIMESTAMP_NTZ time is
mapped to an instant with ``timestamp_micros(epoch_us(ts))`` (no time zone
involved) and back.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orbitlens.functions.time import epoch_us, from_epoch_us
from orbitlens.operators.stats import corrected_kurt, corrected_skew
from orbitlens.operators.windows import join_null_safe

EVENT_TIME = "event_time"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    from orbitlens.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/orbitlens-{name}-{uuid.uuid4().hex[:12]}"


def with_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(EVENT_TIME, F.timestamp_micros(epoch_us(ts)))


def telemetry_stream(spark: SparkSession, path: str, *, schema, glob: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """ST1: file stream of any telemetry-shaped table (schema given: no inference)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def tumbling_stats_stream(stream: DataFrame, keys: list[str], every: str = "1 hour", *,
                          watermark: str = "2 hours", ts: str = "ts", value: str = "value") -> DataFrame:
    """ST2: closed-bucket statistics of a stream (same columns as ``bucket_stats``)."""
    x = with_event_time(stream, ts).withWatermark(EVENT_TIME, watermark)
    v = F.col(value)
    g = x.groupBy(*keys, F.window(EVENT_TIME, every).alias("_w")).agg(
        F.avg(v).alias("mean"), F.count(v).alias("count"), F.median(v).alias("median"),
        F.stddev_samp(v).alias("std"), F.skewness(v).alias("_g1"), F.min(v).alias("min"),
        F.max(v).alias("max"), (F.coalesce(F.sum(v * v), F.lit(0.0)) / F.count(F.lit(1))).alias("energy"),
        F.kurtosis(v).alias("_g2"),
        F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), v.alias("v")))).alias("_pts"))
    pts = F.col("_pts")
    steps = F.transform(F.sequence(F.lit(1), F.size(pts) - 1),
                        lambda i: F.abs(F.element_at(pts, i + 1)["v"] - F.element_at(pts, i)["v"]))
    max_diff = F.when(F.size(pts) >= 2, F.array_max(steps))
    n = F.col("count").cast("double")
    return g.select(*keys, from_epoch_us(F.unix_micros(F.col("_w.end"))).alias("bucket_end"),
                    "mean", "count", "median", "std", corrected_skew(n, F.col("_g1")).alias("skew"),
                    "min", "max", "energy", corrected_kurt(n, F.col("_g2")).alias("kurt"),
                    max_diff.alias("max_diff"))


#: settings of a query with one state row per input row (a join keeps both sides until the watermark has passed them):
#: the state lies on disk with a bounded cache, not in the executors' heap, and a write does not read what it replaces
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",      # one store for both sides
}


@contextlib.contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available_now(df: DataFrame, out_path: str, checkpoint: str, *, mode: str = "append",
                      fmt: str = "parquet", conf: dict[str, str] | None = None) -> None:
    """Run a streaming plan once over everything available (one 'tick'); ``conf`` holds for this query only (a
    checkpoint that exists keeps the state store it began with)."""
    with _settings(df.sparkSession, conf or {}):               # a query takes its settings when it starts
        q = (df.writeStream.format(fmt).option("path", out_path).option("checkpointLocation", checkpoint)
             .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()


def dedup_latest(df: DataFrame, keys: list[str], *, ts: str = "ts", version: str = "batch_id") -> DataFrame:
    """ST7 read side: one row per (series, ts), the one written last."""
    return df.groupBy(*keys, ts).agg(*[F.max_by(c, version).alias(c) for c in df.columns
                                       if c not in (*keys, ts, version)])


def idempotent_batch_writer(out_path: str):
    """ST7: a ``foreachBatch`` function writing each micro-batch to its own
    ``batch_id=<id>`` partition with overwrite (replays replace, not duplicate)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}"))
    return write


def lookback_detector(detect_fn, *, keys: list[str], history_path: str, out_path: str,
                      lookback_us: int, ts: str = "ts"):
    """ST3: ``foreachBatch`` body for detectors that need history.

    For every micro-batch: read the stored history tail of the batch's
    series (rows newer than ``min(batch ts) - lookback``), run the batch
    detector ``detect_fn(history ∪ batch)``, keep the rows of this batch
    only, write them to the batch's own partition, then store the batch in
    the history table, also under its own ``batch_id=`` partition: a replayed
    batch overwrites both instead of duplicating rows.  The history table is
    trimmed by the retention job (P11).

    The detector's input has a flag ``_new``; a detector that passes it on
    (``carry=["_new"]``) gets one result per row of the batch.  Without it a
    row belongs to the batch if the batch has its series and time.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        b = batch.select(*keys, ts, "value").withColumn("_new", F.lit(True))
        # one scalar (the batch's earliest time) - the history read is pruned by it
        lo_us = b.agg(F.min(epoch_us(ts))).first()[0]
        lo = from_epoch_us(F.lit(lo_us - lookback_us))
        try:
            hist = spark.read.parquet(history_path).filter(F.col("batch_id") != batch_id)
            # the day partition prunes whole folders, the ts filter the rest
            hist = hist.filter((F.col("date") >= F.to_date(lo)) & (F.col(ts) >= lo))
            hist = (join_null_safe(hist, b.select(*keys).distinct(), keys, "inner")
                    .select(*keys, ts, "value").withColumn("_new", F.lit(False)))
            allrows = hist.unionByName(b)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise                      # only a first batch has no history table
            allrows = b
        det = detect_fn(allrows)
        if "_new" in det.columns:
            res = det.filter("_new").drop("_new")
        else:
            res = join_null_safe(det, b.select(*keys, ts).distinct(), [*keys, ts], "inner")
        res.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
        (batch.select(*keys, ts, "value").withColumn("date", F.to_date(ts))
         .write.mode("overwrite").partitionBy("date")
         .parquet(f"{history_path.rstrip('/')}/batch_id={batch_id}"))
    return run


def bounds_join_stream(values: DataFrame, bounds: DataFrame, keys: list[str], *, ts: str = "ts",
                       value: str = "value", lb: str = "lb", ub: str = "ub",
                       watermark: str = "10 minutes") -> DataFrame:
    """ST5: watermarked stream-stream inner join on (series, ts) -> score."""
    v = with_event_time(values.select(*keys, ts, value), ts).withWatermark(EVENT_TIME, watermark)
    b = bounds.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col(ts).alias("_b_ts"), lb, ub)
    b = b.withColumn("_b_et", F.timestamp_micros(epoch_us("_b_ts"))).withWatermark("_b_et", watermark)
    cond = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys] + [F.col(EVENT_TIME) == F.col("_b_et")]
    j = v.join(b, on=cond, how="inner")
    return j.select(*keys, ts, F.greatest(F.col(lb) - F.col(value), F.col(value) - F.col(ub)).alias("bounds_score"))


__all__ = ["telemetry_stream", "tumbling_stats_stream", "run_available_now", "STATE_ON_DISK", "dedup_latest",
           "idempotent_batch_writer", "lookback_detector", "bounds_join_stream", "scratch_path", "Window"]
