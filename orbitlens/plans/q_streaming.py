"""Registered queries: streaming pipelines run once over the given tables
(``trigger(availableNow=True)``), read back as a batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlens.functions.output import round_doubles
from orbitlens.functions.time import HOUR, epoch_us
from orbitlens.operators.stats import STAT_NAMES
from orbitlens.plans import sqlparts as S
from orbitlens.plans.catalog import KEYS, register
from orbitlens.sources.telemetry import to_telemetry
from orbitlens.streaming import telemetry as ST


def events_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = ST.telemetry_stream(spark, sf_dir, schema=schema, glob="events.parquet")
    return to_telemetry(raw, metric="event_type", ts="ts", value="value",
                        tags={"satellite": F.concat(F.lit("SAT"), (F.col("user_id") % 3).cast("string"))})


def run_ticks(spark, sf_dir, base, tick, late_us: int = 0, ticks: int = 3):
    """All events arrive in ``ticks`` parts, oldest first and each row up to
    ``late_us`` late; after every arrival ``tick(stream of the folder)`` runs once."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    t = epoch_us("ts")
    lo, hi = events.agg(F.min(t), F.max(t)).first()
    if lo is None:
        lo = hi = 0
    arrives = t + F.pmod(F.xxhash64("event_id"), F.lit(late_us + 1))
    part = F.least(F.floor((arrives - lo) * ticks / (hi - lo + 1)), F.lit(ticks - 1))
    for i in range(ticks):
        events.where(part == i).write.mode("append").parquet(f"{base}/in")
        raw = ST.telemetry_stream(spark, f"{base}/in", schema=events.schema)
        tick(to_telemetry(raw, metric="event_type", ts="ts", value="value",
                          tags={"satellite": F.concat(F.lit("SAT"), (F.col("user_id") % 3).cast("string"))}))


STATS_SQL = f"""
WITH {S.TELE}, {S.stats_ctes()}
SELECT metric, satellite, bucket_end, "count", {S.rounded([c for c in STAT_NAMES if c != "count"])} FROM stats
WHERE "count" > 0 AND bucket_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
"""


@register("stream_tumbling_stats_ticks", sql=STATS_SQL)
def q_stream_tumbling_stats_ticks(spark, sf_dir):
    """ST2 + ST6: three ticks, rows up to an hour late, a watermark of two hours."""
    base = ST.scratch_path(spark, "stream-stats-ticks")
    run_ticks(spark, sf_dir, base, late_us=HOUR, tick=lambda t: ST.run_available_now(
        ST.tumbling_stats_stream(t, KEYS, "1 hour", watermark="2 hours"), f"{base}/out", f"{base}/ckpt"))
    return round_doubles(spark.read.parquet(f"{base}/out"))


@register("stream_tumbling_stats", sql=STATS_SQL)
def q_stream_tumbling_stats(spark, sf_dir):
    """ST1 + ST2: hourly statistics of the events stream, closed buckets only."""
    base = ST.scratch_path(spark, "stream-stats")
    st = ST.tumbling_stats_stream(events_stream(spark, sf_dir), KEYS, "1 hour", watermark="2 hours")
    ST.run_available_now(st, f"{base}/out", f"{base}/ckpt")
    return round_doubles(spark.read.parquet(f"{base}/out"))


def _raw_bands(df):
    from orbitlens.operators.detect import moving_average_anomaly
    ma = moving_average_anomaly(df, KEYS, ["value"], window="1D", min_periods=5)
    return ma.select(*KEYS, "ts", F.col("value_ma_lower_bound").alias("lb"),
                     F.col("value_ma_upper_bound").alias("ub"))


_ma_ctes, _ma_sel = S.ma_sql("tele", "ts", ["value"], 86_400_000_000, 5, 4.0, 0.01)


@register("stream_lookback_detector", sql=f"WITH {S.TELE}, {_ma_ctes} {_ma_sel}")
def q_stream_lookback_detector(spark, sf_dir):
    """ST3: moving-average detector run by foreachBatch with a history tail."""
    from orbitlens.operators.detect import history_needed_us, moving_average_anomaly
    base = ST.scratch_path(spark, "stream-lookback")
    fn = ST.lookback_detector(
        lambda d: moving_average_anomaly(d, KEYS, ["value"], window="1D", min_periods=5, carry=["_new"]),
        keys=KEYS, history_path=f"{base}/history", out_path=f"{base}/out", lookback_us=history_needed_us("1D"))
    q = (events_stream(spark, sf_dir).writeStream.foreachBatch(fn)
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return round_doubles(spark.read.parquet(f"{base}/out").drop("batch_id"))


@register("stream_bounds_join", sql=f"""
WITH {S.TELE}, {_ma_ctes},
b AS ({_ma_sel})
SELECT t.metric, t.satellite, t.ts,
  round(greatest(b.value_ma_lower_bound - t.value, t.value - b.value_ma_upper_bound) + 1e-09, 4) AS bounds_score
FROM tele t JOIN b ON t.metric = b.metric AND t.satellite = b.satellite AND t.ts = b.ts
""")
def q_stream_bounds_join(spark, sf_dir):
    """ST5: values stream joined with a bounds stream (bounds written by a
    batch job into the shared folder, then read as a stream)."""
    from orbitlens.sources.telemetry import events_telemetry
    base = ST.scratch_path(spark, "stream-bounds")
    bands = _raw_bands(events_telemetry(spark, sf_dir))
    bands.write.parquet(f"{base}/bounds")
    bstream = spark.readStream.schema(spark.read.parquet(f"{base}/bounds").schema).parquet(f"{base}/bounds")
    j = ST.bounds_join_stream(events_stream(spark, sf_dir), bstream, KEYS, watermark="2 hours")
    ST.run_available_now(j, f"{base}/out", f"{base}/ckpt", conf=ST.STATE_ON_DISK)
    return spark.read.parquet(f"{base}/out").withColumn("bounds_score", F.round(F.col("bounds_score") + 1e-9, 4))


@register("stream_stateful_detector", sql=f"WITH {S.TELE}, {_ma_ctes} {_ma_sel}")
def q_stream_stateful_detector(spark, sf_dir):
    """ST4: stateful streaming D1 (state = one window of points per series)."""
    from orbitlens.streaming.stateful import stateful_moving_average
    base = ST.scratch_path(spark, "stream-state")
    det = stateful_moving_average(events_stream(spark, sf_dir), KEYS, window="1D", min_periods=5,
                                  watermark="2 hours")
    ST.run_available_now(det, f"{base}/out", f"{base}/ckpt")
    return round_doubles(spark.read.parquet(f"{base}/out"))


@register("stream_stateful_detector_ticks", sql=f"WITH {S.TELE}, {_ma_ctes} {_ma_sel}")
def q_stream_stateful_detector_ticks(spark, sf_dir):
    """ST4 over three ticks: the state of a tick continues in the next."""
    from orbitlens.streaming.stateful import stateful_moving_average
    base = ST.scratch_path(spark, "stream-state-ticks")
    run_ticks(spark, sf_dir, base, tick=lambda t: ST.run_available_now(
        stateful_moving_average(t, KEYS, window="1D", min_periods=5, watermark="2 hours"), f"{base}/out", f"{base}/ckpt"))
    return round_doubles(spark.read.parquet(f"{base}/out"))


@register("stream_lookback_detector_ticks", sql=f"WITH {S.TELE}, {_ma_ctes} {_ma_sel}")
def q_stream_lookback_detector_ticks(spark, sf_dir):
    """ST3 + ST7 over three ticks, each with its own ``batch_id=`` folder."""
    from orbitlens.operators.detect import history_needed_us, moving_average_anomaly
    base = ST.scratch_path(spark, "stream-lookback-ticks")
    fn = ST.lookback_detector(
        lambda d: moving_average_anomaly(d, KEYS, ["value"], window="1D", min_periods=5, carry=["_new"]),
        keys=KEYS, history_path=f"{base}/history", out_path=f"{base}/out", lookback_us=history_needed_us("1D"))

    def tick(t):
        (t.writeStream.foreachBatch(fn).option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start().awaitTermination())

    run_ticks(spark, sf_dir, base, tick)
    return round_doubles(spark.read.parquet(f"{base}/out").drop("batch_id"))
