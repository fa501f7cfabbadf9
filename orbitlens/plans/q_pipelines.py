"""Registered queries: the user-level jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlens.functions.output import q_sql, round_doubles
from orbitlens.functions.time import DAY, HOUR, MIN
from orbitlens.operators.detect import moving_average_anomaly
from orbitlens.operators.stats import STAT_NAMES
from orbitlens.plans import pipelines as P
from orbitlens.plans import sqlparts as S
from orbitlens.plans.catalog import KEYS, register, tele
from orbitlens.plans.q_basic import MARKS_SQL, NOW, derived_marks
from orbitlens.plans.q_series import fill_sql
from orbitlens.sources.telemetry import sample_first

V = q_sql("value")
SINCE = f"""since AS (SELECT t.* FROM tele t LEFT JOIN marks m ON t.metric = m.metric AND t.satellite = m.satellite
  WHERE t.ts >= make_timestamp(coalesce(epoch_us(m.mark), (epoch_us(TIMESTAMP '{NOW}') - {DAY}) // {HOUR} * {HOUR}) - {{lb}}))"""
CLOSED = """closed AS (SELECT * FROM (SELECT *, max(bucket_end) OVER (PARTITION BY metric, satellite) AS last_b FROM stats)
           WHERE bucket_end < last_b)"""


@register("aggregation_pipeline", sql=f"""
WITH {S.TELE}, {MARKS_SQL}, {SINCE.format(lb=0)}, {S.stats_ctes(src='since')}, {CLOSED},
u AS (UNPIVOT (SELECT metric, satellite, bucket_end, mean, "count"::DOUBLE AS "count", median, std, skew,
                      "min", "max", energy, kurt, max_diff FROM closed)
      ON mean, "count", median, std, skew, "min", "max", energy, kurt, max_diff INTO NAME stat VALUE value)
SELECT metric || '_agg_' || stat || '_60T' AS metric, satellite, bucket_end AS ts, {V} AS value FROM u
""")
def q_aggregation_pipeline(spark, sf_dir):
    r = P.aggregation(tele(spark, sf_dir), derived_marks(spark, sf_dir), KEYS, NOW)
    return round_doubles(r)


@register("resample_pipeline", sql=f"""
WITH {S.TELE}, {MARKS_SQL}, {SINCE.format(lb=0)},
f AS (SELECT metric, satellite, (epoch_us(ts) // {10 * MIN}) * {10 * MIN} AS b, arg_min(value, ts) AS v
      FROM since WHERE value IS NOT NULL GROUP BY ALL),
bo AS (SELECT metric, satellite, min(b) AS lo, max(b) AS hi FROM f GROUP BY ALL),
g AS (SELECT metric, satellite, unnest(range(lo, hi + 1, {10 * MIN})) AS b FROM bo),
j AS (SELECT g.metric, g.satellite, g.b, f.v FROM g LEFT JOIN f ON f.metric = g.metric AND f.satellite = g.satellite AND f.b = g.b)
SELECT metric || '_resample_10T' AS metric, satellite, make_timestamp(b) AS ts, {q_sql(fill_sql('v', 'b'))} AS value FROM j
""")
def q_resample_pipeline(spark, sf_dir):
    r = P.resample_job(tele(spark, sf_dir), derived_marks(spark, sf_dir, "resample", "resample"), KEYS, NOW,
                       every="10T")
    return round_doubles(r)


_p5_ctes, _p5_sel = S.ma_sql("closed", "bucket_end", STAT_NAMES, 3 * DAY, 1, 4.0, 0.01)


@register("statistics_then_detect", sql=f"""
WITH {S.TELE}, {MARKS_SQL}, {SINCE.format(lb=6 * DAY)}, {S.stats_ctes(src='since')}, {CLOSED},
{_p5_ctes},
res AS ({_p5_sel})
SELECT r.* FROM res r LEFT JOIN marks m ON r.metric = m.metric AND r.satellite = m.satellite
WHERE m.mark IS NULL OR r.bucket_end > m.mark
""")
def q_statistics_then_detect(spark, sf_dir):
    r = P.statistics_then_detect(tele(spark, sf_dir), derived_marks(spark, sf_dir), KEYS, NOW)
    return round_doubles(r)


def _bounds_of_samples(spark, sf_dir):
    s = sample_first(tele(spark, sf_dir), KEYS, "10T")
    ma = moving_average_anomaly(s, KEYS, ["value"], window="1D", min_periods=5)
    return ma.select(*KEYS, "ts", F.col("value_ma_lower_bound").alias("lb"), F.col("value_ma_upper_bound").alias("ub"))


_p6_ctes, _ = S.ma_sql("smp", "ts", ["value"], DAY, 5, 4.0, 0.01)


@register("bounds_monitor", sql=f"""
WITH {S.TELE},
smp AS (SELECT metric, satellite, make_timestamp((epoch_us(ts) // {10 * MIN}) * {10 * MIN}) AS ts, arg_min(value, ts) AS value
        FROM tele WHERE value IS NOT NULL GROUP BY metric, satellite, (epoch_us(ts) // {10 * MIN})),
{_p6_ctes}
SELECT metric, satellite, ts,
  {q_sql('greatest((-4.0 * (rr0_std + 1e-8) - rr0_mean + m0_mean - 0.01) - value, value - (4.0 * (rr0_std + 1e-8) + rr0_mean + m0_mean + 0.01))')} AS bounds_score
FROM ma_r0
""")
def q_bounds_monitor(spark, sf_dir):
    r = P.bounds_monitor(tele(spark, sf_dir), _bounds_of_samples(spark, sf_dir), KEYS, every="10T")
    return round_doubles(r)


def _two_marks(spark, sf_dir):
    """Marks of the two outputs: five and four days before each series' last point; SAT0 has none."""
    a = derived_marks(spark, sf_dir, "bounds_monitor", "resample")
    b = derived_marks(spark, sf_dir, "bounds_monitor", "bounds").withColumn("ts", F.timestamp_add("DAY", F.lit(1), F.col("ts")))
    return a.unionByName(b)


@register("bounds_monitor_run", sql=f"""
WITH {S.TELE},
smp AS (SELECT metric, satellite, make_timestamp((epoch_us(ts) // {10 * MIN}) * {10 * MIN}) AS ts, arg_min(value, ts) AS value
        FROM tele WHERE value IS NOT NULL GROUP BY metric, satellite, (epoch_us(ts) // {10 * MIN})),
{_p6_ctes},
bd AS (SELECT metric, satellite, ts, -4.0 * (rr0_std + 1e-8) - rr0_mean + m0_mean - 0.01 AS lb, 4.0 * (rr0_std + 1e-8) + rr0_mean + m0_mean + 0.01 AS ub FROM ma_r0),
mk AS (SELECT metric, satellite, max(ts) - INTERVAL 5 DAY AS m1, max(ts) - INTERVAL 4 DAY AS m2 FROM tele WHERE satellite <> 'SAT0' GROUP BY ALL),
src AS (SELECT t.*, mk.m1, mk.m2 FROM tele t LEFT JOIN mk ON mk.metric = t.metric AND mk.satellite = t.satellite
        WHERE t.value IS NOT NULL AND t.ts >= coalesce(m1, make_timestamp((epoch_us(TIMESTAMP '{NOW}') - {DAY}) // {10 * MIN} * {10 * MIN}))),
sm AS (SELECT metric, satellite, make_timestamp((epoch_us(ts) // {10 * MIN}) * {10 * MIN}) AS ts, arg_min(value, ts) AS value, any_value(m1) AS m1, any_value(m2) AS m2
       FROM src GROUP BY metric, satellite, (epoch_us(ts) // {10 * MIN})),
sc AS (SELECT s.*, greatest(lb - value, value - ub) AS score FROM sm s JOIN bd ON bd.metric = s.metric AND bd.satellite = s.satellite AND bd.ts = s.ts)
SELECT metric || '_resample' AS metric, satellite, ts, {V} AS value FROM sm WHERE m1 IS NULL OR ts > m1
UNION ALL SELECT metric || '_bounds_score', satellite, ts, {q_sql('score')} FROM sc WHERE score IS NOT NULL AND (m2 IS NULL OR ts > m2)
""")
def q_bounds_monitor_run(spark, sf_dir):
    """P6 as a job: samples and scores after their own marks."""
    rows, _ = P.bounds_monitor_run(tele(spark, sf_dir), _bounds_of_samples(spark, sf_dir), _two_marks(spark, sf_dir), KEYS, NOW, every="10T")
    return round_doubles(rows)


@register("one_class_svm_job")
def q_one_class_svm_job(spark, sf_dir):
    """P4 as a job: read with lookback -> one-class detector -> rows after the mark."""
    return round_doubles(P.one_class_svm_job(tele(spark, sf_dir), derived_marks(spark, sf_dir, "one_class_svm", "ocsvm"), KEYS, NOW))


@register("retention", sql=f"""
WITH {S.TELE} SELECT metric, satellite, ts, {V} AS value FROM tele WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY
""")
def q_retention(spark, sf_dir):
    return round_doubles(P.retention(tele(spark, sf_dir), NOW, 7))


# ---------------------------------------------------------------- sinks end to end (K1, K10, K11), S15, S16
from orbitlens.sinks.telemetry import delete_metric, write_metrics  # noqa: E402
from orbitlens.sources.telemetry import read_bounds, read_exogenous  # noqa: E402
from orbitlens.streaming.telemetry import scratch_path  # noqa: E402

def _written_aggregation(spark, sf_dir):
    path = scratch_path(spark, "metrics-table")
    rows = P.aggregation(tele(spark, sf_dir), derived_marks(spark, sf_dir), KEYS, NOW)
    write_metrics(rows, path, max_records_per_file=1000)
    return spark.read.parquet(path).drop("date")


from orbitlens.plans.catalog import SQL as _SQL  # noqa: E402

_agg_sql = _SQL["aggregation_pipeline"]


@register("write_metrics_roundtrip", sql=_agg_sql)
def q_write_metrics_roundtrip(spark, sf_dir):
    """K1 + K11: P1 rows appended to a table partitioned by metric and day
    (1000 records per file), read back."""
    return round_doubles(_written_aggregation(spark, sf_dir).select("metric", "satellite", "ts", "value"))


@register("delete_metric", sql=f"SELECT * FROM ({_agg_sql}) WHERE metric <> 'click_agg_mean_60T'")
def q_delete_metric(spark, sf_dir):
    """The written table without one derived series."""
    t = _written_aggregation(spark, sf_dir).select("metric", "satellite", "ts", "value")
    return round_doubles(delete_metric(t, "click_agg_mean_60T"))


_b_ctes, _b_sel = S.ma_sql("closed0", "bucket_end", ["mean"], 3 * DAY, 1, 4.0, 0.01)


@register("read_bounds", sql=f"""
WITH {S.TELE}, {S.stats_ctes()},
closed0 AS (SELECT * FROM (SELECT *, max(bucket_end) OVER (PARTITION BY metric, satellite) AS last_b FROM stats)
            WHERE bucket_end < last_b),
{_b_ctes},
b AS ({_b_sel})
SELECT metric, satellite, bucket_end AS ts, mean_ma_lower_bound AS lb, mean_ma_upper_bound AS ub FROM b
WHERE mean_ma_lower_bound IS NOT NULL
""")
def q_read_bounds(spark, sf_dir):
    """Bound series written as ordinary metrics (``<metric>_lb``/``_ub``)
    and read back as two columns."""
    from orbitlens.plans.catalog import ma_on_hourly_mean
    ma = ma_on_hourly_mean(spark, sf_dir)
    wide = ma.select("metric", "satellite", F.col("bucket_end").alias("ts"),
                     F.col("mean_ma_lower_bound").alias("lb"), F.col("mean_ma_upper_bound").alias("ub"))
    # written as ordinary series named <metric>_lb / <metric>_ub
    rows = (wide.select("metric", "satellite", "ts", "lb", "ub")
            .unpivot(["metric", "satellite", "ts"], ["lb", "ub"], "_k", "value")
            .filter(F.col("value").isNotNull())
            .select(F.concat("metric", F.lit("_"), "_k").alias("metric"), "satellite", "ts", "value"))
    path = scratch_path(spark, "bounds-table")
    write_metrics(rows, path)
    back = spark.read.parquet(path).drop("date")
    bases = [f"{m}" for m in ["click", "error", "purchase", "signup", "view"]]
    return round_doubles(read_bounds(back, bases, keys=KEYS).filter(F.col("lb").isNotNull()))


@register("read_exogenous", sql=f"""
WITH {S.TELE}
SELECT 'click' AS target, metric, satellite, ts, {V} AS value FROM tele
WHERE metric IN ('view', 'purchase') AND ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00'
""")
def q_read_exogenous(spark, sf_dir):
    """Exogenous series of a series group over the target's window."""
    t = tele(spark, sf_dir)
    groups = spark.createDataFrame([("click", ["view", "purchase"])], "target string, exogenous array<string>")
    windows = t.select("satellite").distinct().select(
        F.lit("click").alias("target"), "satellite",
        F.lit("2024-01-10 00:00:00").cast("timestamp_ntz").alias("start"),
        F.lit("2024-01-12 00:00:00").cast("timestamp_ntz").alias("end"))
    return round_doubles(read_exogenous(t, groups, windows, keys=KEYS))
