"""Registered queries: resampling, windows, detectors, spectrum (T, W, D, X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlens.functions import spectrum as X
from orbitlens.functions.output import q_sql, round_doubles
from orbitlens.functions.time import DAY, HOUR, MIN, from_epoch_us
from orbitlens.operators.detect import bounds_anomaly, moving_average_anomaly
from orbitlens.operators.report import daily_bounds_report
from orbitlens.operators.resample import (
    fill_gaps, infer_frequency, merge_extracts, resample_first, time_grid,
)
from orbitlens.operators.stats import STAT_NAMES, drop_open_bucket
from orbitlens.operators.windows import (
    diff, lag_features, lagged_rolling_mean, rolling_stats, rolling_zscore, smoothed_diff,
)
from orbitlens.plans import sqlparts as S
from orbitlens.plans.catalog import KEYS, hourly_stats, ma_on_hourly_mean, register, tele

V = q_sql("value")
PK = "PARTITION BY metric, satellite"


def fill_sql(col: str, order: str, first: str = "b") -> str:
    nxt = f"first_value({col} IGNORE NULLS) OVER ({PK} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    prv = f"last_value({col} IGNORE NULLS) OVER ({PK} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"coalesce({nxt}, {prv})" if first == "b" else f"coalesce({prv}, {nxt})"


# ------------------------------------------------------------------ T1 (+T2, T3)
RESAMPLE_SQL = f"""
f AS (SELECT metric, satellite, (epoch_us(ts) // {10 * MIN}) * {10 * MIN} AS b, arg_min(value, ts) AS v
      FROM tele WHERE value IS NOT NULL GROUP BY ALL),
bo AS (SELECT metric, satellite, min(b) AS lo, max(b) AS hi FROM f GROUP BY ALL),
g AS (SELECT metric, satellite, unnest(range(lo, hi + 1, {10 * MIN})) AS b FROM bo),
j AS (SELECT g.metric, g.satellite, g.b, f.v FROM g LEFT JOIN f ON f.metric = g.metric AND f.satellite = g.satellite AND f.b = g.b),
rs AS (SELECT metric, satellite, make_timestamp(b) AS ts, {fill_sql('v', 'b')} AS value FROM j)"""


@register("resample_first_10min", sql=f"WITH {S.TELE}, {RESAMPLE_SQL} SELECT metric, satellite, ts, {V} AS value FROM rs")
def q_resample_first(spark, sf_dir):
    return round_doubles(resample_first(tele(spark, sf_dir), KEYS, "10T"))


@register("resample_first_10s", sql=f"WITH {S.TELE}, {RESAMPLE_SQL.replace(str(10 * MIN), str(10 * 1_000_000))} "
         f"SELECT metric, satellite, ts, {V} AS value FROM rs")
def q_resample_first_10s(spark, sf_dir):
    return round_doubles(resample_first(tele(spark, sf_dir), KEYS, "10s"))


LINEITEM_TELE = ("li AS (SELECT 'quantity' AS metric, l_returnflag AS satellite, l_shipdate AS ts, "
                 "l_quantity AS value FROM lineitem)")


@register("lineitem_daily_stats", sql=f"""
WITH {LINEITEM_TELE}, {S.stats_ctes(DAY, src='li')}
SELECT metric, satellite, bucket_end, {S.rounded(STAT_NAMES, exclude=("count",))} FROM stats
""")
def q_lineitem_daily_stats(spark, sf_dir):
    """Statistics on the largest table: daily buckets, many equal timestamps."""
    from orbitlens.operators.stats import bucket_stats
    from orbitlens.sources.telemetry import to_telemetry
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    t = to_telemetry(li, metric=F.lit("quantity"), ts="l_shipdate", value="l_quantity",
                     tags={"satellite": "l_returnflag"})
    return round_doubles(bucket_stats(t, KEYS, "1D"))


@register("time_grid_hourly", sql=f"""
WITH {S.TELE},
bo AS (SELECT metric, satellite, min(epoch_us(ts) // {HOUR}) * {HOUR} AS lo, max(epoch_us(ts) // {HOUR}) * {HOUR} AS hi
       FROM tele GROUP BY ALL)
SELECT metric, satellite, make_timestamp(unnest(range(lo, hi + 1, {HOUR}))) AS ts FROM bo
""")
def q_time_grid(spark, sf_dir):
    return time_grid(tele(spark, sf_dir), KEYS, "1H", block_buckets=64)


def _fill_src(spark, sf_dir):
    return hourly_stats(spark, sf_dir).select(*KEYS, "bucket_end", "mean", "max_diff")


FILL_SRC = f"{S.stats_ctes()}, fs AS (SELECT metric, satellite, bucket_end, mean, max_diff FROM stats)"


@register("fill_gaps_tiled", sql=f"""
WITH {S.TELE}, {FILL_SRC}
SELECT metric, satellite, bucket_end, {q_sql(fill_sql('mean', 'bucket_end'))} AS mean,
       {q_sql(fill_sql('max_diff', 'bucket_end'))} AS max_diff FROM fs
""")
def q_fill_gaps_tiled(spark, sf_dir):
    return round_doubles(fill_gaps(_fill_src(spark, sf_dir), KEYS, ["mean", "max_diff"], ts="bucket_end",
                                   block_us=DAY))


@register("fill_gaps_ffill_first", sql=f"""
WITH {S.TELE}, {FILL_SRC}
SELECT metric, satellite, bucket_end, {q_sql(fill_sql('mean', 'bucket_end', 'f'))} AS mean,
       {q_sql(fill_sql('max_diff', 'bucket_end', 'f'))} AS max_diff FROM fs
""")
def q_fill_gaps_ffill(spark, sf_dir):
    return round_doubles(fill_gaps(_fill_src(spark, sf_dir), KEYS, ["mean", "max_diff"], ts="bucket_end",
                                   order="ffill_bfill"))


# ------------------------------------------------------------------ T4
@register("infer_frequency", sql=f"""
WITH {S.TELE},
g AS (SELECT metric, satellite, epoch_us(ts) - lag(epoch_us(ts)) OVER ({PK} ORDER BY ts) AS gap FROM tele),
m AS (SELECT metric, satellite, greatest(1, floor(median(gap) / 1000000))::BIGINT AS f FROM g WHERE gap IS NOT NULL GROUP BY ALL)
SELECT metric, satellite, CASE WHEN 600 < f THEN f ELSE 600 END AS freq_s FROM m
""")
def q_infer_frequency(spark, sf_dir):
    return infer_frequency(tele(spark, sf_dir), KEYS, requested=600)


# ------------------------------------------------------------------ T5
@register("merge_extracts", sql=f"""
WITH {S.TELE},
a AS (SELECT metric, satellite, ts, value FROM tele WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
b AS (SELECT metric, satellite, ts, CASE WHEN day(ts) % 2 = 0 THEN value * 2 END AS value FROM tele
      WHERE ts >= TIMESTAMP '2024-01-10 00:00:00')
SELECT coalesce(a.metric, b.metric) AS metric, coalesce(a.satellite, b.satellite) AS satellite,
       coalesce(a.ts, b.ts) AS ts, {q_sql('coalesce(b.value, a.value)')} AS value
FROM a FULL OUTER JOIN b ON a.metric = b.metric AND a.satellite = b.satellite AND a.ts = b.ts
""")
def q_merge_extracts(spark, sf_dir):
    t = tele(spark, sf_dir)
    a = t.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    b = t.filter(F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")) \
         .withColumn("value", F.when(F.dayofmonth("ts") % 2 == 0, F.col("value") * 2))
    return round_doubles(merge_extracts([a, b], KEYS))


# ------------------------------------------------------------------ W1 (default and tiled)
def _rolling_sql(window_us, mp):
    w = f"({PK} ORDER BY epoch_us(ts) RANGE BETWEEN {window_us - 1} PRECEDING AND CURRENT ROW)"
    return f"""
WITH {S.TELE}
SELECT metric, satellite, ts, {V} AS value,
  {q_sql(f'CASE WHEN count(value) OVER {w} >= {mp} THEN avg(value) OVER {w} END')} AS value_mean,
  {q_sql(f'CASE WHEN count(value) OVER {w} >= {mp} THEN stddev_samp(value) OVER {w} END')} AS value_std
FROM tele"""


def _rolling(spark, sf_dir, tile):
    r = rolling_stats(tele(spark, sf_dir), KEYS, "value", "1D", min_periods=3, tile_us=tile)
    return round_doubles(r.drop("_t"))


@register("rolling_mean_std", sql=_rolling_sql(DAY, 3))
def q_rolling(spark, sf_dir):
    return _rolling(spark, sf_dir, None)


@register("rolling_mean_std_tiled", sql=_rolling_sql(DAY, 3))
def q_rolling_tiled(spark, sf_dir):
    return _rolling(spark, sf_dir, 2 * DAY)


# ------------------------------------------------------------------ W3
def _zscore_sql():
    c = S.shifted_rolling_cte("z", "zt", "value", 3 * DAY, 5, ("mean", "std"), prefix="z")
    return f"""
WITH {S.TELE}, zt AS (SELECT *, epoch_us(ts) AS t FROM tele), {c},
zz AS (SELECT metric, satellite, ts, ((value - z_mean) / (z_std + 1e-8)) / 3.0 AS zscore FROM z)
SELECT metric, satellite, ts, {q_sql('zscore')} AS zscore FROM zz WHERE zscore IS NOT NULL"""


@register("rolling_zscore", sql=_zscore_sql())
def q_rolling_zscore(spark, sf_dir):
    z = rolling_zscore(tele(spark, sf_dir), KEYS, "value", "3D", sigma=3, min_periods=5, out="zscore")
    return round_doubles(z.select(*KEYS, "ts", "zscore"))


@register("rolling_zscore_tiled", sql=_zscore_sql())
def q_rolling_zscore_tiled(spark, sf_dir):
    z = rolling_zscore(tele(spark, sf_dir), KEYS, "value", "3D", sigma=3, min_periods=5, out="zscore",
                       tile_us=4 * DAY)
    return round_doubles(z.select(*KEYS, "ts", "zscore"))


@register("rolling_zscore_sums", sql=_zscore_sql())
def q_rolling_zscore_sums(spark, sf_dir):
    z = rolling_zscore(tele(spark, sf_dir), KEYS, "value", "3D", sigma=3, min_periods=5, out="zscore",
                       tile_us=4 * DAY, method="sums")
    return round_doubles(z.select(*KEYS, "ts", "zscore"))


# ------------------------------------------------------------------ D1 on raw points, tiled
_raw_ctes, _raw_sel = S.ma_sql("tele", "ts", ["value"], DAY, 5, 4.0, 0.01)


@register("ma_anomaly_raw_tiled", sql=f"WITH {S.TELE}, {_raw_ctes} {_raw_sel}")
def q_ma_raw_tiled(spark, sf_dir):
    r = moving_average_anomaly(tele(spark, sf_dir), KEYS, ["value"], window="1D", min_periods=5,
                               sigma=4.0, delta=0.01, tile_us=2 * DAY)
    return round_doubles(r)


@register("ma_anomaly_raw_sums", sql=f"WITH {S.TELE}, {_raw_ctes} {_raw_sel}")
def q_ma_raw_sums(spark, sf_dir):
    r = moving_average_anomaly(tele(spark, sf_dir), KEYS, ["value"], window="1D", min_periods=5,
                               sigma=4.0, delta=0.01, tile_us=2 * DAY, method="sums")
    return round_doubles(r)


# ------------------------------------------------------------------ W4, W5, W7
@register("lag_features", sql=f"""
WITH {S.TELE}, {S.stats_ctes()}
SELECT metric, satellite, bucket_end, {q_sql('mean')} AS mean,
  {q_sql(f'lag(mean, 1) OVER ({PK} ORDER BY bucket_end)')} AS lag1,
  {q_sql(f'lag(mean, 2) OVER ({PK} ORDER BY bucket_end)')} AS lag2,
  {q_sql(f'lag(mean, 24) OVER ({PK} ORDER BY bucket_end)')} AS lag24
FROM stats
""")
def q_lag_features(spark, sf_dir):
    st = hourly_stats(spark, sf_dir).select(*KEYS, "bucket_end", "mean")
    return round_doubles(lag_features(st, KEYS, "mean", [1, 2, 24], ts="bucket_end"))


@register("lagged_rolling_mean", sql=f"""
WITH {S.TELE}, {S.stats_ctes()}
SELECT metric, satellite, bucket_end, {q_sql('mean')} AS mean,
  {q_sql(f'avg(mean) OVER ({PK} ORDER BY bucket_end ROWS BETWEEN 29 PRECEDING AND 24 PRECEDING)')} AS rm
FROM stats
""")
def q_lagged_rolling_mean(spark, sf_dir):
    st = hourly_stats(spark, sf_dir).select(*KEYS, "bucket_end", "mean")
    return round_doubles(lagged_rolling_mean(st, KEYS, "mean", 24, 6, ts="bucket_end", out="rm"))


_DIFF_SQL = f"""
WITH {S.TELE}
SELECT metric, satellite, ts, {q_sql(f'value - lag(value) OVER ({PK} ORDER BY ts)')} AS value_diff FROM tele
"""


@register("diff_tiled", sql=_DIFF_SQL)
def q_diff_tiled(spark, sf_dir):
    return round_doubles(diff(tele(spark, sf_dir), KEYS, "value", block_us=DAY).select(*KEYS, "ts", "value_diff"))


@register("infer_frequency_tiled", sql=f"""
WITH {S.TELE},
g AS (SELECT metric, satellite, epoch_us(ts) - lag(epoch_us(ts)) OVER ({PK} ORDER BY ts) AS gap FROM tele)
SELECT metric, satellite, greatest(1, floor(median(gap) / 1000000))::BIGINT AS freq_s FROM g
WHERE gap IS NOT NULL GROUP BY ALL
""")
def q_infer_frequency_tiled(spark, sf_dir):
    return infer_frequency(tele(spark, sf_dir), KEYS, block_us=2 * DAY)


@register("diff", sql=f"""
WITH {S.TELE}
SELECT metric, satellite, ts, {q_sql(f'value - lag(value) OVER ({PK} ORDER BY ts)')} AS value_diff FROM tele
""")
def q_diff(spark, sf_dir):
    return round_doubles(diff(tele(spark, sf_dir), KEYS, "value").select(*KEYS, "ts", "value_diff"))


# ------------------------------------------------------------------ W6
@register("smoothed_diff", sql=f"""
WITH {S.TELE},
h AS (SELECT metric, satellite, (epoch_us(ts) // {HOUR}) * {HOUR} AS b, arg_min(value, ts) AS v
      FROM tele WHERE value IS NOT NULL GROUP BY ALL),
bo AS (SELECT metric, satellite, min(b) AS lo, max(b) AS hi FROM h GROUP BY ALL),
g AS (SELECT metric, satellite, unnest(range(lo, hi + 1, {HOUR})) AS b FROM bo),
j AS (SELECT g.metric, g.satellite, g.b, h.v FROM g LEFT JOIN h ON h.metric = g.metric AND h.satellite = g.satellite AND h.b = g.b),
y AS (SELECT metric, satellite, b, {fill_sql('v', 'b')} AS y FROM j),
r AS (SELECT *, row_number() OVER ({PK} ORDER BY b) AS i, sum(y) OVER ({PK} ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s,
             greatest(floor(count(*) OVER ({PK}) * 0.02), 1)::BIGINT AS k FROM y),
m AS (SELECT a.*, CASE WHEN a.i = a.k THEN a.s / a.k WHEN a.i > a.k THEN (a.s - p.s) / a.k END AS mk
      FROM r a LEFT JOIN r p ON p.metric = a.metric AND p.satellite = a.satellite AND p.i = a.i - a.k),
d AS (SELECT *, mk - lag(mk) OVER ({PK} ORDER BY b) AS dd FROM m)
SELECT metric, satellite, make_timestamp(b) AS ts, {q_sql('y')} AS value,
  {q_sql(f'first_value(dd IGNORE NULLS) OVER ({PK} ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)')} AS y_lags
FROM d
""")
def q_smoothed_diff(spark, sf_dir):
    y = resample_first(tele(spark, sf_dir), KEYS, "1H")
    return round_doubles(smoothed_diff(y, KEYS, "value", out="y_lags"))


# ------------------------------------------------------------------ D5, D6
_flag_ctes, _flag_sel = S.ma_sql("closed", "bucket_end", ["mean"], 3 * DAY, 1, 4.0, 0.01)
CLOSED = """closed AS (SELECT * FROM (SELECT *, max(bucket_end) OVER (PARTITION BY metric, satellite) AS last_b FROM stats)
           WHERE bucket_end < last_b)"""
BANDS_SQL = f"""{S.TELE}, {S.stats_ctes()}, {CLOSED}, {_flag_ctes},
bands AS (SELECT metric, satellite, bucket_end, mean AS y,
   4.0 * (rr0_std + 1e-8) + rr0_mean + m0_mean + 0.01 AS ub,
   -4.0 * (rr0_std + 1e-8) - rr0_mean + m0_mean - 0.01 AS lb,
   ((4.0 * (rr0_std + 1e-8) + rr0_mean + m0_mean + 0.01) + (-4.0 * (rr0_std + 1e-8) - rr0_mean + m0_mean - 0.01)) / 2 AS yhat
   FROM ma_r0)"""


def _bands(spark, sf_dir):
    st = drop_open_bucket(hourly_stats(spark, sf_dir), KEYS)
    ma = ma_on_hourly_mean(spark, sf_dir)
    b = ma.select(*KEYS, "bucket_end", F.col("mean_ma_upper_bound").alias("ub"),
                  F.col("mean_ma_lower_bound").alias("lb"),
                  ((F.col("mean_ma_upper_bound") + F.col("mean_ma_lower_bound")) / 2).alias("yhat"))
    return st.select(*KEYS, "bucket_end", F.col("mean").alias("y")), b


@register("bounds_anomaly", sql=f"""
WITH {BANDS_SQL}
SELECT metric, satellite, bucket_end, {q_sql('greatest(lb - y, y - ub)')} AS bounds_score FROM bands
""")
def q_bounds_anomaly(spark, sf_dir):
    vals, b = _bands(spark, sf_dir)
    return round_doubles(bounds_anomaly(vals, b, KEYS, ts="bucket_end", value="y", lb="lb", ub="ub"))


REPORT_NOW = "2024-01-29 00:00:00"


@register("daily_bounds_report", sql=f"""
WITH {BANDS_SQL},
w AS (SELECT * FROM bands WHERE bucket_end >= TIMESTAMP '{REPORT_NOW}' - INTERVAL 1 DAY AND bucket_end <= TIMESTAMP '{REPORT_NOW}'),
b AS (SELECT metric, satellite, (epoch_us(bucket_end) // 10000000) * 10000000 AS b, {", ".join(f"arg_min({c}, bucket_end) FILTER ({c} IS NOT NULL) AS {c}" for c in ("y", "yhat", "lb", "ub"))}
      FROM w GROUP BY metric, satellite, b),
g AS (SELECT metric, satellite, unnest(range(lo, hi + 1, 10000000)) AS b FROM (SELECT metric, satellite, min(b) AS lo, max(b) AS hi FROM b GROUP BY ALL)),
j AS (SELECT g.metric, g.satellite, g.b, y, yhat, lb, ub FROM g LEFT JOIN b ON b.metric = g.metric AND b.satellite = g.satellite AND b.b = g.b),
f AS (SELECT metric, satellite, b, {fill_sql('y', 'b')} AS y, {fill_sql('yhat', 'b')} AS yhat, {fill_sql('lb', 'b')} AS lb, {fill_sql('ub', 'b')} AS ub FROM j)
SELECT metric, satellite, count(CASE WHEN y < lb OR y > ub THEN y END) AS anomaly_count,
  {q_sql('avg(abs(y - yhat) / ((abs(y) + abs(yhat)) / 2)) * 100')} AS smape,
  {q_sql('sqrt(avg(pow(y - yhat, 2)))')} AS rmse
FROM f GROUP BY ALL
""")
def q_daily_bounds_report(spark, sf_dir):
    vals, b = _bands(spark, sf_dir)
    j = vals.join(b, on=[*KEYS, "bucket_end"], how="inner")
    return round_doubles(daily_bounds_report(j, KEYS, REPORT_NOW, ts="bucket_end"))


# ------------------------------------------------------------------ X1-X5
def spectrum_table(spark, sf_dir):
    """Spectrum records derived from ``embeddings``: one trace per vector."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    start = F.lit(1.0e9) + F.col("label").cast("double") * 1.0e7
    return e.select("vec_id", from_epoch_us(F.lit(1_704_067_200_000_000) + F.col("vec_id") * MIN).alias("ts"),
                    F.transform("embedding", lambda v: v.cast("double")).alias("powers"),
                    start.alias("start_frequency"), (start + 5.0e6).alias("stop_frequency"),
                    F.lit(1.0e4).alias("res_bw"), F.lit(1.0e3).alias("video_bw"))


SPEC_SQL = """sp AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS p,
                 1.0e9 + label::DOUBLE * 1.0e7 AS f0, 1.0e9 + label::DOUBLE * 1.0e7 + 5.0e6 AS f1 FROM embeddings),
mm AS (SELECT *, list_min(p) * 100 AS mn, list_max(p) * 100 AS mx FROM sp),
enc AS (SELECT *, array_to_string(list_transform(p, lambda x: lpad(upper(hex(CASE WHEN mx - mn = 0 THEN 0
          ELSE round_even((x * 100 - mn) * 255 / (mx - mn), 0)::INTEGER END)), 2, '0')), '') AS trace FROM mm)"""


def _encoded(spark, sf_dir):
    sp = spectrum_table(spark, sf_dir)
    mn, mx = X.trace_min_max("powers")
    return sp.select("*", mn.alias("min_val"), mx.alias("max_val"), X.encode_trace("powers").alias("trace"))


@register("encode_trace", sql=f"WITH {SPEC_SQL} SELECT vec_id, trace, {q_sql('mn')} AS min_val, {q_sql('mx')} AS max_val FROM enc")
def q_encode_trace(spark, sf_dir):
    return round_doubles(_encoded(spark, sf_dir).select("vec_id", "trace", "min_val", "max_val"))


@register("decode_trace", sql=f"""
WITH {SPEC_SQL},
b AS (SELECT vec_id, mn, mx, trace, unnest(range(0, length(trace) // 2)) AS bin FROM enc)
SELECT vec_id, bin::INTEGER AS bin,
  {q_sql("(mn + ('0x' || substr(trace, bin * 2 + 1, 2))::INTEGER::DOUBLE * (mx - mn) / 255) / 100")} AS power
FROM b
""")
def q_decode_trace(spark, sf_dir):
    d = _encoded(spark, sf_dir).select("vec_id", X.decode_trace("trace", "min_val", "max_val").alias("dec"))
    return round_doubles(d.select("vec_id", F.posexplode("dec").alias("bin", "power")))


@register("explode_spectrum", sql=f"""
WITH {SPEC_SQL},
b AS (SELECT vec_id, f0, f1, len(p) AS n, unnest(range(0, len(p))) AS bin, unnest(p) AS amplitude FROM sp)
SELECT vec_id, bin::INTEGER AS bin,
  {q_sql('(CASE WHEN n = 1 THEN f0 WHEN bin = n - 1 THEN f1 ELSE f0 + bin * ((f1 - f0) / (n - 1)) END) / 1e6')} AS frequency_mhz,
  {q_sql('amplitude')} AS amplitude
FROM b
""")
def q_explode_spectrum(spark, sf_dir):
    return round_doubles(X.explode_spectrum(spectrum_table(spark, sf_dir), keep=["vec_id"]))


@register("trace_display_params", sql=f"""
WITH {SPEC_SQL}
SELECT vec_id, ceil(mx / 10)::DOUBLE AS ref_level, ceil((ceil(mx / 10) - mn) / 10)::DOUBLE AS scale FROM mm
""")
def q_trace_display_params(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    ref, scale = X.trace_display_params("min_val", "max_val")
    return e.select("vec_id", ref.alias("ref_level"), scale.alias("scale"))


@register("explode_constellation", sql=f"""
WITH c AS (SELECT vec_id, embedding AS e, len(embedding) // 2 AS n FROM embeddings),
p AS (SELECT vec_id, n, unnest(range(0, n)) AS point FROM c)
SELECT p.vec_id, p.n::INTEGER AS num_pts_constellation, p.point::INTEGER AS point,
  {q_sql('c.e[p.point * 2 + 1]::DOUBLE')} AS constellation_y, {q_sql('c.e[p.point * 2 + 2]::DOUBLE')} AS constellation_x
FROM p JOIN c ON p.vec_id = c.vec_id
""")
def q_explode_constellation(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    c = e.select("vec_id", X.pair_iq("embedding").alias("constellation"))
    return round_doubles(X.explode_constellation(c, keep=["vec_id"]))
