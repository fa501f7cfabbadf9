"""Registered queries: forecasting features."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlens.forecast import features as M
from orbitlens.functions.output import q_sql, round_doubles
from orbitlens.plans import lagsql as L
from orbitlens.plans import sqlparts as S
from orbitlens.plans.catalog import KEYS, register, tele
from orbitlens.plans.q_series import fill_sql

PK = "PARTITION BY metric, satellite"


@register("merge_exogenous", sql=f"""
WITH {S.TELE},
h AS (SELECT metric, satellite, date_trunc('hour', ts) AS ts, avg(value) AS y FROM tele GROUP BY ALL),
e AS (SELECT satellite, date_trunc('hour', ts) + INTERVAL 1 DAY AS ts, count(*)::DOUBLE AS load FROM tele GROUP BY ALL),
s AS (SELECT DISTINCT metric, satellite FROM tele),
x AS (SELECT s.metric, s.satellite, e.ts, e.load FROM s JOIN e ON s.satellite = e.satellite),
j AS (SELECT coalesce(h.metric, x.metric) AS metric, coalesce(h.satellite, x.satellite) AS satellite,
             coalesce(h.ts, x.ts) AS ts, h.y, x.load
      FROM h FULL JOIN x ON h.metric = x.metric AND h.satellite = x.satellite AND h.ts = x.ts)
SELECT metric, satellite, ts, {q_sql(fill_sql('y', 'ts', 'f'))} AS y, {q_sql(fill_sql('load', 'ts', 'f'))} AS load FROM j
""")
def q_merge_exogenous(spark, sf_dir):
    """Hourly means with the satellite's load of a day earlier, which reaches a day past the history."""
    from orbitlens.operators.joins import merge_exogenous
    t = tele(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    y = t.groupBy(*KEYS, "ts").agg(F.avg("value").alias("y"))
    load = (t.groupBy("satellite", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
            .agg(F.count("*").cast("double").alias("load")))
    series = t.select(*KEYS).distinct()
    return round_doubles(merge_exogenous(y, series.join(load, "satellite").select(*KEYS, "ts", "load"), KEYS, ["y", "load"]))


REG_SQL = f"""
g0 AS (SELECT metric, satellite, epoch_us(ts) - lag(epoch_us(ts)) OVER ({PK} ORDER BY ts) AS gap FROM tele),
fr AS (SELECT metric, satellite, greatest(1, floor(median(gap) / 1000000))::BIGINT AS freq_s FROM g0
       WHERE gap IS NOT NULL GROUP BY ALL),
f AS (SELECT t.metric, t.satellite, fr.freq_s, (epoch_us(t.ts) // (fr.freq_s * 1000000)) * (fr.freq_s * 1000000) AS b,
             arg_min(t.value, t.ts) AS v
      FROM tele t JOIN fr ON t.metric = fr.metric AND t.satellite = fr.satellite WHERE t.value IS NOT NULL GROUP BY ALL),
bo AS (SELECT metric, satellite, freq_s, min(b) AS lo, max(b) AS hi FROM f GROUP BY ALL),
gr AS (SELECT metric, satellite, freq_s, lo, unnest(range(lo, hi + 1, freq_s * 1000000)) AS b FROM bo),
j AS (SELECT gr.*, f.v FROM gr LEFT JOIN f ON f.metric = gr.metric AND f.satellite = gr.satellite AND f.b = gr.b),
reg AS (SELECT metric, satellite, make_timestamp(b) AS ts, {fill_sql('v', 'b')} AS value, freq_s,
               (b - lo) // (freq_s * 1000000) AS idx FROM j)"""


def reg_of(spark, sf_dir):
    return M.regular_series(tele(spark, sf_dir), KEYS)


@register("regular_series", sql=f"WITH {S.TELE}, {REG_SQL} SELECT metric, satellite, ts, {q_sql('value')} AS value, freq_s, idx FROM reg")
def q_regular_series(spark, sf_dir):
    return round_doubles(reg_of(spark, sf_dir))


@register("series_sizing", sql=f"""
WITH {S.TELE}, {REG_SQL},
n AS (SELECT metric, satellite, count(*) AS n, min(freq_s) AS freq_s FROM reg GROUP BY ALL),
w AS (SELECT *, n // 4 AS borne, ((n // 4) * 2) // 10 AS w FROM n)
SELECT metric, satellite, n, freq_s, borne, CASE WHEN w < 2 THEN 2 ELSE w END AS window_size,
  CASE WHEN w < 2 THEN '' ELSE array_to_string(list_filter([w, 2 * w, 3 * w], lambda l: l < {3600 * 24 * 30 * 3} / freq_s), ',') END AS lags_pos,
  least(2000, n // 100) AS frac, greatest(2, (least(2000, n // 100) * 6) // 10) AS n_windows
FROM w
""")
def q_series_sizing(spark, sf_dir):
    sz = M.series_sizing(reg_of(spark, sf_dir), KEYS)
    return sz.select(*KEYS, "n", "freq_s", "borne", "window_size",
                     F.array_join(F.transform("lags_pos", lambda x: x.cast("string")), ",").alias("lags_pos"),
                     "frac", "n_windows")


@register("autocorrelation", sql=f"""
WITH {S.TELE}, {REG_SQL}, {L.acf_sql('acf', 'reg')}
SELECT metric, satellite, lag, {q_sql('v')} AS acf FROM acf
""")
def q_autocorrelation(spark, sf_dir):
    """M2: all lags of every whole series."""
    return round_doubles(M.autocorrelation(reg_of(spark, sf_dir), KEYS))


@register("periodogram", sql=f"""
WITH {S.TELE}, {REG_SQL}, {L.QUARTER_SQL}, {L.spectrum_sql('sp', 'x1')}
SELECT metric, satellite, k, n, {q_sql('y')} AS magnitude FROM sp
""")
def q_periodogram(spark, sf_dir):
    """M4: all positive frequencies of every series' first quarter."""
    return round_doubles(M.periodogram(reg_of(spark, sf_dir), KEYS, first_fraction=0.25))


@register("fourier_features", sql=f"""
WITH {S.TELE}, {REG_SQL}
SELECT metric, satellite, ts, idx, {q_sql('sin(2 * pi() * idx / 24.0)')} AS sin1_24, {q_sql('cos(2 * pi() * idx / 24.0)')} AS cos1_24 FROM reg
""")
def q_fourier_features(spark, sf_dir):
    return round_doubles(M.fourier_features(reg_of(spark, sf_dir), 24).select(*KEYS, "ts", "idx", "sin1_24", "cos1_24"))


@register("future_frame", sql=f"""
WITH {S.TELE}, {REG_SQL},
l AS (SELECT metric, satellite, max(ts) AS last, min(freq_s) AS freq_s, max(idx) AS li FROM reg GROUP BY ALL),
fu AS (SELECT metric, satellite, last + to_seconds(i * freq_s) AS ts, 0.0 AS value, freq_s, li + i AS idx
       FROM l CROSS JOIN range(1, 13) r(i))
SELECT metric, satellite, ts, {q_sql('value')} AS value, freq_s, idx FROM reg
UNION ALL SELECT metric, satellite, ts, value, freq_s, idx FROM fu
""")
def q_future_frame(spark, sf_dir):
    return round_doubles(M.future_frame(reg_of(spark, sf_dir), KEYS, 12))


@register("restamp_index", sql=f"""
WITH {S.TELE}, {REG_SQL}
SELECT metric, satellite, TIMESTAMP '2000-01-01 00:00:00' + to_seconds(idx * freq_s) AS ts, {q_sql('value')} AS value, freq_s, idx FROM reg
""")
def q_restamp_index(spark, sf_dir):
    return round_doubles(M.restamp_index(reg_of(spark, sf_dir), KEYS))


@register("build_features", sql=f"""
WITH {S.TELE}, {REG_SQL},
ft AS (SELECT metric, satellite, ts, idx, value,
   lag(value, 1) OVER ({PK} ORDER BY idx) AS lag1, lag(value, 2) OVER ({PK} ORDER BY idx) AS lag2,
   lag(value, 24) OVER ({PK} ORDER BY idx) AS lag24,
   avg(value) OVER ({PK} ORDER BY idx ROWS BETWEEN 29 PRECEDING AND 24 PRECEDING) AS rm,
   sin(2 * pi() * idx / 24.0) AS s, cos(2 * pi() * idx / 24.0) AS c FROM reg)
SELECT metric, satellite, ts, idx, {q_sql('value')} AS value, {q_sql('lag1')} AS lag1, {q_sql('lag2')} AS lag2,
  {q_sql('lag24')} AS lag24, {q_sql('rm')} AS rolling_mean_lag24_window_size6, {q_sql('s')} AS sin1_24, {q_sql('c')} AS cos1_24
FROM ft WHERE lag1 IS NOT NULL AND lag2 IS NOT NULL AND lag24 IS NOT NULL
""")
def q_build_features(spark, sf_dir):
    r = M.build_features(reg_of(spark, sf_dir), KEYS, [1, 2, 24], window_lags=[24], window_size=6, season=24)
    return round_doubles(r.drop("freq_s"))
