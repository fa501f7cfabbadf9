"""Registered queries: sources, filters, reshape, sinks, joins (S, F, R, K, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlens.functions.output import q, q_sql, round_doubles
from orbitlens.functions.time import DAY, HOUR, normalize_epoch_ms, to_epoch_ms
from orbitlens.operators.filters import (
    after_checkpoint, drop_incomplete, filter_intervals, rename_columns, scale_metric,
)
from orbitlens.operators.joins import align_series, merge_outer, nearest_row, series_fanout
from orbitlens.operators.reshape import pivot_by_series, split_by_tags, unpivot_metrics
from orbitlens.operators.stats import STAT_NAMES
from orbitlens.plans import sqlparts as S
from orbitlens.plans.catalog import KEYS, hourly_stats, register, tele
from orbitlens.sinks.telemetry import high_water_marks, to_metric_rows
from orbitlens.sources.state import read_since
from orbitlens.sources.telemetry import (
    chunk_ranges, first_points, first_timestamp, list_tag_values, read_metrics, sample_first,
)

V = q_sql("value")


# ------------------------------------------------------------------ S1-S4
@register("read_metrics_filtered", sql=f"""
WITH {S.TELE}
SELECT metric, satellite, ts, {V} AS value FROM tele
WHERE metric IN ('click', 'view') AND satellite = 'SAT1'
  AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'
""")
def q_read_metrics_filtered(spark, sf_dir):
    r = read_metrics(tele(spark, sf_dir), ["click", "view"], "2024-01-05 00:00:00",
                     "2024-01-20 00:00:00", tags={"satellite": "SAT1"})
    return round_doubles(r)


# ------------------------------------------------------------------ S5
@register("read_metrics_sampled", sql=f"""
WITH {S.TELE},
s AS (SELECT metric, satellite, (epoch_us(ts) // 600000000) * 600000000 AS b, arg_min(value, ts) AS value
      FROM tele WHERE value IS NOT NULL AND ts >= TIMESTAMP '2024-01-02 00:00:00' GROUP BY ALL)
SELECT metric, satellite, make_timestamp(b) AS ts, {V} AS value FROM s
""")
def q_read_metrics_sampled(spark, sf_dir):
    t = tele(spark, sf_dir)
    r = read_metrics(t, ["click", "view", "purchase", "signup", "error"], "2024-01-02 00:00:00", resample=600)
    return round_doubles(r)


# ------------------------------------------------------------------ S6 / L1
@register("read_metrics_limit", sql=f"""
WITH {S.TELE},
r AS (SELECT *, row_number() OVER (PARTITION BY metric, satellite ORDER BY ts, value) AS rn FROM tele
      WHERE ts >= TIMESTAMP '2024-01-10 00:00:00')
SELECT metric, satellite, ts, {V} AS value FROM r WHERE rn <= 5
""")
def q_read_metrics_limit(spark, sf_dir):
    r = read_metrics(tele(spark, sf_dir), ["click", "view", "purchase", "signup", "error"],
                     "2024-01-10 00:00:00", limit=5, limit_by=KEYS)
    return round_doubles(r)


# ------------------------------------------------------------------ S8
@register("first_points", sql=f"""
WITH {S.TELE},
r AS (SELECT *, row_number() OVER (PARTITION BY metric, satellite ORDER BY ts) AS rn FROM tele)
SELECT metric, satellite, ts, {V} AS value FROM r WHERE rn <= 2
""")
def q_first_points(spark, sf_dir):
    return round_doubles(first_points(tele(spark, sf_dir), 2))


# ------------------------------------------------------------------ S9
@register("first_timestamp", sql=f"""
WITH {S.TELE} SELECT metric, satellite, min(ts) AS first_ts FROM tele GROUP BY ALL
""")
def q_first_timestamp(spark, sf_dir):
    return first_timestamp(tele(spark, sf_dir))


# ------------------------------------------------------------------ S10
@register("list_tag_values", sql=f"""
WITH {S.TELE},
s AS (SELECT DISTINCT metric, satellite FROM tele),
a AS (SELECT metric, list_sort(list(satellite)) AS v, count(DISTINCT satellite) AS n, min(satellite) AS one
      FROM s GROUP BY metric)
SELECT metric, array_to_string(v, ',') AS tag_values,
       CASE WHEN n = 1 THEN 'satellite=' || one ELSE '' END AS fixed_tags
FROM a
""")
def q_list_tag_values(spark, sf_dir):
    r = list_tag_values(tele(spark, sf_dir), "satellite", ["satellite"], by=["metric"])
    fixed = F.array_join(F.transform(F.map_entries("fixed_tags"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return r.select("metric", F.array_join("values", ",").alias("tag_values"), fixed.alias("fixed_tags"))


# ------------------------------------------------------------------ S11
@register("chunk_ranges", sql=f"""
WITH {S.TELE},
f AS (SELECT metric, satellite, greatest(epoch_us(min(ts)), epoch_us(TIMESTAMP '2024-03-15 00:00:00') - {12 * 30 * DAY}) AS s
      FROM tele GROUP BY ALL),
n AS (SELECT *, greatest(ceil((epoch_us(TIMESTAMP '2024-03-15 00:00:00') - s) / {30 * DAY}), 1)::BIGINT AS n FROM f),
c AS (SELECT metric, satellite, s, unnest(range(0, n)) AS chunk_no FROM n)
SELECT metric, satellite, chunk_no::INTEGER AS chunk_no, make_timestamp(s + chunk_no * {30 * DAY}) AS chunk_start,
       make_timestamp(least(s + chunk_no * {30 * DAY} + {30 * DAY - 1000}, epoch_us(TIMESTAMP '2024-03-15 00:00:00'))) AS chunk_end
FROM c
""")
def q_chunk_ranges(spark, sf_dir):
    ft = first_timestamp(tele(spark, sf_dir))
    return chunk_ranges(ft, "2024-03-15 00:00:00", keys=KEYS)


# ------------------------------------------------------------------ S12 / S13
def derived_marks(spark, sf_dir, pipeline="aggregation", output="stats"):
    """Mark table derived from the data: max(ts) - 5 days for SAT1/SAT2 series
    (SAT0 series have no mark and fall back to now - 24 h)."""
    t = tele(spark, sf_dir).filter(F.col("satellite") != "SAT0")
    m = t.groupBy(*KEYS).agg(F.max("ts").alias("ts"))
    m = m.withColumn("ts", F.timestamp_add("DAY", F.lit(-5), F.col("ts")))
    return m.select(F.lit(pipeline).alias("pipeline"), F.lit(output).alias("output"), *KEYS, "ts")


MARKS_SQL = ("marks AS (SELECT metric, satellite, max(ts) - INTERVAL 5 DAY AS mark FROM tele "
             "WHERE satellite <> 'SAT0' GROUP BY ALL)")
NOW = "2024-01-30 12:00:00"


def _since_sql(lookback_us: int) -> str:
    return f"""
WITH {S.TELE}, {MARKS_SQL}
SELECT t.metric, t.satellite, t.ts, {q_sql('t.value')} AS value
FROM tele t LEFT JOIN marks m ON t.metric = m.metric AND t.satellite = m.satellite
WHERE t.ts >= make_timestamp(coalesce(epoch_us(m.mark),
        (epoch_us(TIMESTAMP '{NOW}') - {DAY}) // {HOUR} * {HOUR}) - {lookback_us})
"""


@register("read_since", sql=_since_sql(0))
def q_read_since(spark, sf_dir):
    r = read_since(tele(spark, sf_dir), derived_marks(spark, sf_dir), KEYS, NOW,
                   pipeline="aggregation", output="stats", align="1H")
    return round_doubles(r)


@register("read_with_lookback", sql=_since_sql(6 * DAY))
def q_read_with_lookback(spark, sf_dir):
    r = read_since(tele(spark, sf_dir), derived_marks(spark, sf_dir), KEYS, NOW,
                   pipeline="aggregation", output="stats", align="1H", lookback="6D")
    return round_doubles(r)


# ------------------------------------------------------------------ K7 / F6
EPOCH_UNITS_SQL = """
src AS (SELECT event_id AS id, 's' AS unit, epoch_us(ts) // 1000000 AS raw FROM events
        UNION ALL SELECT event_id, 'ms', epoch_us(ts) // 1000 FROM events
        UNION ALL SELECT event_id, 'us', epoch_us(ts) FROM events
        UNION ALL SELECT event_id, 'ns', epoch_us(ts) * 1000 FROM events
        UNION ALL SELECT o_orderkey, 'old_s', epoch_us(o_orderdate) // 1000000 FROM orders
        UNION ALL SELECT o_orderkey, 'old_ms', epoch_us(o_orderdate) // 1000 FROM orders)"""


@register("normalize_epoch", sql=f"""
WITH {EPOCH_UNITS_SQL},
d AS (SELECT *, length(CAST(abs(raw) AS VARCHAR)) AS n FROM src)
SELECT id, unit, raw,
  CASE WHEN n % 3 = 1 THEN (CASE WHEN n >= 13 THEN raw // CAST(10 ** (n - 13) AS BIGINT) ELSE raw * CAST(10 ** (13 - n) AS BIGINT) END)
       WHEN n % 3 = 0 THEN (CASE WHEN n >= 12 THEN raw // CAST(10 ** (n - 12) AS BIGINT) ELSE raw * CAST(10 ** (12 - n) AS BIGINT) END)
       ELSE raw END AS epoch_ms
FROM d
""")
def q_normalize_epoch(spark, sf_dir):
    from orbitlens.functions.time import epoch_us
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    od = spark.read.parquet(f"{sf_dir}/orders.parquet")
    us = epoch_us("ts")
    parts = [ev.select(F.col("event_id").alias("id"), F.lit(u).alias("unit"), e.cast("bigint").alias("raw"))
             for u, e in [("s", F.floor(us / 1_000_000)), ("ms", F.floor(us / 1000)), ("us", us), ("ns", us * 1000)]]
    ous = epoch_us(F.col("o_orderdate").cast("timestamp_ntz"))
    parts += [od.select(F.col("o_orderkey").alias("id"), F.lit(u).alias("unit"), e.cast("bigint").alias("raw"))
              for u, e in [("old_s", F.floor(ous / 1_000_000)), ("old_ms", F.floor(ous / 1000))]]
    x = parts[0]
    for p in parts[1:]:
        x = x.unionByName(p)
    return x.select("id", "unit", "raw", normalize_epoch_ms("raw").alias("epoch_ms"))


@register("to_epoch_ms", sql="""
SELECT o_orderkey, epoch_ms(o_orderdate) AS epoch_ms FROM orders
""")
def q_to_epoch_ms(spark, sf_dir):
    od = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return od.select("o_orderkey", to_epoch_ms(F.col("o_orderdate").cast("timestamp_ntz")).alias("epoch_ms"))


# ------------------------------------------------------------------ F1-F5
@register("scale_metric", sql=f"""
WITH {S.TELE}
SELECT metric || '_processed_div2' AS metric, satellite, ts, {q_sql('value / 2.0')} AS value FROM tele
""")
def q_scale_metric(spark, sf_dir):
    return round_doubles(scale_metric(tele(spark, sf_dir), 2))


@register("after_checkpoint", sql=f"""
WITH {S.TELE}, {S.stats_ctes()}
SELECT metric, satellite, bucket_end, {S.rounded(STAT_NAMES, exclude=("count",))} FROM stats
WHERE bucket_end > TIMESTAMP '2024-01-25 00:00:00'
""")
def q_after_checkpoint(spark, sf_dir):
    return round_doubles(after_checkpoint(hourly_stats(spark, sf_dir), "2024-01-25 00:00:00", ts="bucket_end"))


@register("drop_incomplete", sql=f"""
WITH {S.TELE}, {S.stats_ctes()}
SELECT metric, satellite, bucket_end, {S.rounded(STAT_NAMES, exclude=("count",))} FROM stats
WHERE mean IS NOT NULL AND median IS NOT NULL AND std IS NOT NULL AND skew IS NOT NULL AND "min" IS NOT NULL
  AND "max" IS NOT NULL AND energy IS NOT NULL AND kurt IS NOT NULL AND max_diff IS NOT NULL
""")
def q_drop_incomplete(spark, sf_dir):
    return round_doubles(drop_incomplete(hourly_stats(spark, sf_dir)))


@register("filter_intervals", sql=f"""
WITH {S.TELE},
iv AS (SELECT min(ts) AS s, min(ts) + INTERVAL 2 DAY AS e FROM tele GROUP BY metric)
SELECT t.metric, t.satellite, t.ts, {q_sql('t.value')} AS value FROM tele t JOIN iv ON t.ts >= iv.s AND t.ts <= iv.e
""")
def q_filter_intervals(spark, sf_dir):
    t = tele(spark, sf_dir)
    iv = t.groupBy("metric").agg(F.min("ts").alias("start")) \
          .select("start", F.timestamp_add("DAY", F.lit(2), F.col("start")).alias("end"))
    return round_doubles(filter_intervals(t, iv))


# ------------------------------------------------------------------ R1-R3
LABELS = [f"{m} (satellite: SAT{s})" for m in ["click", "error", "purchase", "signup", "view"] for s in range(3)]


@register("pivot_by_series", sql=f"""
WITH {S.TELE},
s AS (SELECT metric || ' (satellite: ' || satellite || ')' AS label, (epoch_us(ts) // {HOUR}) * {HOUR} AS b,
             arg_min(value, ts) AS value FROM tele WHERE value IS NOT NULL GROUP BY ALL)
SELECT make_timestamp(b) AS ts,
  {", ".join(f'{q_sql(f"max(CASE WHEN label = {chr(39)}{lab}{chr(39)} THEN value END)")} AS "{lab}"' for lab in LABELS)}
FROM s GROUP BY b
""")
def q_pivot_by_series(spark, sf_dir):
    t = sample_first(tele(spark, sf_dir), KEYS, "1H")
    return round_doubles(pivot_by_series(t, tag_cols=["satellite"], values=LABELS))


@register("unpivot_stats", sql=f"""
WITH {S.TELE}, {S.stats_ctes()},
u AS (UNPIVOT (SELECT metric, satellite, bucket_end, mean, median, std FROM stats)
      ON mean, median, std INTO NAME stat VALUE value)
SELECT metric, satellite, bucket_end, stat, {V} AS value FROM u
""")
def q_unpivot_stats(spark, sf_dir):
    st = hourly_stats(spark, sf_dir).select(*KEYS, "bucket_end", "mean", "median", "std")
    u = unpivot_metrics(st, [*KEYS, "bucket_end"], ["mean", "median", "std"], metric="stat")
    return round_doubles(u.filter(F.col("value").isNotNull()))


@register("split_by_tags", sql=f"""
WITH {S.TELE} SELECT satellite, count(*) AS "rows", min(ts) AS first_ts, max(ts) AS last_ts FROM tele GROUP BY ALL
""")
def q_split_by_tags(spark, sf_dir):
    return split_by_tags(tele(spark, sf_dir), ["satellite"])


# ------------------------------------------------------------------ K1-K6, K9
@register("to_metric_rows", sql=f"""
WITH {S.TELE},
s AS (SELECT metric || ' (satellite: ' || satellite || ')' AS label, (epoch_us(ts) // {HOUR}) * {HOUR} AS b,
             arg_min(value, ts) AS value FROM tele WHERE value IS NOT NULL GROUP BY ALL)
SELECT label || '_copy' AS metric, 'tag_1' AS tag, make_timestamp(b) AS ts, {V} AS value FROM s
""")
def q_to_metric_rows(spark, sf_dir):
    t = sample_first(tele(spark, sf_dir), KEYS, "1H")
    wide = pivot_by_series(t, tag_cols=["satellite"], values=LABELS)
    return round_doubles(to_metric_rows(wide, ts="ts", extension="_copy"))


@register("commit_checkpoint", sql=f"""
WITH {S.TELE}, {S.stats_ctes()},
closed AS (SELECT * FROM (SELECT *, max(bucket_end) OVER (PARTITION BY metric, satellite) AS last_b FROM stats)
           WHERE bucket_end < last_b AND mean IS NOT NULL)
SELECT 'aggregation' AS pipeline, 'stats' AS output, metric, satellite, max(bucket_end) AS ts,
       epoch_ms(max(bucket_end)) AS mark_ms FROM closed GROUP BY ALL
""")
def q_commit_checkpoint(spark, sf_dir):
    from orbitlens.operators.stats import drop_open_bucket
    from orbitlens.sinks.telemetry import mark_ms
    st = drop_open_bucket(hourly_stats(spark, sf_dir), KEYS).filter(F.col("mean").isNotNull())
    return mark_ms(high_water_marks(st.withColumnRenamed("bucket_end", "ts"), KEYS,
                                    pipeline="aggregation", output="stats"))


# ------------------------------------------------------------------ J1, J2, J4, J5
def _hourly_mean(spark, sf_dir, metric):
    st = hourly_stats(spark, sf_dir).filter(F.col("metric") == metric)
    return st.select("satellite", "bucket_end", F.col("mean").alias(f"{metric}_mean"))


@register("align_series", sql=f"""
WITH {S.TELE}, {S.stats_ctes()}
SELECT a.satellite, a.bucket_end, {q_sql('a.mean')} AS click_mean, {q_sql('b.mean')} AS view_mean
FROM stats a JOIN stats b ON a.satellite = b.satellite AND a.bucket_end = b.bucket_end
WHERE a.metric = 'click' AND b.metric = 'view'
""")
def q_align_series(spark, sf_dir):
    j = align_series(_hourly_mean(spark, sf_dir, "click"), _hourly_mean(spark, sf_dir, "view"),
                     ["satellite"], ts="bucket_end")
    return round_doubles(j)


@register("merge_outer", sql=f"""
WITH {S.TELE},
s AS (SELECT metric, satellite, (epoch_us(ts) // {HOUR}) * {HOUR} AS b, arg_min(value, ts) AS value
      FROM tele WHERE value IS NOT NULL GROUP BY ALL),
a AS (SELECT satellite, b, value FROM s WHERE metric = 'click'),
c AS (SELECT satellite, b, value FROM s WHERE metric = 'purchase')
SELECT coalesce(a.satellite, c.satellite) AS satellite, make_timestamp(coalesce(a.b, c.b)) AS ts,
       {q_sql('a.value')} AS click, {q_sql('c.value')} AS purchase
FROM a FULL OUTER JOIN c ON a.satellite = c.satellite AND a.b = c.b
""")
def q_merge_outer(spark, sf_dir):
    s = sample_first(tele(spark, sf_dir), KEYS, "1H")
    a = s.filter(F.col("metric") == "click").select("satellite", "ts", F.col("value").alias("click"))
    c = s.filter(F.col("metric") == "purchase").select("satellite", "ts", F.col("value").alias("purchase"))
    return round_doubles(merge_outer(a, c, ["satellite"]))


@register("nearest_row", sql=f"""
WITH {S.TELE},
d AS (SELECT metric, satellite, ts, abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) AS dist FROM tele),
b AS (SELECT metric, satellite, arg_min(ts, (dist, ts)) AS nearest_ts FROM d GROUP BY ALL)
SELECT b.metric, b.satellite, b.nearest_ts, count(t.ts) AS rows_after
FROM b LEFT JOIN tele t ON t.metric = b.metric AND t.satellite = b.satellite AND t.ts > b.nearest_ts
GROUP BY ALL
""")
def q_nearest_row(spark, sf_dir):
    t = tele(spark, sf_dir)
    refs = t.select(*KEYS).distinct().withColumn("ref_ts", F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return nearest_row(t, refs, KEYS)


@register("series_fanout", sql=f"""
WITH {S.TELE},
m AS (SELECT DISTINCT event_type AS metric FROM events),
s AS (SELECT DISTINCT 'SAT' || CAST(k AS VARCHAR) AS satellite FROM range(0, 4) r(k)),
c AS (SELECT metric, satellite, count(*) AS n FROM tele GROUP BY ALL)
SELECT m.metric, s.satellite, coalesce(c.n, 0) AS n_points
FROM m CROSS JOIN s LEFT JOIN c ON c.metric = m.metric AND c.satellite = s.satellite
""")
def q_series_fanout(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    metrics = ev.select(F.col("event_type").alias("metric")).distinct()
    # tag values from the data plus one configured satellite without data (SAT3)
    sats = spark.range(0, 4).select(F.concat(F.lit("SAT"), F.col("id").cast("string")).alias("satellite"))
    pairs = series_fanout(metrics, sats)
    counts = tele(spark, sf_dir).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(counts, on=KEYS, how="left").select(*KEYS, F.coalesce("n", F.lit(0)).alias("n_points"))


__all__ = ["q"]


@register("to_format_json", sql=f"""
WITH {S.TELE}
SELECT CAST(to_json(struct_pack(metric := metric, satellite := satellite,
                                ts := strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), value := value)) AS VARCHAR) AS json
FROM tele
""")
def q_to_format_json(spark, sf_dir):
    """The JSON form of a read (one JSON object per point)."""
    from orbitlens.sources.telemetry import to_format
    t = tele(spark, sf_dir).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return to_format(t, "JSON")


# ------------------------------------------------------------------ K5, K6, K4
@register("write_rows_with_tags", sql=f"""
WITH {S.TELE}
SELECT 'raw_value' AS metric, 'GS1' AS station, satellite, ts, {V} AS value FROM tele
UNION ALL
SELECT 'raw_half' AS metric, 'GS1' AS station, satellite, ts, {q_sql('value / 2')} AS value FROM tele
""")
def q_write_rows_with_tags(spark, sf_dir):
    """K5/K6: a constant tag is added, the value columns are all the rest."""
    wide = tele(spark, sf_dir).select("satellite", "ts", "value", (F.col("value") / 2).alias("half"))
    return round_doubles(to_metric_rows(wide, tag_cols=["satellite"], tags={"station": "GS1"}, extension="raw_", prefix=True))


# ------------------------------------------------------------------ F7
@register("rename_columns", sql=f"""
WITH {S.TELE}
SELECT metric, satellite AS unit, ts, {V} AS y FROM tele
""")
def q_rename_columns(spark, sf_dir):
    """renamed by mapping, lag columns dropped by name."""
    from orbitlens.operators.windows import lag_features
    return round_doubles(rename_columns(lag_features(tele(spark, sf_dir), KEYS, "value", [1, 2]),
                                        {"value": "y", "satellite": "unit"}, drop_like="lag"))
