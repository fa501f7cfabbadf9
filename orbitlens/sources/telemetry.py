"""Telemetry sources.

``read_metrics`` is the request builder of the reference turned into a
DataFrame plan: metric selection, tag filters and the time range are plain
predicates (pushed into the parquet scan), the sampled read is a partial
aggregation and the per-series limit a ``row_number`` bounded by
``WindowGroupLimit``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orbitlens.functions.time import (
    DAY, duration_us, epoch_us, floor_us, from_epoch_us, normalize_epoch_ms,
)

TS = "ts"
VALUE = "value"
METRIC = "metric"


def series_keys(df: DataFrame, *, ts: str = TS, value: str = VALUE) -> list[str]:
    """metric + every tag column (everything that is not time or value)."""
    return [c for c in df.columns if c not in (ts, value)]


def canonical_ts(df: DataFrame, col: str = TS) -> DataFrame:
    """Bring a time column to TIMESTAMP_NTZ (UTC wall clock).

    Accepts TIMESTAMP_NTZ (kept), TIMESTAMP (instant -> UTC wall clock), DATE,
    and integer epochs in s/ms/µs/ns (K7 digit rule).
    """
    t = df.schema[col].dataType.typeName()
    c = F.col(col)
    if t == "timestamp_ntz":
        return df
    if t == "timestamp":
        out = from_epoch_us(F.unix_micros(c))
    elif t == "date":
        out = c.cast("timestamp_ntz")
    elif t in ("long", "integer", "double", "float", "decimal"):
        out = from_epoch_us(normalize_epoch_ms(c) * 1000)
    else:
        out = F.to_timestamp_ntz(c.cast("string"))
    return df.withColumn(col, out)


def to_telemetry(df: DataFrame, *, metric, ts: str, value: str,
                 tags: dict | None = None) -> DataFrame:
    """Project any table onto the canonical long telemetry shape.

    ``metric`` is a column name or Column; ``tags`` maps tag name -> Column.
    NaN values become NULL (Spark keeps them distinct; pandas does not).
    """
    m = F.col(metric) if isinstance(metric, str) else metric
    cols = [m.cast("string").alias(METRIC)]
    for k, v in (tags or {}).items():
        cols.append((F.col(v) if isinstance(v, str) else v).cast("string").alias(k))
    v = F.col(value).cast("double")
    cols += [F.col(ts).alias(TS), F.when(F.isnan(v), None).otherwise(v).alias(VALUE)]
    return canonical_ts(df.select(*cols), TS)


def events_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test-data mapping: metric = event_type, satellite = 'SAT' + user_id % 3."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return to_telemetry(
        ev, metric="event_type", ts="ts", value="value",
        tags={"satellite": F.concat(F.lit("SAT"), (F.col("user_id") % 3).cast("string"))},
    )


def _ts_lit(x):
    """Epoch ms int / datetime / date / string -> TIMESTAMP_NTZ literal column."""
    if isinstance(x, (int, float)) and not isinstance(x, bool):
        return from_epoch_us(F.lit(int(x) * 1000).cast("bigint"))
    if isinstance(x, _dt.datetime):
        if x.tzinfo is not None:
            x = x.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return F.lit(x.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if isinstance(x, _dt.date):
        return F.lit(x.isoformat()).cast("timestamp_ntz")
    if isinstance(x, str):
        return F.lit(x).cast("timestamp_ntz")
    return x  # a Column


def read_metrics(df: DataFrame, metrics, start, end=None, *, tags: dict | None = None,
                 resample=0, limit: int | None = None, limit_by: list[str] | None = None, ts: str = TS,
                 value: str = VALUE) -> DataFrame:
    """The reference's query request as one DataFrame plan.

    * S2 ``metrics``: list of metric names (``metric IN (...)``)
    * S3 ``tags``: {tag: value}; AND over tags
    * S4 ``start`` always, ``end`` only if truthy, both inclusive
    * S5 ``resample`` > 0: first value per ``resample``-second bucket aligned to
      the epoch, stamped with the bucket start
    * S6 ``limit``: first ``limit`` points of each metric (points of one time in the order of their tags); with
      ``limit_by`` of every group of these columns, as one request per metric and tag value returns them
    """
    if isinstance(metrics, str):
        metrics = [metrics]
    out = df.filter(F.col(METRIC).isin(list(metrics)))
    for k, v in (tags or {}).items():
        out = out.filter(F.col(k) == F.lit(str(v)))
    out = out.filter(F.col(ts) >= _ts_lit(start))
    if end:
        out = out.filter(F.col(ts) <= _ts_lit(end))
    keys = series_keys(out, ts=ts, value=value)
    if resample:
        out = sample_first(out, keys, resample, ts=ts, value=value)
    if limit is not None:
        by = limit_by or [METRIC]
        out = limit_per_series(out, by, limit, ts=ts, ties=[k for k in keys if k not in by] + [value])
    return out


def sample_first(df: DataFrame, keys: list[str], every, *, ts: str = TS,
                 value: str = VALUE, label: str = "left") -> DataFrame:
    """Server-side style ``first`` aggregator per ``every`` bucket.

    Grouped aggregation with ``min_by`` (partial aggregation happens before
    the shuffle, so only one row per series and bucket crosses the network).
    The first *non-null* value of the bucket is taken.
    """
    step = duration_us(every)
    b = floor_us(epoch_us(ts), step)
    g = (df.filter(F.col(value).isNotNull())
         .withColumn("_b", b)
         .groupBy(*keys, "_b")
         .agg(F.min_by(F.col(value), F.col(ts)).alias(value)))
    lab = F.col("_b") + (step if label == "right" else 0)
    return g.select(*keys, from_epoch_us(lab).alias(ts), value)


def limit_per_series(df: DataFrame, keys: list[str], n: int, *, ts: str = TS,
                     descending: bool = False, ties: list[str] = ()) -> DataFrame:
    """First ``n`` points of every group of ``keys`` by time, then ``ties``.

    ``row_number() <= n`` is planned with a ``WindowGroupLimit`` before the
    shuffle, so a hot series ships at most ``n`` rows per input partition.
    """
    order = F.col(ts).desc() if descending else F.col(ts).asc()
    w = Window.partitionBy(*keys).orderBy(order, *ties)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def first_points(df: DataFrame, n: int = 2, **kw) -> DataFrame:
    """The first ``n`` points of each series (series discovery)."""
    return limit_per_series(df, series_keys(df), n, **kw)


def first_timestamp(df: DataFrame, *, ts: str = TS) -> DataFrame:
    """Earliest point of every series (``min(ts)``, partial aggregation)."""
    keys = series_keys(df, ts=ts)
    return df.groupBy(*keys).agg(F.min(ts).alias("first_ts"))


def list_tag_values(df: DataFrame, group: str, tag_cols: list[str], *, by: list[str] = ()) -> DataFrame:
    """Values of tag ``group`` over the series, plus the single-valued tags.

    One row (per ``by`` group): ``values`` (sorted array, NULL when there is
    no data) and ``fixed_tags`` (map tag -> value for tags with exactly one
    value over the series).  Works on the distinct series, a small table.
    """
    series = df.select(*by, *tag_cols).distinct()
    aggs = [F.array_sort(F.collect_set(group)).alias("values")]
    for t in tag_cols:
        aggs.append(F.count_distinct(t).alias(f"_n_{t}"))
        aggs.append(F.min(t).alias(f"_v_{t}"))
    r = series.groupBy(*by).agg(*aggs)
    entries = [F.when(F.col(f"_n_{t}") == 1, F.struct(F.lit(t).alias("k"), F.col(f"_v_{t}").alias("v")))
               for t in sorted(tag_cols)]
    fixed = F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))
    return r.select(*by, F.when(F.size("values") > 0, F.col("values")).alias("values"),
                    fixed.alias("fixed_tags"))


def chunk_ranges(first_ts: DataFrame, now, *, keys: list[str], months: int = 12,
                 chunk="30D", ts: str = "first_ts") -> DataFrame:
    """30-day ranges per series from max(first point, now - 12*30 d) to now.

    Ranges are closed; each end is 1 ms before the next start (the reference
    subtracts 1 ms), the last range ends at ``now``.  One row per range.
    """
    step = duration_us(chunk)
    now_us = epoch_us(_ts_lit(now))
    start = F.greatest(epoch_us(ts), now_us - F.lit(months * step))
    n = F.greatest(F.ceil((now_us - start) / F.lit(step)), F.lit(1)).cast("int")
    out = (first_ts.select(*keys, start.alias("_s"), now_us.alias("_now"), n.alias("_n"))
           .select(*keys, "_s", "_now", F.posexplode(F.array_repeat(F.lit(0), F.col("_n"))).alias("chunk_no", "_z")))
    cs = F.col("_s") + F.col("chunk_no") * F.lit(step)
    ce = F.least(cs + F.lit(step - 1000), F.col("_now"))
    return out.select(*keys, "chunk_no", from_epoch_us(cs).alias("chunk_start"),
                      from_epoch_us(ce).alias("chunk_end"))


def to_format(df: DataFrame, file_format: str = "ONE_ROW_PER_VALUE", *, tag_cols=None,
              values: list[str] | None = None) -> DataFrame:
    """Long (identity), wide (R1) or JSON rows; unknown format raises."""
    valid = ["JSON", "ONE_ROW_PER_TIMESTAMP", "ONE_ROW_PER_VALUE"]
    if file_format not in valid:
        raise ValueError(f"file_format {file_format!r} is none of {', '.join(valid)}")
    if file_format == "ONE_ROW_PER_VALUE":
        return df
    if file_format == "JSON":
        return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
    from orbitlens.operators.reshape import pivot_by_series
    return pivot_by_series(df, tag_cols=tag_cols or [c for c in series_keys(df) if c != METRIC],
                           values=values)


def retention(df: DataFrame, now, days: int = 7, *, ts: str = TS) -> DataFrame:
    """P11 (re-aimed run-log purge): keep records younger than ``days``."""
    return df.filter(F.col(ts) >= from_epoch_us(epoch_us(_ts_lit(now)) - F.lit(days * DAY)))


def read_exogenous(df: DataFrame, groups: DataFrame, windows: DataFrame, *, keys: list[str],
                   ts: str = TS) -> DataFrame:
    """The exogenous metrics of every series group over the group's
    window.  ``groups``: target, exogenous ARRAY<STRING>; ``windows``: target
    + tag keys, start, end.  An empty exogenous list gives no rows."""
    ex = groups.select("target", F.explode("exogenous").alias(METRIC))
    tag_keys = [k for k in keys if k != METRIC]
    from orbitlens.operators.windows import join_null_safe
    w = windows.join(ex, on="target")
    return (join_null_safe(df, w, [METRIC, *tag_keys], "inner")
            .filter((F.col(ts) >= F.col("start")) & (F.col(ts) <= F.col("end")))
            .select("target", METRIC, *tag_keys, ts, VALUE))


def read_bounds(df: DataFrame, metrics, *, lb_suffix: str = "_lb", ub_suffix: str = "_ub",
                keys: list[str], ts: str = TS) -> DataFrame:
    """The derived lower / upper bound series of ``metrics`` as two columns."""
    names = [m + s for m in metrics for s in (lb_suffix, ub_suffix)]
    tag_keys = [k for k in keys if k != METRIC]
    x = df.filter(F.col(METRIC).isin(names))
    base = F.regexp_replace(F.col(METRIC), f"({lb_suffix}|{ub_suffix})$", "")
    kind = F.when(F.col(METRIC).endswith(lb_suffix), F.lit("lb")).otherwise(F.lit("ub"))
    return (x.select(base.alias(METRIC), *tag_keys, ts, kind.alias("_k"), VALUE)
            .groupBy(METRIC, *tag_keys, ts).pivot("_k", ["lb", "ub"]).agg(F.first(VALUE)))
