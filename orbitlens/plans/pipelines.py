"""User-level jobs (P1, P2, P5, P6, P10, P11) as single DataFrame plans.

The reference runs one orchestrated job per (metric, tag) pair; here every
job handles all series in one plan.  Each returns the rows to write (long
telemetry rows named after the derived metric) and, where the job is
incremental, the new high-water marks.  ``run_and_commit`` performs the write
and the mark update in the order that makes a re-run safe: output first
(append, idempotent per (series, ts) through the marks), then marks.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.operators.detect import bounds_anomaly, moving_average_anomaly
from orbitlens.operators.resample import resample_first
from orbitlens.operators.stats import STAT_NAMES, bucket_stats, drop_open_bucket
from orbitlens.operators.windows import join_null_safe
from orbitlens.sinks.telemetry import high_water_marks, write_metrics
from orbitlens.sources.state import read_since
from orbitlens.sources.telemetry import sample_first


def _after_marks(df: DataFrame, marks: DataFrame, keys: list[str], *, pipeline: str, output: str,
                 ts: str) -> DataFrame:
    """F2 with a per-series mark: rows strictly after the series' mark (all
    rows for series without one)."""
    m = (marks.filter((F.col("pipeline") == pipeline) & (F.col("output") == output))
         .select(*keys, F.col("ts").alias("_mark")))
    return join_null_safe(df, m, keys).filter(F.col("_mark").isNull() | (F.col(ts) > F.col("_mark"))).drop("_mark")


def aggregation(df: DataFrame, marks: DataFrame, keys: list[str], now, *, every: str = "60T",
                pipeline: str = "aggregation", output: str = "stats") -> DataFrame:
    """Read since the mark -> bucket statistics -> drop the open bucket ->
    one long row per (series, bucket, statistic), NULL statistics dropped."""
    src = read_since(df, marks, keys, now, pipeline=pipeline, output=output, align=every)
    return _statistic_rows(drop_open_bucket(bucket_stats(src, keys, every), keys), keys, every)


def _statistic_rows(st: DataFrame, keys: list[str], every: str) -> DataFrame:
    long = st.withColumn("count", F.col("count").cast("double")) \
             .unpivot([*keys, "bucket_end"], STAT_NAMES, "stat", "value") \
             .filter(F.col("value").isNotNull())
    return long.select(F.concat(F.col("metric"), F.lit("_agg_"), F.col("stat"), F.lit(f"_{every}")).alias("metric"),
                       *[k for k in keys if k != "metric"], F.col("bucket_end").alias("ts"), "value")


def resample_job(df: DataFrame, marks: DataFrame, keys: list[str], now, *, every: str = "10s",
                 pipeline: str = "resample", output: str = "resample") -> DataFrame:
    """Read since the mark -> first value per bucket, bfill/ffill -> rows."""
    src = read_since(df, marks, keys, now, pipeline=pipeline, output=output, align=every)
    r = resample_first(src, keys, every)
    return r.withColumn("metric", F.concat(F.col("metric"), F.lit(f"_resample_{every}")))


def statistics_then_detect(df: DataFrame, marks: DataFrame, keys: list[str], now, *,
                           every: str = "60T", lookback: str = "6D", window: str = "3D",
                           min_periods: int = 1, sigma: float = 4.0, delta: float = 0.01,
                           pipeline: str = "aggregation", output: str = "stats",
                           tile_us: int | None = None) -> DataFrame:
    """P5 (moving-average branch): read with a 6-day lookback -> hourly
    statistics -> closed buckets -> D1 on every statistic column -> rows
    after the mark.  The isolation-forest branch is ``detect.forest``."""
    src = read_since(df, marks, keys, now, pipeline=pipeline, output=output, lookback=lookback, align=every)
    st = drop_open_bucket(bucket_stats(src, keys, every), keys)
    ma = moving_average_anomaly(st, keys, STAT_NAMES, window=window, min_periods=min_periods,
                                sigma=sigma, delta=delta, ts="bucket_end", tile_us=tile_us)
    return _after_marks(ma, marks, keys, pipeline=pipeline, output=output, ts="bucket_end")


def isolation_forest_job(df: DataFrame, marks: DataFrame, keys: list[str], now, *,
                         lookback: str = "6D", window: str = "3D", min_periods: int = 1,
                         sigma: float = 3.0, pipeline: str = "isolation_forest",
                         output: str = "iso") -> DataFrame:
    """Read with lookback -> D3 -> rows after the mark, long rows named
    ``<metric>_iso_score``."""
    from orbitlens.operators.forest import isolation_forest_anomaly
    src = read_since(df, marks, keys, now, pipeline=pipeline, output=output, lookback=lookback)
    d3 = isolation_forest_anomaly(src, keys, ["value"], window=window, min_periods=min_periods,
                                  sigma=sigma, base_name="value")
    d3 = _after_marks(d3, marks, keys, pipeline=pipeline, output=output, ts="ts")
    return d3.filter(F.col("value_iso_score").isNotNull()).select(
        F.concat(F.col("metric"), F.lit("_iso_score")).alias("metric"),
        *[k for k in keys if k != "metric"], "ts", F.col("value_iso_score").alias("value"))


def statistics_then_detect_all(df: DataFrame, marks: DataFrame, keys: list[str], now, *,
                               every: str = "60T", lookback: str = "6D", window: str = "3D",
                               min_periods: int = 1, pipeline: str = "aggregation",
                               output: str = "stats") -> tuple[DataFrame, DataFrame]:
    """P5, both branches: the closed statistics are computed once and written
    with a reliable ``checkpoint()`` (shared folder), then D1 on every
    statistic and D3 (one forest over all statistics) read them.  Returns
    (moving-average rows, isolation-forest rows), both after the mark."""
    from orbitlens.operators.forest import isolation_forest_anomaly
    from orbitlens.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    src = read_since(df, marks, keys, now, pipeline=pipeline, output=output, lookback=lookback, align=every)
    st = drop_open_bucket(bucket_stats(src, keys, every), keys) \
        .withColumn("count", F.col("count").cast("double")).checkpoint()
    ma = moving_average_anomaly(st, keys, STAT_NAMES, window=window, min_periods=min_periods, ts="bucket_end")
    iso = isolation_forest_anomaly(st, keys, STAT_NAMES, window=window, min_periods=min_periods,
                                   ts="bucket_end", base_name="stats")
    return (_after_marks(ma, marks, keys, pipeline=pipeline, output=output, ts="bucket_end"),
            _after_marks(iso, marks, keys, pipeline=pipeline, output=output, ts="bucket_end"))


def bounds_monitor(df: DataFrame, bounds: DataFrame, keys: list[str], *, every: str = "10s",
                   lb: str = "lb", ub: str = "ub") -> DataFrame:
    """Sampled values (first per ``every``) scored against bound series."""
    vals = sample_first(df, keys, every)
    return bounds_anomaly(vals, bounds, keys, ts="ts", value="value", lb=lb, ub=ub)


def bounds_monitor_run(df: DataFrame, bounds: DataFrame, marks: DataFrame, keys: list[str], now, *, every: str = "10s",
                       pipeline: str = "bounds_monitor", lb: str = "lb", ub: str = "ub") -> tuple[DataFrame, DataFrame]:
    """P6 + K9: (rows, new marks) of one incremental run with two outputs and one mark each (Q7).

    Values are read once, since the older of a series' two marks (a missing one counts as now - 24 h), and sampled;
    the samples are checkpointed and feed both outputs: ``<metric>_resample`` after the mark of "resample", and the
    scores against ``bounds`` as ``<metric>_bounds_score`` after the mark of "bounds"."""
    from orbitlens.functions.time import DAY, epoch_us, from_epoch_us
    from orbitlens.session import checkpoint_dir
    from orbitlens.sources.telemetry import _ts_lit
    checkpoint_dir(df.sparkSession)
    day = from_epoch_us(epoch_us(_ts_lit(now)) - F.lit(DAY))
    own = marks.where((F.col("pipeline") == pipeline) & F.col("output").isin("resample", "bounds"))
    older = own.groupBy(*keys).agg(F.min("ts").alias("_t"), F.countDistinct("output").alias("_n"))
    older = older.select(F.lit(pipeline).alias("pipeline"), F.lit("both").alias("output"), *keys,
                         F.when(F.col("_n") == 2, F.col("_t")).otherwise(F.least("_t", day)).alias("ts"))
    src = read_since(df, older, keys, now, pipeline=pipeline, output="both", align=every)
    samples = sample_first(src, keys, every).checkpoint()
    new = _after_marks(samples, marks, keys, pipeline=pipeline, output="resample", ts="ts")
    scores = _after_marks(bounds_anomaly(samples, bounds, keys, ts="ts", value="value", lb=lb, ub=ub), marks, keys,
                          pipeline=pipeline, output="bounds", ts="ts").where("bounds_score is not null")
    tags = [k for k in keys if k != "metric"]
    rows = (new.select(F.concat("metric", F.lit("_resample")).alias("metric"), *tags, "ts", "value")
            .unionByName(scores.select(F.concat("metric", F.lit("_bounds_score")).alias("metric"), *tags, "ts", F.col("bounds_score").alias("value"))))
    return rows, (high_water_marks(new, keys, pipeline=pipeline, output="resample")
                  .unionByName(high_water_marks(scores, keys, pipeline=pipeline, output="bounds")))


def one_class_svm_job(df: DataFrame, marks: DataFrame, keys: list[str], now, *, lookback: str = "6D", nu: float = 0.1,
                      pipeline: str = "one_class_svm", output: str = "ocsvm") -> DataFrame:
    """Read with lookback -> D4 -> rows after the mark, named ``<metric>_ocsvm_score``."""
    from orbitlens.operators.ocsvm import one_class_svm_anomaly
    src = read_since(df, marks, keys, now, pipeline=pipeline, output=output, lookback=lookback)
    d4 = _after_marks(one_class_svm_anomaly(src, keys, ["value"], nu=nu), marks, keys, pipeline=pipeline, output=output, ts="ts")
    return d4.where("ocsvm_score is not null").select(
        F.concat("metric", F.lit("_ocsvm_score")).alias("metric"), *[k for k in keys if k != "metric"], "ts", F.col("ocsvm_score").alias("value"))


def retention(df: DataFrame, now, days: int = 7, *, ts: str = "ts") -> DataFrame:
    """Keep records younger than ``days`` (re-aimed run-log purge)."""
    from orbitlens.sources.telemetry import retention as _r
    return _r(df, now, days, ts=ts)


def aggregation_run(df: DataFrame, marks: DataFrame, keys: list[str], now, *, every: str = "60T",
                    pipeline: str = "aggregation", output: str = "stats") -> tuple[DataFrame, DataFrame]:
    """P1 + K9: (rows, new marks) of one run.  The closed statistics are
    written once with ``checkpoint()`` and both come from them, so a bucket that
    closes while the run goes on is neither written nor marked."""
    from orbitlens.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    src = read_since(df, marks, keys, now, pipeline=pipeline, output=output, align=every)
    st = drop_open_bucket(bucket_stats(src, keys, every), keys).checkpoint()
    return (_statistic_rows(st, keys, every),
            high_water_marks(st.withColumnRenamed("bucket_end", "ts"), keys, pipeline=pipeline, output=output))


def aggregation_marks(df: DataFrame, marks: DataFrame, keys: list[str], now, *, every: str = "60T",
                      pipeline: str = "aggregation", output: str = "stats") -> DataFrame:
    """K9 for P1: per source series, the end of the last closed bucket written."""
    src = read_since(df, marks, keys, now, pipeline=pipeline, output=output, align=every)
    st = drop_open_bucket(bucket_stats(src, keys, every, keep_empty=False), keys)
    return high_water_marks(st.withColumnRenamed("bucket_end", "ts"), keys, pipeline=pipeline, output=output)


def run_and_commit(rows: DataFrame, new_marks: DataFrame, *, out_path: str, marks_path: str,
                   batch_id: str | None = None) -> None:
    """Append ``rows`` to the output table, then add the new marks to the mark table.

    Marks are only ever added: a series that is silent in this run, and every
    other pipeline's marks, stay.  ``current_marks`` reads the newest per key.

    Output first, marks second.  If the job dies in between, a new try with the
    same ``batch_id`` replaces the rows of the first; a run with another id
    re-reads from the old mark and writes the same (series, ts) rows again, of
    which ``streaming.telemetry.dedup_latest`` reads one.  Take rows and marks
    from one evaluation (``aggregation_run``).
    """
    write_metrics(rows, out_path, batch_id=batch_id)
    new_marks.write.mode("append").parquet(marks_path)


def current_marks(spark, marks_path: str, keys: list[str]) -> DataFrame:
    """The newest mark of every (pipeline, output, series)."""
    return (spark.read.parquet(marks_path).groupBy("pipeline", "output", *keys).agg(F.max("ts").alias("ts")))


# ---------------------------------------------------------------- P7 / P8 / P9
#: season and lags need this many points: the smoothing takes 2 % of them, the search the first quarter
MIN_POINTS = 50


def lag_search(reg: DataFrame, keys: list[str]) -> DataFrame:
    """Every series' lags (``seasonality.select_lags``) from all lags and all positive frequencies of
    its first quarter; five autocorrelation peaks, four spectral rounds."""
    from orbitlens.forecast import features as FT
    from orbitlens.forecast import seasonality as SE
    acf = SE.acf_peak_lags(FT.autocorrelation(reg, keys, first_fraction=0.25), keys, nlags=5).select(*keys, "lag")
    fft = SE.fft_period_lags(reg, keys).select(*keys, "lag")
    return SE.select_lags(acf.unionByName(fft), FT.series_sizing(reg, keys), keys)


def season_search(reg: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, season: the first lag found in the autocorrelation of the smoothed difference of the whole series."""
    from orbitlens.forecast import features as FT
    from orbitlens.forecast import seasonality as SE
    from orbitlens.operators.windows import regular_smoothed_diff
    d = regular_smoothed_diff(reg, keys, "value", out="_d")
    acf = FT.autocorrelation(d, keys, value="_d")
    return SE.acf_peak_lags(acf, keys, nlags=6).where("rank = 1").select(*keys, F.col("lag").alias("season"))


def exogenous_on_grid(df: DataFrame, grid: DataFrame, keys: list[str], names: list[str], *,
                      block_us: int | None = 7 * 86_400_000_000) -> DataFrame:
    """S15 + M14: keys, ts, name, value of the metrics ``names`` with the target's own tags, on the target's grid
    (``grid``: keys, ts, freq_s).  First value of a step; gaps are filled forward, then backward."""
    from orbitlens.functions.time import SEC, epoch_us, floor_us, from_epoch_us
    from orbitlens.operators.resample import fill_gaps
    tags = [k for k in keys if k != "metric"]
    freq = grid.groupBy(*keys).agg(F.first("freq_s").alias("freq_s"), F.min("ts").alias("_lo"), F.max("ts").alias("_hi"))
    e = df.where(F.col("metric").isin(list(names)) & F.col("value").isNotNull()).select(F.col("metric").alias("name"), *tags, "ts", "value")
    e = join_null_safe(e, freq.select(*keys, "freq_s"), tags, "inner") if tags else e.crossJoin(freq.select(*keys, "freq_s").limit(1))
    step = F.col("freq_s") * SEC
    e = (e.withColumn("_b", from_epoch_us(F.call_function("div", epoch_us("ts"), step) * step))
         .groupBy(*keys, "name", F.col("_b").alias("ts")).agg(F.min_by("value", "ts").alias("value")))
    cells = grid.select(*keys, "ts", F.explode(F.array(*[F.lit(n) for n in names])).alias("name"))
    return fill_gaps(join_null_safe(cells, e, [*keys, "ts", "name"]), [*keys, "name"], ["value"], ts="ts", order="ffill_bfill", block_us=block_us)


def _training_series(df, registry, keys, now, exogenous, history_days):
    from orbitlens.functions.time import DAY, epoch_us, from_epoch_us
    from orbitlens.sources.telemetry import _ts_lit
    df_targets = df.where(~F.col("metric").isin(list(exogenous))) if exogenous else df
    start = from_epoch_us(epoch_us(_ts_lit(now)) - F.lit(history_days * DAY))
    src = df_targets.where((F.col("ts") >= start) & (F.col("ts") <= _ts_lit(now)))
    if registry is None:
        return src
    known = registry.select(F.col("target").alias("metric"), *[k for k in keys if k != "metric"]).distinct()
    return join_null_safe(src, known, keys, "left_anti")             # a NULL tag is a value here


def train_job(df: DataFrame, registry: DataFrame | None, keys: list[str], now, *, model_dir: str,
              exogenous: list[str] = (), intervals: DataFrame | None = None, history_days: int = 360,
              freq=None, model: str = "linear") -> DataFrame:
    """Train where no model exists, return the new registry rows.

    registry check (left anti) -> one pruned read of at most 12 x 30 days (S11
    chunks become a single range filter) -> regular series (T4, T1, T3) ->
    season from the smoothed difference, lags of every series (M2-M6) ->
    model per series on its own lags, rolling means, season and exogenous
    values of the same time (``lagmodel``; with ``model="gbt"`` one boosted
    model of all series) -> saved under ``model_dir`` -> registry rows (M16,
    M15, M20) with each series' own min_lag, max_lag and features.

    ``exogenous``: metrics that are inputs, with the target's tags, and no targets themselves.  ``intervals``
    (start, end): only rows inside train, each as often as intervals hold it (F5).  Series shorter than
    MIN_POINTS, without lags or with fewer rows than features are not trained.
    """
    from orbitlens.forecast import features as FT
    from orbitlens.forecast import lagmodel as LM
    from orbitlens.forecast import models as MD
    from orbitlens.operators.filters import interval_counts
    from orbitlens.session import checkpoint_dir
    from orbitlens.sources.telemetry import _ts_lit

    checkpoint_dir(df.sparkSession)
    exogenous = list(exogenous)
    src = _training_series(df, registry, keys, now, exogenous, history_days)
    reg = FT.regular_series(src, keys, freq=freq)
    long_enough = reg.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= MIN_POINTS).select(*keys)
    reg = join_null_safe(reg, long_enough, keys, "left_semi").checkpoint()          # read by the searches, the fit and the sizing
    sizing = FT.series_sizing(reg, keys)
    selected = lag_search(reg, keys).checkpoint()
    season = season_search(reg, keys)
    plan = LM.model_plan(reg, selected, sizing, keys, season).checkpoint()
    path = f"{model_dir.rstrip('/')}/{model}-{uuid.uuid4().hex}"     # a run never touches earlier models
    rows = reg
    if exogenous:
        wide = (exogenous_on_grid(df, reg, keys, exogenous).groupBy(*keys, "ts").pivot("name", exogenous).agg(F.first("value")))
        rows = join_null_safe(rows, wide, [*keys, "ts"])
    if intervals is not None:
        held = interval_counts(rows.select(*keys, "ts"), intervals, out="_times")
        rows = join_null_safe(rows, held, [*keys, "ts"]).withColumn("_times", F.coalesce("_times", F.lit(0)))
    if model == "gbt":
        MD.fit_gbt_lagged(rows, plan, keys, path, exogenous=exogenous, weight="_times" if intervals is not None else None)
        done = plan.withColumns({"exogenous": F.array(*[F.lit(c) for c in exogenous]).cast("array<string>"),
                                 "features": F.transform("lags", lambda v: F.concat(F.lit("lag"), v.cast("string")))})
    else:
        fitted = LM.fit_lagged(rows, plan, keys, exogenous=exogenous, weight="_times" if intervals is not None else None)
        fitted.write.parquet(path)
        done = join_null_safe(df.sparkSession.read.schema(fitted.schema).parquet(path).select(*keys, "exogenous", "features", "lags", "window_size", "season"),
                              plan.select(*keys, "freq_s", "min_lag", "max_lag"), keys, "inner")
    tag_keys = [k for k in keys if k != "metric"]
    return done.select(F.col("metric").alias("target"), "exogenous", *tag_keys, F.to_date(_ts_lit(now)).alias("date"), F.lit(path).alias("path"),
                       "freq_s", "min_lag", "max_lag", "window_size", "season", F.lit(model).alias("model"), "features", F.col("lags").alias("series_lags"))


def predict_job(df: DataFrame, registry: DataFrame, marks: DataFrame, keys: list[str], now, *,
                horizon: int | None = None) -> DataFrame:
    """Latest model per series -> context window (S14, pruned by the earliest start of all series) -> regular
    series at the registry's frequency -> recursive forecast with the backtest's 99 % bands (M12, M11), exogenous
    values of the forecast times -> rows after the mark (M18) as ``<metric>_prediction``, ``_lb``, ``_ub``.

    ``horizon`` defaults to every series' own prediction length, min_lag steps (M15, L3)."""
    from orbitlens.forecast import features as FT
    from orbitlens.forecast import lagmodel as LM
    from orbitlens.forecast import models as MD
    from orbitlens.functions.time import epoch_us, ntz_of_us
    from orbitlens.session import checkpoint_dir
    from orbitlens.sources.state import model_context_window

    spark = df.sparkSession
    checkpoint_dir(spark)
    tag_keys = [k for k in keys if k != "metric"]
    info = ["path", "model", "min_lag", "max_lag", "window_size", "freq_s"]
    latest = registry.groupBy("target", *tag_keys).agg(F.max_by(F.struct(*info), F.struct("date", "path")).alias("m"))
    latest = latest.select(F.col("target").alias("metric"), *tag_keys, "m.*").checkpoint()
    runs = latest.select("path", "model").distinct().collect()               # one row per training run
    if not runs:
        raise ValueError("the registry holds no model")
    need = latest.withColumn("length_needed_s", (F.col("max_lag") + F.col("window_size") + 2) * F.col("freq_s"))
    ctx = model_context_window(marks, need, keys, now).checkpoint()
    low, high = ctx.agg(F.min(epoch_us("ctx_start")), F.max(epoch_us("ctx_end"))).first()
    if low is None:
        low = high = 0
    src = df.where((F.col("ts") >= ntz_of_us(low)) & (F.col("ts") <= ntz_of_us(high)))       # two scalars: the scan is pruned
    src = join_null_safe(src, ctx, keys, "inner").where((F.col("ts") >= F.col("ctx_start")) & (F.col("ts") <= F.col("ctx_end")))
    reg = FT.regular_series(src.select(*keys, "ts", "value"), keys, freq_table=latest).checkpoint()
    parts = []
    linear = [r["path"] for r in runs if r["model"] != "gbt"]
    if linear:
        models = reduce(DataFrame.unionByName, [spark.read.parquet(p).withColumn("path", F.lit(p)) for p in sorted(linear)])
        models = join_null_safe(models, latest.select(*keys, "path", "min_lag"), [*keys, "path"], "inner").checkpoint()
        h = horizon or models.agg(F.max("min_lag")).first()[0] or 1          # one scalar
        names = sorted({n for r in models.select(F.explode("exogenous").alias("n")).distinct().collect() for n in [r["n"]]})
        extra = None
        if names:
            ends = join_null_safe(reg, models.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.max("ts").alias("_last"), F.first("freq_s").alias("freq_s"))
            grid = ends.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(int(h)))))
            grid = grid.select(*keys, F.timestamp_add("SECOND", F.col("_i") * F.col("freq_s"), F.col("_last")).alias("ts"), "freq_s")
            extra = exogenous_on_grid(df.where(F.col("ts") >= ntz_of_us(low)), grid, keys, names).where("value is not null").checkpoint()
        fc = LM.forecast_lagged(reg, models.drop("min_lag"), keys, int(h), exogenous=extra)
        if horizon is None:
            fc = join_null_safe(fc, models.select(*keys, "min_lag"), keys, "inner").where("step <= min_lag").drop("min_lag")
        parts.append(fc.select(*keys, "ts", "yhat", "lo", "hi"))
    for r in sorted((r for r in runs if r["model"] == "gbt"), key=lambda r: r["path"]):
        own = latest.where(F.col("path") == r["path"])
        parts.append(MD.forecast_gbt_lagged(join_null_safe(reg, own.select(*keys), keys, "left_semi"), r["path"], keys, horizon)
                     .select(*keys, "ts", "yhat", F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi")))
    fc = MD.forecast_after_checkpoint(reduce(DataFrame.unionByName, parts), marks.select(*keys, "ts"), keys)
    long = fc.select(*keys, "ts", F.col("yhat").alias("prediction"), F.col("lo").alias("lb"), F.col("hi").alias("ub"))
    long = long.unpivot([*keys, "ts"], ["prediction", "lb", "ub"], "kind", "value")
    return long.select(F.concat(F.col("metric"), F.lit("_"), F.col("kind")).alias("metric"), *tag_keys,
                       "ts", "value").filter(F.col("value").isNotNull())
