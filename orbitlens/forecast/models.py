"""Models, intervals, recursive forecasting and the model registry
(M8, M9, M11, M12, M16, M18, M19, M20).

* Linear models for many series at once: the Gram matrix X'X and X'y of
  every series are sums, computed by one grouped aggregation (partial
  aggregation before the shuffle); the tiny per-series systems are solved
  with numpy, one row per series.
* Gradient boosted trees: ``pyspark.ml`` GBTRegressor, one distributed fit
  over all series, the series as an ordered target statistic; many rows are
  added up by the bins of their features before the trees.
* Recursive forecast: in blocks of ``min_lag`` steps - no feature of a block
  depends on a value predicted in the same block - one distributed plan per
  block for all series; lineage cut with ``checkpoint()`` between blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbitlens.forecast.features import _small_join, build_features

LEVEL = 99


# ---------------------------------------------------------------- linear (M9)
def fit_linear(feat: DataFrame, keys: list[str], features: list[str], *, label: str = "value",
               ridge: float = 0.0) -> DataFrame:
    """OLS per series on ``features`` (+ intercept).  Returns keys, coef
    (ARRAY<DOUBLE>, intercept first), features (ARRAY<STRING>), n."""
    xs = [F.lit(1.0)] + [F.col(f).cast("double") for f in features]
    p = len(xs)
    aggs = [F.sum(xs[i] * xs[j]).alias(f"_g{i}_{j}") for i in range(p) for j in range(i, p)]
    aggs += [F.sum(xs[i] * F.col(label)).alias(f"_b{i}") for i in range(p)]
    aggs.append(F.count(F.lit(1)).alias("n"))
    g = feat.na.drop("any", subset=[*features, label]).groupBy(*keys).agg(*aggs)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        g = np.empty((len(pdf), p, p))
        for i in range(p):
            for j in range(i, p):
                g[:, i, j] = g[:, j, i] = pdf[f"_g{i}_{j}"]
        b = pdf[[f"_b{i}" for i in range(p)]].to_numpy()
        out = pdf[keys + ["n"]].copy()
        out["coef"] = [np.linalg.lstsq(a + ridge * np.eye(p), v, rcond=None)[0].tolist() for a, v in zip(g, b)]
        return out

    schema = ", ".join([f"`{k}` string" for k in keys] + ["n bigint", "coef array<double>"])
    fitted = g.groupBy(*keys).applyInPandas(solve, schema)
    return fitted.withColumn("features", F.array(*[F.lit(f) for f in features]))


def predict_linear(feat: DataFrame, coefs: DataFrame, keys: list[str], features: list[str],
                   *, out: str = "yhat") -> DataFrame:
    """yhat = coef[0] + sum coef[i] * feature_i (per-series coefficients joined in)."""
    x = _small_join(feat, coefs.select(*keys, "coef"), keys)
    yhat = F.element_at("coef", 1)
    for i, f in enumerate(features):
        yhat = yhat + F.element_at("coef", i + 2) * F.col(f)
    return x.withColumn(out, yhat).drop("coef")


def linear_trend(reg: DataFrame, keys: list[str], *, value: str = "value", idx: str = "idx") -> DataFrame:
    """M9, one-feature case: value ~ a + b * idx with SQL's regression aggregates."""
    return reg.groupBy(*keys).agg(F.regr_slope(F.col(value), F.col(idx).cast("double")).alias("slope"),
                                  F.regr_intercept(F.col(value), F.col(idx).cast("double")).alias("intercept"))


# ---------------------------------------------------------------- intervals
def conformal_quantiles(residuals: DataFrame, keys: list[str], *, level: int = LEVEL,
                        step: str = "step", res: str = "residual") -> DataFrame:
    """Per (series, horizon step): the ``level`` % quantile of |residual| over
    the backtest windows (exact, linear interpolation)."""
    return residuals.groupBy(*keys, step).agg(
        F.percentile(F.abs(F.col(res)), level / 100.0).alias("q"))


def apply_intervals(fc: DataFrame, q: DataFrame, keys: list[str], *, step: str = "step",
                    yhat: str = "yhat", level: int = LEVEL) -> DataFrame:
    """yhat -+ q as ``lo_<level>`` / ``hi_<level>``."""
    from orbitlens.operators.windows import join_null_safe
    x = join_null_safe(fc, q, [*keys, step])
    return x.withColumn(f"lo_{level}", F.col(yhat) - F.col("q")) \
            .withColumn(f"hi_{level}", F.col(yhat) + F.col("q")).drop("q")


# ---------------------------------------------------------------- recursive
def forecast_recursive(reg: DataFrame, keys: list[str], lags: list[int], horizon: int, predict_fn,
                       *, window_lags=(), window_size: int = 2, season: int | None = None,
                       checkpoint: bool = True, features=None) -> DataFrame:
    """Forecast ``horizon`` steps for every series (``features(rows)`` replaces the common lag columns).

    Steps are produced in blocks of ``min(lags)``: within a block every lag
    reaches back to known or already forecast values, so each block is one
    plan over all series.  Only the last ``max(lags) + window`` positions of
    each series are carried between blocks; that tail and every block's
    predictions are cut from their lineage with a reliable ``checkpoint()``
    (shared checkpoint folder), so a lost executor recomputes one block, not
    the whole chain.  ``predict_fn(features_df)``
    returns the frame with a ``yhat`` column.

    Returns keys, ts, idx, step (1-based), yhat.
    """
    if checkpoint:
        from orbitlens.session import checkpoint_dir
        checkpoint_dir(reg.sparkSession)
    m = min(lags)
    need = max(list(lags) + [lg + window_size for lg in window_lags]) + 1
    last = reg.groupBy(*keys).agg(F.max("idx").alias("_last_idx"))
    hist = _small_join(reg, last, keys).filter(F.col("idx") > F.col("_last_idx") - need) \
                                        .select(*keys, "ts", "value", "freq_s", "idx", "_last_idx")
    if checkpoint:
        # the carried tail is small (need rows per series): cut its lineage so
        # no block re-derives the regular series from the source
        hist = hist.checkpoint()
    out = None
    done = 0
    while done < horizon:
        b = min(m, horizon - done)
        tail = hist.groupBy(*keys).agg(F.max("idx").alias("_cur"), F.max("ts").alias("_cur_ts"),
                                       F.first("freq_s").alias("_f"), F.first("_last_idx").alias("_li"))
        fut = tail.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(b))).alias("_i"), "_cur", "_cur_ts", "_f", "_li")
        fut = fut.select(*keys, F.timestamp_add("SECOND", F.col("_i") * F.col("_f"), F.col("_cur_ts")).alias("ts"),
                         F.lit(None).cast("double").alias("value"), F.col("_f").alias("freq_s"),
                         (F.col("_cur") + F.col("_i")).alias("idx"), F.col("_li").alias("_last_idx"))
        allrows = hist.unionByName(fut)
        feats = features(allrows) if features else build_features(
            allrows, keys, lags, window_lags=window_lags, window_size=window_size, season=season, drop_missing=False)
        feats = feats.filter(F.col("value").isNull())
        pred = predict_fn(feats).select(*keys, "ts", "idx", "freq_s", "_last_idx", "yhat")
        pred = pred.withColumn("step", F.col("idx") - F.col("_last_idx"))
        if checkpoint:
            pred = pred.checkpoint()
        out = pred if out is None else out.unionByName(pred)
        hist = hist.unionByName(pred.select(*keys, "ts", F.col("yhat").alias("value"), "freq_s", "idx", "_last_idx"))
        lim = hist.groupBy(*keys).agg(F.max("idx").alias("_mx"))
        hist = _small_join(hist, lim, keys).filter(F.col("idx") > F.col("_mx") - need).drop("_mx")
        if checkpoint and done + b < horizon:
            hist = hist.checkpoint()
        done += b
    return out.select(*keys, "ts", "idx", "step", "yhat")


def limit_horizon(fc: DataFrame, keys: list[str], n: int, *, ts: str = "ts") -> DataFrame:
    """L3: the first ``n`` forecast rows of every series (``row_number`` with a
    WindowGroupLimit under it)."""
    w = Window.partitionBy(*keys).orderBy(ts)
    return fc.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


# ---------------------------------------------------------------- GBT (M8)
#: a tree splits series by their level: the mean of what the series showed before the row (ordered, so a row never
#: sees its own target), and the mean of the whole training part when predicting
SERIES_CODE = ("_level",)
LEVEL_BLOCK = 8192


def with_series_level(feat: DataFrame, keys: list[str], *, label: str = "value", order: str = "idx") -> DataFrame:
    """Adds ``_level``: mean of ``label`` over the series' earlier rows (the first row: over all series' rows).

    Earlier blocks enter by their sums, so no task holds more of a series than LEVEL_BLOCK positions."""
    from orbitlens.operators.windows import join_null_safe
    x = feat.withColumn("_lb", F.floor(F.col(order) / LEVEL_BLOCK).cast("bigint"))
    sums = x.groupBy(*keys, "_lb").agg(F.sum(label).alias("_s"), F.count(label).alias("_c"))
    past = Window.partitionBy(*keys).orderBy("_lb").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_lb", F.coalesce(F.sum("_s").over(past), F.lit(0.0)).alias("_s0"), F.coalesce(F.sum("_c").over(past), F.lit(0)).alias("_c0"))
    x = join_null_safe(x, sums, [*keys, "_lb"])
    own = Window.partitionBy(*keys, "_lb").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_s0") + F.coalesce(F.sum(label).over(own), F.lit(0.0))
    count = F.col("_c0") + F.count(label).over(own)
    everywhere = feat.agg(F.avg(label)).first()[0]                       # one number
    level = F.when(count > 0, total / F.when(count > 0, count)).otherwise(F.lit(everywhere))
    return x.withColumn("_level", level).drop("_lb", "_s0", "_c0")


def series_levels(feat: DataFrame, keys: list[str], *, label: str = "value") -> DataFrame:
    """Keys, _level: every series' mean over its training rows."""
    return feat.groupBy(*keys).agg(F.avg(label).alias("_level"))


def _training_rows(feat: DataFrame, keys: list[str], features: list[str], label: str, order: str) -> DataFrame:
    from orbitlens.session import checkpoint_dir
    checkpoint_dir(feat.sparkSession)
    # an estimator passes over its rows several times before it keeps them in its own form
    return with_series_level(feat.na.drop("any", subset=[*features, label]), keys, label=label, order=order).checkpoint()


def _fit_rows(x: DataFrame, features: list[str], estimator):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    va = VectorAssembler(inputCols=[*SERIES_CODE, *features], outputCol="_features", handleInvalid="keep")
    return Pipeline(stages=[va, estimator]).fit(x)


def bin_edges(x: DataFrame, features: list[str], bins: int, seed: int, rows: int) -> list[list[float]]:
    """The thresholds a tree may use, one list per feature, as GBTRegressor finds them: from ``bins`` ** 2 of the
    ``rows`` (all, if they are no more) at most ``bins - 1`` cuts halfway between values, so that bins hold about
    equally many rows.  Only the places of the cuts come from the drawn rows."""
    drawn = max(bins * bins, 10_000) / rows
    values = (x if drawn >= 1 else x.sample(drawn, seed)).select(F.explode(F.array(
        *[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("v")) for i, c in enumerate(features)])).alias("e"))

    def cuts(pdf: pd.DataFrame) -> pd.DataFrame:
        v, n = np.unique(pdf["v"].dropna().to_numpy(), return_counts=True)
        half = (v[:-1] + v[1:]) / 2
        if len(half) >= bins:
            seen, stride, target, keep = np.cumsum(n).astype(float), n.sum() / bins, n.sum() / bins, []
            for i in range(len(half)):
                if abs(seen[i] - target) < abs(seen[i + 1] - target):
                    keep.append(i)
                    target += stride
            half = half[keep]
        return pd.DataFrame({"feature": [int(pdf["feature"].iloc[0])], "cuts": [half.tolist()]})

    found = values.select("e.*").groupBy("feature").applyInPandas(cuts, "feature int, cuts array<double>").collect()
    cut = {r.feature: r.cuts for r in found}
    return [cut[i] for i in range(len(features))]


def binned_cells(x: DataFrame, features: list[str], label: str, bins: int, seed: int, rows: int):
    """The rows of ``x`` added up by the bins of their features: a Bucketizer (``_code_<feature>``) and one row per
    combination of bins with its number of rows ``_weight`` and the mean of ``label``.

    A tree asks for the bin of a feature only, and its sums of counts and targets over any set of whole combinations
    are the same from these rows as from ``x``.  There are no more than ``bins ** len(features)`` of them."""
    from pyspark.ml.feature import Bucketizer
    inf = float("inf")
    # a tree's left side is value <= cut, a bucket's is value < split
    splits = [[-inf, *[float(np.nextafter(c, inf)) for c in cut], inf] if cut else [-inf, 0.0, inf]
              for cut in bin_edges(x, features, bins, seed, rows)]
    codes = [f"_code_{c}" for c in features]
    buckets = Bucketizer(inputCols=list(features), outputCols=codes, splitsArray=splits, handleInvalid="keep")
    # as plain numbers: a bucket's own column says that it is a category, and a tree would not keep its order
    x = buckets.transform(x).withColumns({c: F.col(c).cast("int") for c in codes})
    cells = x.groupBy(*codes).agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias("_weight"))
    return buckets, cells


def _fit_cells(x: DataFrame, features: list[str], gbt, rows: int):
    """The same model from the rows added up by bins; None if that leaves more than half as many."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    buckets, cells = binned_cells(x, [*SERIES_CODE, *features], gbt.getLabelCol(), gbt.getMaxBins(), gbt.getSeed(), rows)
    cells = cells.checkpoint()
    n = cells.count()
    if 2 * n > rows:
        return None
    va = VectorAssembler(inputCols=buckets.getOutputCols(), outputCol="_features", handleInvalid="keep")
    # up to maxBins ** 2 rows the fit looks at all of them for its thresholds: every bin is one
    gbt = gbt.copy().setWeightCol("_weight").setMaxBins(max(gbt.getMaxBins(), min(int(np.ceil(np.sqrt(n))), 46_340)))
    spread = cells.repartition(x.sparkSession.sparkContext.defaultParallelism)
    return PipelineModel([buckets, va, gbt.fit(va.transform(spread))])


def _fit(feat: DataFrame, keys: list[str], features: list[str], estimator, label: str, order: str):
    return _fit_rows(_training_rows(feat, keys, features, label, order), features, estimator)


def fit_gbt(feat: DataFrame, keys: list[str], features: list[str], *, label: str = "value", order: str = "idx",
            max_iter: int = 200, max_depth: int = 7, seed: int = 0, step_size: float = 0.1):
    """Gradient boosted trees over all series at once.  The series key enters as an ordered target statistic
    (``with_series_level``), so there is no limit on the number of series, no list of them on the driver, and a
    tree can split series by their level.  Returns the fitted PipelineModel.

    More rows than the thresholds are drawn from are added up by the bins of their features first (``binned_cells``),
    where that leaves at most half: all trees then pass over combinations of bins, whose number is bounded, not over
    rows."""
    from pyspark.ml.regression import GBTRegressor

    gbt = GBTRegressor(featuresCol="_features", labelCol=label, predictionCol="yhat", maxIter=max_iter,
                       maxDepth=max_depth, seed=seed, stepSize=step_size, maxBins=256)
    x = _training_rows(feat, keys, features, label, order)
    rows = x.count()
    fitted = _fit_cells(x, features, gbt, rows) if rows > gbt.getMaxBins() ** 2 else None
    return fitted or _fit_rows(x, features, gbt)


def fit_estimator(feat: DataFrame, keys: list[str], features: list[str], estimator, *,
                  label: str = "value", order: str = "idx"):
    """Any ``pyspark.ml`` regressor in the model slot (the reference lets
    the caller pass its own model object).  The estimator must read the
    ``_features`` vector and ``label`` and write ``yhat``; the series key enters
    as in ``fit_gbt``."""
    est = estimator.copy().setFeaturesCol("_features").setLabelCol(label).setPredictionCol("yhat")
    return _fit(feat, keys, features, est, label, order)


def predict_gbt(model, feat: DataFrame, keys: list[str], levels: DataFrame) -> DataFrame:
    """``levels``: ``series_levels`` of the training rows."""
    from orbitlens.operators.windows import join_null_safe
    out = model.transform(join_null_safe(feat, levels, keys, "inner"))
    return out.drop(*SERIES_CODE, "_features", *[c for c in out.columns if c.startswith("_code_")])


def lag_slots(reg: DataFrame, plan: DataFrame, keys: list[str], slots: int) -> DataFrame:
    """``reg`` with columns ``slot1`` .. ``slot<slots>``: the value at the series' first, second, ... own lag (a series
    with fewer lags repeats its last one).  Rows without all lags are dropped."""
    from orbitlens.operators.windows import join_null_safe
    lags = plan.select(*keys, F.posexplode("lags").alias("_slot", "_lag"))
    back = join_null_safe(reg.select(*keys, "idx", "value"), lags, keys, "inner").select(*keys, (F.col("idx") + F.col("_lag")).alias("idx"), "_slot", "value")
    seen = back.groupBy(*keys, "idx").agg(F.array_sort(F.collect_list(F.struct("_slot", "value"))).alias("_v"))       # one entry per lag
    seen = join_null_safe(seen, plan.select(*keys, F.size("lags").alias("_k")), keys, "inner").where(
        (F.size("_v") == F.col("_k")) & ~F.exists("_v", lambda e: e["value"].isNull()))
    x = join_null_safe(reg, seen.select(*keys, "idx", F.transform("_v", lambda e: e["value"]).alias("_v")), [*keys, "idx"], "inner")
    return x.select(*reg.columns, *[F.get("_v", F.least(F.lit(i), F.size("_v") - 1)).alias(f"slot{i + 1}") for i in range(slots)])


def fit_gbt_lagged(reg: DataFrame, plan: DataFrame, keys: list[str], path: str, *, exogenous: list[str] = (), weight: str | None = None, **how) -> None:
    """P7 with one boosted model of all series: every series' own lags in slots; saved with its plan and levels."""
    from orbitlens.session import checkpoint_dir
    checkpoint_dir(reg.sparkSession)
    slots = plan.agg(F.max(F.size("lags"))).first()[0] or 0                 # one number
    if exogenous:
        raise ValueError("exogenous inputs need model='linear'")
    if not slots:
        raise ValueError("no series is long enough to train")
    feat = lag_slots(reg, plan, keys, slots).checkpoint()                 # plain columns: many derived ones slow the planner
    if weight:
        feat = feat.where(F.col(weight) > 0).withColumn("_again", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(weight).cast("bigint")))).drop("_again")
    fit_gbt(feat, keys, [f"slot{i + 1}" for i in range(slots)], **how).write().save(f"{path}/model")
    from orbitlens.operators.windows import join_null_safe
    join_null_safe(plan.select(*keys, "lags", "min_lag", F.lit(slots).alias("slots")), series_levels(feat, keys), keys, "inner").write.parquet(f"{path}/plan")


def forecast_gbt_lagged(reg: DataFrame, path: str, keys: list[str], horizon: int | None = None) -> DataFrame:
    """Recursive forecast with a model of ``fit_gbt_lagged``; by default every series' own min_lag steps."""
    from pyspark.ml import PipelineModel

    from orbitlens.operators.windows import join_null_safe
    spark = reg.sparkSession
    plan = spark.read.parquet(f"{path}/plan")
    model = PipelineModel.load(f"{path}/model")
    slots, most, least = plan.agg(F.max("slots"), F.max("min_lag"), F.min(F.array_min("lags"))).first()
    need = plan.agg(F.max(F.array_max("lags"))).first()[0]

    def features(rows):
        return lag_slots(rows, plan, keys, slots)

    fc = forecast_recursive(reg, keys, [int(least), int(need)], int(horizon or most), lambda f: predict_gbt(model, f, keys, plan.select(*keys, "_level")), features=features)
    if horizon is None:
        fc = join_null_safe(fc, plan.select(*keys, "min_lag"), keys, "inner").where("step <= min_lag").drop("min_lag")
    return fc


# ---------------------------------------------------------------- registry
def lookup_models(registry: DataFrame, keys: list[str]) -> DataFrame:
    """Latest model per (target, exogenous, tags): ``max_by(path, date)``."""
    return registry.groupBy(*keys).agg(F.max_by("path", "date").alias("path"), F.max("date").alias("date"))


def models_to_train(series: DataFrame, registry: DataFrame, keys: list[str]) -> DataFrame:
    """Train only where no model exists: left anti join on the registry."""
    from orbitlens.operators.windows import join_null_safe
    return join_null_safe(series, registry.select(*keys).distinct(), keys, "left_anti")


def forecast_after_checkpoint(fc: DataFrame, marks: DataFrame, keys: list[str], *, ts: str = "ts",
                              names: dict | None = None) -> DataFrame:
    """Keep forecast rows strictly after the series' mark; rename columns."""
    m = marks.select(*keys, F.col("ts").alias("_mark"))
    from orbitlens.operators.windows import join_null_safe
    x = join_null_safe(fc, m, keys).filter(F.col("_mark").isNull() | (F.col(ts) > F.col("_mark"))).drop("_mark")
    return x.withColumnsRenamed(names) if names else x


__all__ = ["fit_linear", "predict_linear", "linear_trend", "conformal_quantiles", "apply_intervals",
           "forecast_recursive", "fit_gbt", "predict_gbt", "lookup_models", "models_to_train",
           "forecast_after_checkpoint", "Window", "build_features"]
