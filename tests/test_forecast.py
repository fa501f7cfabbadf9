"""Forecasting properties: a sine's period is found (M3, M4), conformal bands
cover, recursive forecasts continue a pure seasonal series."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orbitlens.forecast import features as FT
from orbitlens.forecast import models as MD
from orbitlens.forecast import seasonality as SE

KEYS = ["metric", "satellite"]
T0 = dt.datetime(2024, 1, 1)


def sine_frame(spark, period=24, n=960, noise=0.05, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for sat, ph in (("S1", 0.0), ("S2", 1.0)):
        for i in range(n):
            v = math.sin(2 * math.pi * i / period + ph) + rng.normal(0, noise)
            rows.append(("m", sat, T0 + dt.timedelta(hours=i), float(v)))
    pdf = pd.DataFrame(rows, columns=["metric", "satellite", "ts", "value"])
    return spark.createDataFrame(pdf, "metric string, satellite string, ts timestamp_ntz, value double")


def test_gbt_splits_many_series_by_level(spark):
    """5,000 series that differ by their level only: the hold-out error is below that of a per-series mean."""
    rng = np.random.default_rng(0)
    n, per = 5000, 12
    level = rng.normal(0, 50, n)
    y = level[:, None] + np.where(np.arange(per) % 2 == 0, 3.0, -3.0) + rng.normal(0, 0.5, (n, per))
    rows = [(f"m{i}", None if i == 7 else "S", t, float(y[i, t - 1]), float(y[i, t])) for i in range(n) for t in range(1, per)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=[*KEYS, "idx", "lag1", "value"]), "metric string, satellite string, idx long, lag1 double, value double")
    train, held = df.where("idx < 10"), df.where("idx >= 10")
    model = MD.fit_gbt(train, KEYS, ["lag1"], max_iter=20, max_depth=7, step_size=0.3)
    levels = MD.series_levels(train, KEYS)
    got = MD.predict_gbt(model, held, KEYS, levels).agg(F.count("*"), F.avg(F.abs(F.col("yhat") - F.col("value")))).first()
    mean = np.abs(y[:, 10:] - y[:, 1:10].mean(axis=1)[:, None]).mean()
    assert got[0] == 2 * n and got[1] < mean, (got, mean)


def test_rows_are_derived_once_for_a_fit(spark):
    """The estimator gets stored rows: its passes do not run the windows and joins of the features again."""
    from pyspark.ml.regression import DecisionTreeRegressor
    plans = []

    class Seen(DecisionTreeRegressor):
        def _fit(self, dataset):
            plans.append(dataset._jdf.queryExecution().optimizedPlan().toString())
            return super()._fit(dataset)

    rows = [("m", f"S{i % 3}", i // 3, float(i % 5), 2.0 * (i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "metric string, satellite string, idx long, lag1 double, value double")
    MD.fit_estimator(df, KEYS, ["lag1"], Seen(maxDepth=2))
    assert len(plans) == 1 and "Window" not in plans[0] and "Join" not in plans[0], plans


def _stepwise(spark, n, seed=5):
    """Rows whose features repeat: a few steps of the lags, three levels."""
    rng = np.random.default_rng(seed)
    a, b, i = rng.integers(0, 12, n), rng.integers(0, 5, n), np.arange(n)
    y = 10.0 * a - 3.0 * b * b + 10.0 * (i % 3) + rng.normal(0, 1, n)
    pdf = pd.DataFrame({"metric": "m", "satellite": [f"S{k}" for k in i % 3], "idx": i // 3, "lag1": a / 2 + 0.25, "lag2": b - 4.0, "value": y})
    return spark.createDataFrame(pdf, "metric string, satellite string, idx long, lag1 double, lag2 double, value double")


def test_boosted_trees_are_the_same_from_rows_added_up_by_bins(spark):
    from pyspark.ml.regression import GBTRegressor
    df = _stepwise(spark, 9000)
    x = MD.with_series_level(df, KEYS).checkpoint()
    gbt = GBTRegressor(featuresCol="_features", labelCol="value", predictionCol="yhat", maxIter=5, maxDepth=4, seed=0, stepSize=0.3, maxBins=64)
    rows, cells = MD._fit_rows(x.select("_level", "lag1", "lag2", "value"), ["lag1", "lag2"], gbt), MD._fit_cells(x, ["lag1", "lag2"], gbt, 9000)
    out = [m.transform(x).orderBy("metric", "satellite", "idx").toPandas().yhat.to_numpy() for m in (rows, cells)]
    assert len(out[0]) == 9000 and np.std(out[0]) > 10
    assert np.abs(out[0] - out[1]).max() < 1e-9
    _, held = MD.binned_cells(x, ["_level", "lag1", "lag2"], "value", 64, 0, 9000)
    assert held.agg(F.sum("_weight"), F.count("*")).first()[0] == 9000
    assert held.agg(F.sum(F.col("_weight") * F.col("value"))).first()[0] == pytest.approx(x.agg(F.sum("value")).first()[0])
    # a value nobody has shown yet and a missing one go where the thresholds of the rows send them
    new = x.limit(4).withColumn("lag1", F.when(F.col("idx") == 0, F.lit(None)).otherwise(F.lit(3.61))).withColumn("lag2", F.lit(-99.0))
    a, b = [sorted(r.yhat for r in m.transform(new).collect()) for m in (rows, cells)]
    assert a == pytest.approx(b)


def test_trees_pass_over_bins_where_rows_repeat(spark, monkeypatch, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import GBTRegressor
    whole, seen = GBTRegressor._fit, []

    def fit(self, dataset):
        seen.append(dataset.count())
        return whole(self, dataset)

    monkeypatch.setattr(GBTRegressor, "_fit", fit)
    df = _stepwise(spark, 70_000 * 3).where("lag1 < 2 and lag2 < 2 or idx < 50000")
    model = MD.fit_gbt(df, KEYS, ["lag1", "lag2"], max_iter=2, max_depth=3)
    assert len(seen) == 1 and seen[0] < df.count() / 2, seen
    model.write().save(str(tmp_path / "model"))
    levels = MD.series_levels(df, KEYS)
    few = df.where("idx < 20")
    a, b = [MD.predict_gbt(m, few, KEYS, levels) for m in (model, PipelineModel.load(str(tmp_path / "model")))]
    assert a.columns == [*df.columns, "yhat"] and a.count() == few.count()
    assert sorted(a.select("yhat").collect()) == sorted(b.select("yhat").collect())


def test_level_never_sees_the_own_row(spark):
    rows = [("m", s, i, float(v)) for s, x in (("a", [5, 1, 4]), (None, [2, 2, 9])) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "metric string, satellite string, idx long, value double")
    got = {(r.satellite, r.idx): r._level for r in MD.with_series_level(df, KEYS).collect()}
    every = 23 / 6
    assert got == {("a", 0): every, ("a", 1): 5.0, ("a", 2): 3.0, (None, 0): every, (None, 1): 2.0, (None, 2): 2.0}


def test_any_regressor_in_the_model_slot(spark):
    from pyspark.ml.regression import DecisionTreeRegressor
    rows = [("m", f"S{i % 3}", i // 3, float(i % 5), 2.0 * (i % 5) + i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "metric string, satellite string, idx long, lag1 double, value double")
    model = MD.fit_estimator(df, KEYS, ["lag1"], DecisionTreeRegressor(maxDepth=5))
    out = MD.predict_gbt(model, df, KEYS, MD.series_levels(df, KEYS))
    assert out.where("yhat is not null").count() == 300


def test_sine_period_found_by_acf_and_spectrum(spark):
    reg = FT.regular_series(sine_frame(spark), KEYS)
    acf = FT.autocorrelation(reg, KEYS, 120, block=256)
    peaks = SE.acf_peak_lags(acf, KEYS).toPandas()
    for sat, g in peaks.groupby("satellite"):
        assert any(lag % 24 == 0 for lag in g.lag), (sat, g.lag.tolist())
    per = SE.fft_period_lags(reg, KEYS, first_fraction=1.0).toPandas()
    for sat, g in per.groupby("satellite"):
        assert g.sort_values("round").lag.iloc[0] == 24, (sat, g)


def test_acf_matches_numpy(spark):
    reg = FT.regular_series(sine_frame(spark, n=300), KEYS)
    got = FT.autocorrelation(reg, KEYS, 30, block=64).toPandas()
    y = reg.filter(F.col("satellite") == "S1").orderBy("idx").toPandas()["value"].to_numpy()
    z = y - y.mean()
    exp = np.array([np.dot(z[: len(z) - k], z[k:]) for k in range(31)]) / np.dot(z, z)
    g = got[got.satellite == "S1"].sort_values("lag")["acf"].to_numpy()
    assert np.allclose(g, exp, atol=1e-10)


def test_linear_lag_model_forecast_and_interval_coverage(spark):
    reg = FT.regular_series(sine_frame(spark, noise=0.1), KEYS)
    lags = [24, 48]
    cols = [f"lag{k}" for k in lags]
    feats = FT.build_features(reg, KEYS, lags)
    coefs = MD.fit_linear(feats, KEYS, cols)
    fitted = MD.predict_linear(feats, coefs, KEYS, cols)
    res = fitted.select(*KEYS, F.lit(1).alias("step"), (F.col("value") - F.col("yhat")).alias("residual"))
    q = MD.conformal_quantiles(res, KEYS).toPandas()
    r = res.toPandas()
    for sat, g in r.groupby("satellite"):
        qq = float(q[q.satellite == sat].q.iloc[0])
        assert (g.residual.abs() <= qq).mean() >= 0.98
    fc = MD.forecast_recursive(reg, KEYS, lags, 48, lambda f: MD.predict_linear(f, coefs, KEYS, cols),
                               checkpoint=False).toPandas()
    assert len(fc) == 2 * 48
    s1 = fc[fc.satellite == "S1"].sort_values("step")
    truth = np.sin(2 * math.pi * (960 - 1 + s1.step.to_numpy()) / 24)
    assert np.sqrt(np.mean((s1.yhat.to_numpy() - truth) ** 2)) < 0.3


def test_gbt_query_fits_the_whole_model(spark, monkeypatch):
    import inspect

    import pytest

    from orbitlens.plans import q_models

    whole, asked = inspect.signature(MD.fit_gbt), {}

    def seen(*args, **more):
        given = whole.bind(*args, **more)
        given.apply_defaults()
        asked.update(given.arguments)
        raise InterruptedError

    monkeypatch.setattr(q_models.MD, "fit_gbt", seen)
    with pytest.raises(InterruptedError):
        q_models.q_gbt_forecast(spark, "/root/testdata/sf0.001")
    assert (asked["max_iter"], asked["max_depth"]) == (200, 7)
