"""Every series' own lags, exogenous inputs, training intervals, bands, NULL tags."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitlens.forecast import lagmodel as LM
from orbitlens.operators.filters import filter_intervals, interval_counts
from orbitlens.operators.windows import regular_smoothed_diff, smoothed_diff
from orbitlens.plans import pipelines as P

KEYS = ["metric", "satellite"]
T0 = dt.datetime(2024, 1, 1)
SCHEMA = "metric string, satellite string, ts timestamp_ntz, value double"


def telemetry(spark, n=1600, drop_tail=0):
    """Two targets on different periods, one with a NULL tag, and a load that moves them."""
    rng = np.random.default_rng(4)
    rows = []
    for sat, period in (("S1", 24), (None, 36)):
        load = np.repeat(rng.normal(0, 1, n // 8 + 1), 8)[:n]
        y = 20 + 4 * np.sin(2 * np.pi * np.arange(n) / period) + rng.normal(0, 0.1, n) + 2 * load
        for i in range(n):
            at = T0 + dt.timedelta(minutes=10 * i)
            if i < n - drop_tail:
                rows.append(("y", sat, at, float(y[i])))
            rows.append(("load", sat, at, float(load[i])))
    return spark.createDataFrame(rows, SCHEMA)


def at(i):
    return str(T0 + dt.timedelta(minutes=10 * i))


@pytest.mark.parametrize("exogenous", [[], ["load"]])
def test_train_and_predict(spark, tmp_path, exogenous):
    n, tail = 1600, 30
    df = telemetry(spark, n, drop_tail=tail).cache()
    if not exogenous:
        df = df.where("metric = 'y'")
    reg = P.train_job(df, None, KEYS, at(n - tail - 1), model_dir=str(tmp_path / "models"), exogenous=exogenous).cache()
    rows = {r.satellite: r for r in reg.collect()}
    assert rows.keys() == {"S1", None}
    for r in rows.values():
        assert r.exogenous == exogenous and r.freq_s == 600 and r.max_lag >= max(r.series_lags) and min(r.series_lags) > 10
        assert len(r.features) >= len(r.series_lags) and (not exogenous or r.features[-1] == "load")
    assert rows["S1"].series_lags != rows[None].series_lags
    marks = df.where("metric = 'y'").groupBy(*KEYS).agg(F.max("ts").alias("ts"))
    out = P.predict_job(df, reg, marks, KEYS, at(n - tail), horizon=20).collect()
    truth = {(r.satellite, r.ts): r.value for r in telemetry(spark, n).where("metric = 'y'").collect()}
    by = {}
    for r in out:
        by[(r.metric, r.satellite, r.ts)] = r.value
    for sat in ("S1", None):
        keys = sorted(k[2] for k in by if k[0] == "y_prediction" and k[1] == sat)
        assert len(keys) == 20 and keys[0] == T0 + dt.timedelta(minutes=10 * (n - tail))
        assert all(by[("y_lb", sat, k)] < by[("y_prediction", sat, k)] < by[("y_ub", sat, k)] for k in keys)      # a NULL tag keeps its bands
        error = np.mean([abs(by[("y_prediction", sat, k)] - truth[(sat, k)]) for k in keys])
        assert error < (0.5 if exogenous else 6), (sat, error)
    # what has a model is not trained again
    assert P.train_job(df, reg, KEYS, at(n - tail - 1), model_dir=str(tmp_path / "more"), exogenous=exogenous).count() == 0


def test_boosted_model_of_all_series(spark, tmp_path, monkeypatch):
    from orbitlens.forecast import models as MD
    whole = MD.fit_gbt
    monkeypatch.setattr(MD, "fit_gbt", lambda *a, **b: whole(*a, **{**b, "max_iter": 3, "max_depth": 4}))
    df = telemetry(spark, 500).where("metric = 'y'")
    reg = P.train_job(df, None, KEYS, at(499), model_dir=str(tmp_path), model="gbt").cache()
    marks = df.groupBy(*KEYS).agg(F.max("ts").alias("ts"))
    out = P.predict_job(df, reg, marks, KEYS, at(500))
    least = {r.satellite: r.min_lag for r in reg.collect()}
    assert {r.satellite: r.n for r in out.groupBy("satellite").agg(F.count("*").alias("n")).collect()} == least


def test_training_intervals(spark, tmp_path):
    """Rows outside the intervals leave no trace: a corrupted stretch outside changes no coefficient."""
    df = telemetry(spark, 900).where("metric = 'y' and satellite = 'S1'")
    reg = df.withColumn("freq_s", F.lit(600).cast("long")).withColumn("idx", (LM.grid_number() - F.lit(1704067200 // 600)).cast("long"))
    keep = spark.createDataFrame([(T0, T0 + dt.timedelta(minutes=10 * 500)), (T0 + dt.timedelta(minutes=10 * 700), T0 + dt.timedelta(days=99))],
                                 "start timestamp_ntz, end timestamp_ntz")
    spoilt = reg.withColumn("value", F.when(F.col("idx") == 600, 1e4).otherwise(F.col("value")))
    plan = (reg.groupBy(*KEYS).agg(F.count("*").alias("n"), F.min(LM.grid_number()).alias("a0"))
            .selectExpr("metric", "satellite", "n", "a0", "20.0D as center", "array(24L, 48L) as lags", "array() as lags_pos", "2L as window_size",
                        "1L as season", "5L as h", "3L as windows").withColumn("lags_pos", F.array().cast("array<long>")))

    def coef(rows):
        held = interval_counts(rows.select(*KEYS, "ts"), keep, out="_t")
        x = rows.join(held, ["satellite", "ts", "metric"], "left").withColumn("_t", F.coalesce("_t", F.lit(0)))
        return LM.fit_lagged(x, plan, KEYS, weight="_t").first()

    a, b = coef(reg), coef(spoilt)
    assert a.rows == 453 + 200 and np.allclose(a.coef, b.coef, atol=1e-9)


def test_interval_sweep(spark):
    rng = np.random.default_rng(2)
    rows = [("m", None if i % 5 == 0 else "S", T0 + dt.timedelta(seconds=int(s)), float(i)) for i, s in enumerate(rng.integers(0, 5000, 700))]
    df = spark.createDataFrame(rows, SCHEMA)
    for count, longest in ((10, 4000), (3000, 60)):
        iv = [(T0 + dt.timedelta(seconds=int(a)), T0 + dt.timedelta(seconds=int(a + b))) for a, b in zip(rng.integers(-500, 5500, count), rng.integers(-20, longest, count))]
        iv += [(iv[0][0], iv[0][1]), (rows[0][2], rows[0][2]), (None, T0), (T0, None)]
        got = filter_intervals(df, spark.createDataFrame(iv, "start timestamp_ntz, end timestamp_ntz")).collect()
        want = [r for r in rows for a, b in iv if a is not None and b is not None and a <= r[2] <= b]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    empty = spark.createDataFrame([], "start timestamp_ntz, end timestamp_ntz")
    assert filter_intervals(df, empty).count() == 0


def test_smoothed_difference_without_a_series_window(spark):
    rng = np.random.default_rng(6)
    rows = [("m", s, i, T0 + dt.timedelta(hours=i), float(v)) for s, n in ((None, 330), ("S", 49), ("T", 1)) for i, v in enumerate(rng.normal(0, 1, n))]
    df = spark.createDataFrame(rows, "metric string, satellite string, idx long, ts timestamp_ntz, value double")
    a = {(r.satellite, r.idx): r.d for r in regular_smoothed_diff(df, KEYS, out="d").collect()}
    b = {(r.satellite, r.idx): r.d for r in smoothed_diff(df, KEYS, "value", out="d").collect()}
    assert a.keys() == b.keys() and all((a[k] is None and b[k] is None) or abs(a[k] - b[k]) < 1e-9 for k in a)
