"""Per-series lag models against plain least squares, the backtest bands and the recursive forecast."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from orbitlens.forecast import lagmodel as LM
from orbitlens.forecast.spectrum import CURVE

KEYS = ["metric", "satellite"]
FREQ = 600


def regular(spark, series, exog=None):
    rows = []
    for (m, s), y in series.items():
        for i, v in enumerate(y):
            rows.append((m, s, (i + 5) * FREQ, float(v), i, *( [float(exog[(m, s)][i])] if exog else [])))
    cols = "metric string, satellite string, sec long, value double, idx long" + (", load double" if exog else "")
    df = spark.createDataFrame(rows, cols)
    return (df.withColumn("ts", F.timestamp_add("SECOND", F.col("sec"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
            .withColumn("freq_s", F.lit(FREQ).cast("long")).drop("sec"))


def plan_of(spark, plans):
    rows = [(m, s, FREQ, min(p["lags"]), max(p["lags"]), p["n"], 5, p["center"], p["lags"], p["pos"], p["w"], p["season"], p["h"], p["windows"])
            for (m, s), p in plans.items()]
    return spark.createDataFrame(rows, "metric string, satellite string, freq_s long, min_lag long, max_lag long, " + LM.PLAN_TYPES)


def design(y, p, exog=None):
    """Rows t = max(lags) .. n-1: features and target, values centred."""
    v = y - p["center"]
    out = []
    for t in range(max(p["lags"]), len(v)):
        row = [1.0] + [v[t - k] for k in p["lags"]]
        row += [v[max(0, t - k - p["w"] + 1):t - k + 1].mean() for k in p["pos"]]
        if p["season"] > 1:
            a = 2 * math.pi * ((5 + t) % p["season"]) / p["season"]
            row += [math.sin(a), math.cos(a)]
        if exog is not None:
            row.append(exog[t])
        out.append(row + [v[t]])
    return np.array(out)


def random_plans(seed, sizes):
    rng = np.random.default_rng(seed)
    series, plans = {}, {}
    for i, n in enumerate(sizes):
        key = ("m", None if i == 1 else f"S{i}")                       # a null tag is a series
        y = 50 + 3 * np.sin(2 * np.pi * np.arange(n) / (20 + i)) + rng.normal(0, 0.3, n)
        lags = sorted(rng.choice(np.arange(11, min(300, n // 4)), size=3 + i % 5, replace=False).tolist())
        series[key] = y
        plans[key] = {"n": n, "center": float(y.mean()), "lags": lags, "pos": [lags[0], lags[-1] - 1][: i % 3], "w": 7, "season": [1, 24][i % 2],
                      "h": min(lags[0], 9), "windows": [0, 5, 12][i % 3]}
    return series, plans


def test_models_and_bands_equal_plain_least_squares(spark):
    series, plans = random_plans(1, [400, 900, 700, CURVE + 700, 2 * CURVE + 11, 350])
    rng = np.random.default_rng(2)
    exog = {k: rng.normal(0, 1, len(y)) for k, y in series.items()}
    series = {k: y + 0.5 * exog[k] for k, y in series.items()}
    got = {(r.metric, r.satellite): r for r in LM.fit_lagged(regular(spark, series, exog), plan_of(spark, plans), KEYS, exogenous=["load"]).collect()}
    assert got.keys() == series.keys()
    for k, y in series.items():
        p, r = plans[k], got[k]
        z = design(y, p, exog[k])
        want = np.linalg.lstsq(z[:, :-1], z[:, -1], rcond=None)[0]
        assert np.allclose(r.coef, want, atol=1e-6), k
        assert r.rows == len(z) and len(r.features) == len(r.coef) - 1 and r.features[-1] == "load"
        errors = [[] for _ in range(p["h"])]
        first = len(z) - p["h"] * p["windows"]
        for i in range(p["windows"]):                                  # the model of the rows before the window
            a = first + i * p["h"]
            c = np.linalg.lstsq(z[:a, :-1], z[:a, -1], rcond=None)[0]
            for s in range(p["h"]):
                errors[s].append(abs(z[a + s, -1] - z[a + s, :-1] @ c))
        q = np.maximum.accumulate([np.quantile(e, 0.99) for e in errors]).tolist() if p["windows"] else None
        assert (r.bands is None) if q is None else np.allclose(r.bands, q, atol=1e-6)


def test_rows_left_out_by_weight(spark):
    series, plans = random_plans(3, [500])
    (k, y), p = next(iter(series.items())), next(iter(plans.values()))
    reg = regular(spark, series).withColumn("w", F.when(F.col("idx") < 200, 0).when(F.col("idx") < 300, 2).otherwise(1))
    r = LM.fit_lagged(reg, plan_of(spark, plans), KEYS, weight="w").first()
    z = design(y, p)
    t = np.arange(max(p["lags"]), len(y))
    w = np.where(t < 200, 0, np.where(t < 300, 2, 1))
    z = np.repeat(z, w, axis=0)
    assert np.allclose(r.coef, np.linalg.lstsq(z[:, :-1], z[:, -1], rcond=None)[0], atol=1e-6)


def test_forecast_equals_a_plain_recursion(spark):
    series, plans = random_plans(4, [600, 800, 500])
    reg = regular(spark, series)
    models = LM.fit_lagged(reg, plan_of(spark, plans), KEYS).checkpoint()
    out = {}
    for r in LM.forecast_lagged(reg, models, KEYS, 30).collect():
        out.setdefault((r.metric, r.satellite), {})[r.step] = r
    coef = {(r.metric, r.satellite): r for r in models.collect()}
    for k, y in series.items():
        p, v = plans[k], list(y - plans[k]["center"])
        for s in range(1, 31):
            t = len(v)
            f = [1.0] + [v[t - i] for i in p["lags"]] + [np.mean(v[t - i - p["w"] + 1:t - i + 1]) for i in p["pos"]]
            if p["season"] > 1:
                a = 2 * math.pi * ((5 + t) % p["season"]) / p["season"]
                f += [math.sin(a), math.cos(a)]
            v.append(float(np.dot(f, coef[k].coef)))
            r = out[k][s]
            assert abs(r.yhat - (v[-1] + p["center"])) < 1e-6
            assert r.ts.timestamp() == pd.Timestamp((t + 5) * FREQ, unit="s").to_pydatetime().timestamp()
            if p["windows"]:
                q = coef[k].bands[min(s, p["h"]) - 1]
                assert abs(r.hi - r.yhat - q) < 1e-9 and abs(r.yhat - r.lo - q) < 1e-9
            else:
                assert r.lo is None


def test_bands_cover_held_out_points_and_widen(spark):
    rng = np.random.default_rng(9)
    n, hold = 3000, 300
    series, plans = {}, {}
    for i in range(8):
        y = 10 + 2 * np.sin(2 * np.pi * np.arange(n) / 24) + rng.normal(0, 0.5, n)
        series[("m", f"S{i}")] = y
        plans[("m", f"S{i}")] = {"n": n - hold, "center": float(y[:n - hold].mean()), "lags": [24, 48, 72], "pos": [], "w": 2, "season": 24, "h": 20, "windows": 60}
    reg = regular(spark, series)
    models = LM.fit_lagged(reg.where(F.col("idx") < n - hold), plan_of(spark, plans), KEYS).checkpoint()
    inside = []
    for r in models.collect():
        assert all(a <= b for a, b in zip(r.bands, r.bands[1:]))
        z = design(series[(r.metric, r.satellite)], plans[(r.metric, r.satellite)])[-hold:]
        miss = np.abs(z[:, -1] - z[:, :-1] @ np.array(r.coef))
        inside.append(np.mean(miss <= np.array(r.bands)[np.arange(hold) % 20]))
    assert 0.97 <= np.mean(inside) <= 1.0


def test_two_hundred_series_with_forty_lags_in_one_fit(spark):
    rng = np.random.default_rng(5)
    series, plans = {}, {}
    for i in range(200):
        n = 400
        series[("m", f"S{i}")] = rng.normal(0, 1, n).cumsum()
        plans[("m", f"S{i}")] = {"n": n, "center": 0.0, "lags": sorted(rng.choice(np.arange(11, 120), 40, replace=False).tolist()), "pos": [], "w": 2,
                                 "season": 1, "h": 4, "windows": 3}
    rows = LM.fit_lagged(regular(spark, series), plan_of(spark, plans), KEYS).collect()
    assert len(rows) == 200
    for r in rows[::29]:
        z = design(series[(r.metric, r.satellite)], plans[(r.metric, r.satellite)])
        assert np.allclose(r.coef, np.linalg.lstsq(z[:, :-1], z[:, -1], rcond=None)[0], atol=1e-6)


def test_forecast_passes_over_the_history_once(spark, monkeypatch):
    """Many blocks (smallest lag 2, 12 steps): the context's running sums meet the asked positions once, not once a block."""
    y = np.random.default_rng(2).normal(0, 1, 300)
    plans = {("m", "S"): dict(lags=[2, 7], pos=[3], w=2, season=1, h=3, windows=2, n=300, center=0.0)}
    reg = regular(spark, {("m", "S"): y})
    models = LM.fit_lagged(reg, plan_of(spark, plans), KEYS).checkpoint()
    joined, join = [], LM.join_null_safe

    def seen(x, small, *how):
        joined.append("c_sum" in small.columns)
        return join(x, small, *how)

    monkeypatch.setattr(LM, "join_null_safe", seen)
    assert LM.forecast_lagged(reg, models, KEYS, 12).count() == 12
    assert sum(joined) == 1
