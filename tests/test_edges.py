"""Edge fixtures against pandas semantics (the reference's numerics)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orbitlens.operators.detect import moving_average_anomaly
from orbitlens.operators.resample import fill_gaps, resample_first
from orbitlens.operators.stats import bucket_stats
from orbitlens.operators.windows import rolling_stats

KEYS = ["metric", "satellite"]
T0 = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    pdf = pd.DataFrame(rows, columns=["metric", "satellite", "ts", "value"])
    return spark.createDataFrame(pdf, "metric string, satellite string, ts timestamp_ntz, value double")


def edge_rows():
    rows = []
    # hour 0: 1 row, hour 1: 2 rows, hour 2: empty, hour 3: 3 rows, hour 4: 4 flat rows, hour 5: 5 rows
    minutes = {0: [5], 1: [1, 30], 3: [2, 3, 59], 4: [0, 10, 20, 30], 5: [1, 2, 3, 4, 5]}
    rng = np.random.default_rng(7)
    for h, ms in minutes.items():
        for m in ms:
            v = 2.5 if h == 4 else float(np.round(rng.normal(10, 3), 2))
            rows.append(("m1", "SAT1", T0 + dt.timedelta(hours=h, minutes=m), v))
    # a second series with the same timestamps (no leakage between series)
    rows += [("m1", "SAT2", r[2], r[3] * 2) for r in rows]
    return rows


def hourly_rows(pdf):
    """The statistics from their definitions, hour by hour."""
    hours = np.array([int((t - T0).total_seconds() // 3600) for t in pdf["ts"]])
    values = pdf["value"].to_numpy()
    rows = {}
    for hour in range(hours.min(), hours.max() + 1):
        v = values[hours == hour]
        n, row = len(v), dict.fromkeys(("mean", "median", "std", "skew", "min", "max", "energy", "kurt", "max_diff"), np.nan)
        row["count"] = n
        if n:
            d = v - v.sum() / n
            m2, m3, m4 = ((d ** k).sum() / n for k in (2, 3, 4))
            row |= {"mean": v.sum() / n, "median": np.sort(v)[[(n - 1) // 2, n // 2]].mean(), "min": v.min(), "max": v.max(),
                    "energy": (v * v).sum() / n}
            if n > 1:
                row |= {"std": np.sqrt(m2 * n / (n - 1)), "max_diff": max(abs(b - a) for a, b in zip(v, v[1:]))}
            if n > 2:
                row["skew"] = np.sqrt(n * (n - 1)) / (n - 2) * m3 / m2 ** 1.5 if m2 > 1e-14 else 0.0
            if n > 3:
                row["kurt"] = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * m4 / m2 ** 2 - 3 * (n - 1)) if m2 > 1e-14 else 0.0
        rows[T0 + dt.timedelta(hours=hour + 1)] = row
    return pd.DataFrame.from_dict(rows, orient="index")


def test_bucket_stats_matches_pandas(spark):
    rows = edge_rows()
    got = bucket_stats(frame(spark, rows), KEYS, "60T").toPandas()
    for sat in ["SAT1", "SAT2"]:
        pdf = pd.DataFrame([r for r in rows if r[1] == sat], columns=["metric", "satellite", "ts", "value"])
        exp = hourly_rows(pdf)
        g = got[got.satellite == sat].set_index("bucket_end").sort_index()
        assert list(g.index) == list(exp.index)
        for c in exp.columns:
            a, b = g[c].astype(float).to_numpy(), exp[c].astype(float).to_numpy()
            assert np.allclose(a, b, equal_nan=True, atol=1e-9), (sat, c, a, b)


def frames_before(times, values, window, least):
    """(mean, deviation) over the rows in (t - window, t] of the PREVIOUS row's t; nan under ``least`` values."""
    mean, spread = np.full(len(values), np.nan), np.full(len(values), np.nan)
    for i in range(1, len(values)):
        inside = [values[j] for j in range(i) if times[i - 1] - window < times[j] <= times[i - 1] and not np.isnan(values[j])]
        if len(inside) >= least:
            mean[i] = np.mean(inside)
            spread[i] = np.std(inside, ddof=1) if len(inside) > 1 else np.nan
    return mean, spread


def bands(s, window, least, sigma, delta):
    """Score and bands of the moving-average detector, row by row."""
    times, values = list(s.index), s.to_numpy()
    centre, _ = frames_before(times, values, pd.Timedelta(window), least)
    off = np.abs(values - centre)
    usual, spread = frames_before(times, off, pd.Timedelta(window), least)
    reach = usual + delta + sigma * (spread + 1e-8)
    return (off - usual - delta) / (spread + 1e-8) / sigma, centre + reach, centre - reach


@pytest.mark.parametrize("tile", [None, 8 * 3600 * 1_000_000])
def test_moving_average_matches_pandas_with_gaps(spark, tile):
    rng = np.random.default_rng(3)
    times = sorted(set(int(x) for x in rng.integers(0, 10 * 24 * 60, 400)))
    # a gap longer than the window
    times = [t for t in times if not (3000 < t < 5000)]
    vals = np.round(rng.normal(0, 1, len(times)), 3)
    vals[50] = 25.0  # injected spike
    rows = [("m", "S", T0 + dt.timedelta(minutes=t), float(v)) for t, v in zip(times, vals)]
    df = frame(spark, rows)
    got = moving_average_anomaly(df, KEYS, ["value"], window="6H", min_periods=3, sigma=3, delta=0.01,
                                 tile_us=tile).toPandas().set_index("ts").sort_index()
    s = pd.Series(vals, index=pd.DatetimeIndex([r[2] for r in rows]))
    score, up, lo = bands(s, "6h", 3, 3, 0.01)
    assert np.allclose(got["value_ma_anomaly_score"].astype(float), score, equal_nan=True, atol=1e-7)
    assert np.allclose(got["value_ma_upper_bound"].astype(float), up, equal_nan=True, atol=1e-7)
    assert np.allclose(got["value_ma_lower_bound"].astype(float), lo, equal_nan=True, atol=1e-7)
    # the spike is flagged and has the highest score
    assert got["value_ma_anomaly"].iloc[50] == 25.0
    assert got["value_ma_anomaly_score"].astype(float).idxmax() == got.index[50]


@pytest.mark.parametrize("tile", [None, 6 * 3600 * 1_000_000])
def test_rolling_matches_pandas(spark, tile):
    rng = np.random.default_rng(11)
    times = sorted(set(int(x) for x in rng.integers(0, 3 * 24 * 3600, 300)))
    vals = np.round(rng.normal(5, 2, len(times)), 2)
    rows = [("m", "S", T0 + dt.timedelta(seconds=t), float(v)) for t, v in zip(times, vals)]
    got = rolling_stats(frame(spark, rows), KEYS, "value", "2H", min_periods=4, shift=1,
                        tile_us=tile).toPandas().set_index("ts").sort_index()
    s = pd.Series(vals, index=pd.DatetimeIndex([r[2] for r in rows]))
    r = s.rolling("2h", min_periods=4)
    assert np.allclose(got["value_mean"].astype(float), r.mean().shift(1), equal_nan=True)
    assert np.allclose(got["value_std"].astype(float), r.std().shift(1), equal_nan=True)


def test_resample_first_and_fill_match_pandas(spark):
    rows = [("m", "S", T0 + dt.timedelta(seconds=s), v) for s, v in
            [(3, 1.0), (7, 2.0), (41, None), (44, 4.0), (95, 5.0), (96, 6.0)]]
    got = resample_first(frame(spark, rows), KEYS, "10s").toPandas().set_index("ts").sort_index()
    pdf = pd.DataFrame({"value": [r[3] for r in rows]}, index=pd.DatetimeIndex([r[2] for r in rows]))
    exp = pdf.resample("10s").first().bfill().ffill()
    assert list(got.index) == list(exp.index)
    assert np.allclose(got["value"].astype(float), exp["value"])


@pytest.mark.parametrize("block", [None, 3 * 1_000_000])
def test_fill_gaps_nulls_at_edges(spark, block):
    vals = [None, None, 1.0, None, 3.0, None, None, 7.0, None, None]
    rows = [("m", "S", T0 + dt.timedelta(seconds=i), v) for i, v in enumerate(vals)]
    got = fill_gaps(frame(spark, rows), KEYS, ["value"], block_us=block).toPandas().sort_values("ts")
    exp = pd.Series(vals, dtype=float).bfill().ffill()
    assert got["value"].tolist() == exp.tolist()
    got2 = fill_gaps(frame(spark, rows), KEYS, ["value"], order="ffill_bfill", block_us=block).toPandas().sort_values("ts")
    assert got2["value"].tolist() == pd.Series(vals, dtype=float).ffill().bfill().tolist()


def test_flat_bucket_skew_kurt_zero(spark):
    rows = [("m", "S", T0 + dt.timedelta(minutes=i), 4.0) for i in range(6)]
    got = bucket_stats(frame(spark, rows), KEYS, "60T").toPandas()
    assert got["skew"].iloc[0] == 0.0 and got["kurt"].iloc[0] == 0.0 and got["std"].iloc[0] == 0.0


@pytest.mark.parametrize("tile", [None, 3 * 3600 * 1_000_000])
def test_rolling_sums_method_matches_pandas_with_flat_runs_and_nulls(spark, tile):
    rng = np.random.default_rng(21)
    times = sorted(set(int(x) for x in rng.integers(0, 2 * 24 * 3600, 400)))
    vals = np.round(rng.normal(1000, 5, len(times)), 2)
    vals[100:160] = 1000.0          # a flat run longer than the window
    vals[200] = np.nan               # nulls inside
    vals[201] = np.nan
    times = [t for t in times if not (80_000 < t < 95_000)]  # and a gap
    vals = vals[:len(times)]
    rows = [("m", "S", T0 + dt.timedelta(seconds=t), None if np.isnan(v) else float(v)) for t, v in zip(times, vals)]
    got = rolling_stats(frame(spark, rows), KEYS, "value", "1H", min_periods=3, shift=1, tile_us=tile,
                        method="sums").toPandas().set_index("ts").sort_index()
    s = pd.Series(vals, index=pd.DatetimeIndex([r[2] for r in rows]))
    r = s.rolling("1h", min_periods=3)
    assert np.allclose(got["value_mean"].astype(float), r.mean().shift(1), equal_nan=True, atol=1e-9)
    assert np.allclose(got["value_std"].astype(float), r.std().shift(1), equal_nan=True, atol=1e-7)
    flat = got["value_std"].iloc[130:160].astype(float)
    assert (flat == 0.0).all()


def test_tiled_operators_keep_series_with_null_tags(spark):
    from orbitlens.operators.windows import diff
    rng = np.random.default_rng(4)
    rows = []
    for sat in ["SAT1", None]:
        for i in range(200):
            rows.append(("m", sat, T0 + dt.timedelta(minutes=17 * i), float(np.round(rng.normal(5, 1), 2))))
    df = frame(spark, rows)
    a = rolling_stats(df, KEYS, "value", "6H", min_periods=2, shift=1).toPandas()
    b = rolling_stats(df, KEYS, "value", "6H", min_periods=2, shift=1, tile_us=8 * 3600 * 1_000_000).toPandas()
    c = rolling_stats(df, KEYS, "value", "6H", min_periods=2, shift=1, tile_us=8 * 3600 * 1_000_000,
                      method="sums").toPandas()
    key = lambda d: d.assign(satellite=d.satellite.fillna("~")).sort_values(["satellite", "ts"]).reset_index(drop=True)
    a, b, c = key(a), key(b), key(c)
    assert len(a) == len(b) == len(c) == 400
    for col in ["value_mean", "value_std"]:
        assert np.allclose(a[col].astype(float), b[col].astype(float), equal_nan=True)
        assert np.allclose(a[col].astype(float), c[col].astype(float), equal_nan=True, atol=1e-9)
    d1 = key(diff(df, KEYS, "value").toPandas())
    d2 = key(diff(df, KEYS, "value", block_us=3600 * 1_000_000).toPandas())
    assert np.allclose(d1.value_diff.astype(float), d2.value_diff.astype(float), equal_nan=True)
    f1 = key(fill_gaps(df, KEYS, ["value"]).toPandas())
    f2 = key(fill_gaps(df, KEYS, ["value"], block_us=3600 * 1_000_000).toPandas())
    assert np.allclose(f1.value.astype(float), f2.value.astype(float))


def test_grid_guard_raises_instead_of_exploding(spark):
    rows = [("m", "S", T0, 1.0), ("m", "S", T0 + dt.timedelta(days=30), 2.0)]
    df = frame(spark, rows)
    assert resample_first(df, KEYS, "10s", max_buckets_per_series=1_000_000).count() == 30 * 8640 + 1
    with pytest.raises(Exception, match="time grid exceeds"):
        resample_first(df, KEYS, "10s", max_buckets_per_series=1000).count()


def test_epoch_conversion_is_zone_free(spark):
    from orbitlens.functions.time import epoch_us, from_epoch_us
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["America/New_York", "Europe/London", "UTC"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-11-03 01:30:00",), ("1995-07-01 12:00:00",),
                                        ("1969-12-31 23:59:59.5",)], "s string") \
                .select(F.col("s").cast("timestamp_ntz").alias("ts"))
            r = df.select("ts", epoch_us("ts").alias("us")).withColumn("back", from_epoch_us("us")).collect()
            assert [x.us for x in r] == [1710037800000000, 1730597400000000, 804600000000000, -500000], tz
            assert all(x.back == x.ts for x in r), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("tile", [None, 5 * 3600 * 1_000_000])
def test_rolling_frame_keeps_odd_values_apart(spark, tile):
    """Large, flat, missing, equal-time and infinite values: each counts in its own frames and in no other."""
    rng = np.random.default_rng(5)
    secs = sorted(int(x) for x in rng.integers(0, 2 * 24 * 360, 500) * 10)
    vals = np.round(rng.normal(5, 2, len(secs)), 2)
    vals[40:60] = 1e15
    vals[200:260] = 0.1
    vals[300] = np.inf
    missing = {310, 311, 312, 313, 420}
    rows = [("m", "S", T0 + dt.timedelta(seconds=s), None if i in missing else float(v)) for i, (s, v) in enumerate(zip(secs, vals))]
    stats = ("mean", "std", "sum", "count", "min", "max")
    got = rolling_stats(frame(spark, rows), KEYS, "value", "1H", min_periods=2, stats=stats, tile_us=tile).toPandas()
    assert len(got) == len(rows)
    for t, *seen in got[["ts"] + [f"value_{s}" for s in stats]].itertuples(index=False):
        own = [r[3] for r in rows if t - dt.timedelta(hours=1) < r[2] <= t and r[3] is not None]
        if len(own) < 2:
            assert all(pd.isna(v) for v in seen)
        else:
            with np.errstate(invalid="ignore"):
                want = [np.mean(own), 0.0 if min(own) == max(own) else np.std(own, ddof=1), np.sum(own), len(own), min(own), max(own)]
            assert np.allclose(seen, want, rtol=1e-9, atol=1e-9, equal_nan=True), (t, seen, want)
