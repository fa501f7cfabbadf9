"""Whole-series transforms, the zero-phase filter and the peak search over blocks, against plain loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orbitlens.forecast import features as FT
from orbitlens.forecast import lowpass as LP
from orbitlens.forecast import seasonality as SE
from orbitlens.forecast import spectrum as SP

KEYS = ["metric", "satellite"]


def regular(spark, series):
    rows = [("m", s, i, float(v)) for s, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=[*KEYS, "idx", "value"]), "metric string, satellite string, idx long, value double").repartition(5)


def random_series(seed=0):
    rng = np.random.default_rng(seed)
    sizes = {"one": 1, "two": 2, "three": 3, "prime": 997, "even": 1000, "power": 64, "long": 20_000}
    return {k: np.sin(2 * np.pi * np.arange(n) / 11) + rng.normal(0, 0.3, n).cumsum() + 5 for k, n in sizes.items()}


@pytest.mark.parametrize("block", [64, 1 << 16])
def test_transforms_equal_direct_sums(spark, block):
    series = random_series()
    series[None] = series["prime"] * 2                                # a null tag is a series
    reg = regular(spark, series)
    acf = FT.autocorrelation(reg, KEYS, block=block).toPandas()
    spec = FT.periodogram(reg, KEYS, block=block).toPandas()
    for name, y in series.items():
        n, z = len(y), y - y.mean()
        of = lambda d: d[d.satellite.isna() if name is None else d.satellite == name]
        g = of(acf).sort_values("lag")
        if n == 1:
            assert not len(g)
        else:
            assert g.lag.tolist() == list(range(n))
            assert np.allclose(g.acf, np.correlate(z, z, "full")[n - 1:] / (z @ z), atol=1e-10)
        g = of(spec).sort_values("k")
        assert g.k.tolist() == list(range(1, (n - 1) // 2 + 1))
        want = np.abs(np.fft.fft(y))[1:(n - 1) // 2 + 1]
        assert np.allclose(g.magnitude, want, atol=1e-7 * max(1, np.abs(y).sum()))


def test_constant_series_has_no_autocorrelation(spark):
    reg = regular(spark, {"flat": np.ones(50), "x": np.arange(50.0)})
    assert {r.satellite for r in FT.autocorrelation(reg, KEYS).select("satellite").distinct().collect()} == {"x"}
    assert FT.autocorrelation(reg.limit(0), KEYS).count() == 0 and FT.periodogram(reg.limit(0), KEYS).count() == 0


def plain_filter(x, period):
    """Two second-order sections, sample by sample, forward and backward over the mirrored series."""
    warped = 4 * np.tan(np.pi / period / 2)
    poles = warped * np.exp(1j * np.pi * (2 * np.arange(4) + 5) / 8)
    z = (4 + poles) / (4 - poles)
    gain = (warped ** 4 / np.prod(4 - poles)).real
    sections = [(gain if i == 0 else 1.0, -2 * p.real, abs(p) ** 2) for i, p in enumerate(z[z.imag > 0])]

    def once(v):
        level = v[0]
        for g, a1, a2 in sections:
            gain1 = 4 * g / (1 + a1 + a2)
            s2 = (g - a2 * gain1) * level
            s1 = (2 * g - a1 * gain1) * level + s2
            out = np.empty(len(v))
            for i, q in enumerate(v):
                o = g * q + s1
                s1, s2 = 2 * g * q - a1 * o + s2, g * q - a2 * o
                out[i] = o
            v, level = out, level * gain1
        return v

    pad = 15
    ext = np.concatenate([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2:-pad - 2:-1]])
    return once(once(ext)[::-1])[::-1][pad:-pad]


@pytest.mark.parametrize("period", [2, 7, 60, 900])
def test_low_pass_equals_a_plain_loop(spark, period):
    series = {k: y for k, y in random_series(period).items() if k in ("prime", "power", "long")}
    series["edge"] = random_series(1)["long"][:SP.CURVE + 5]              # the last block is shorter than the mirror
    blocks = SP.series_blocks(regular(spark, series), KEYS)
    out = LP.low_pass(blocks.withColumn("period", F.lit(period).cast("long")), KEYS).toPandas()
    for name, y in series.items():
        g = out[out.satellite == name].sort_values("blk")
        assert np.allclose(np.concatenate(g.x.tolist()), plain_filter(y, period), atol=1e-6 * max(1, np.abs(y).max()))


def plain_peaks(x):
    out, i = [], 1
    while i < len(x) - 1:
        z = i
        while z + 1 < len(x) and x[z + 1] == x[i]:
            z += 1
        if x[i] > x[i - 1] and z + 1 < len(x) and x[z + 1] < x[i]:
            out.append((i + z) // 2)
        i = z + 1
    return out


def plain_prominence(x, p):
    low = []
    for step in (-1, 1):
        i, m = p, x[p]
        while 0 <= i < len(x) and x[i] <= x[p]:
            m = min(m, x[i])
            i += step
        low.append(m)
    return x[p] - max(low)


def plain_spaced(x, peaks, distance):
    keep = []
    for p in sorted(peaks, key=lambda i: (x[i], i), reverse=True):
        if all(abs(p - q) >= distance for q in keep):
            keep.append(p)
    return sorted(keep)


@pytest.mark.parametrize("size", [16, 300, SE.CURVE])
def test_peak_search_over_blocks(spark, size):
    rng = np.random.default_rng(size)
    series = {f"s{i}": rng.normal(0, 1, 700).cumsum() for i in range(3)} | {"small": np.array([0, 1, 0, 2, 2, 0, 3, 1, 0.5, 0.6, 0.0])}
    curve = regular(spark, series)
    blocks = SE.curve_blocks(curve, KEYS, "idx", "value", size)
    found = SE.peaks(blocks, KEYS, size)
    kept = SE.spaced_peaks(found.withColumn("distance", F.lit(9).cast("long")), KEYS)
    prom = SE.prominences(blocks, kept, KEYS, size)
    rows = {(r.satellite, r.place): r.prominence for r in prom.collect()}
    want = {}
    for s, x in series.items():
        peaks = plain_peaks(x)
        assert sorted(r.place for r in found.where(F.col("satellite") == s).collect()) == (peaks if s != "small" or size > 16 else peaks)
        want |= {(s, p): plain_prominence(x, p) for p in plain_spaced(x, peaks, 9)}
    assert rows.keys() == want.keys() and all(abs(rows[k] - v) < 1e-12 for k, v in want.items())


def test_long_periods_are_found(spark):
    """A period of 600 in 3,300 points by the autocorrelation, one of 11 in 13,200 points by the spectrum."""
    rng = np.random.default_rng(7)
    t = np.arange(13_200)
    reg = regular(spark, {"p600": np.sin(2 * np.pi * np.arange(3_300) / 600) + rng.normal(0, 0.1, 3_300),
                          "p11": np.sin(2 * np.pi * t / 11) + rng.normal(0, 0.2, len(t))})
    lags = SE.acf_peak_lags(FT.autocorrelation(reg.where("satellite = 'p600'"), KEYS), KEYS, nlags=5).toPandas()
    assert any(abs(x - 600) <= 5 for x in lags.lag), lags
    periods = SE.fft_period_lags(reg, KEYS).toPandas()
    assert periods[(periods.satellite == "p11") & (periods["round"] == 1)].lag.tolist() == [11]
