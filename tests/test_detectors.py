"""Properties of the detectors without an SQL form (SURVEY §5 (e))."""

import datetime as dt
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orbitlens.operators.detect import moving_average_anomaly
from orbitlens.operators.forest import isolation_forest_anomaly, isolation_score, rolling_isolation_forest
from orbitlens.operators.ocsvm import one_class_svm_anomaly
from orbitlens.sources.telemetry import events_telemetry
from orbitlens.streaming import telemetry as ST
from orbitlens.streaming.stateful import stateful_moving_average

KEYS = ["metric", "satellite"]
T0 = dt.datetime(2024, 1, 1)


def spike_frame(spark, n=300, spike_at=200, seed=5):
    rng = np.random.default_rng(seed)
    vals = np.round(rng.normal(10, 1, n), 3)
    vals[spike_at] = 60.0
    rows = [("m", "S", T0 + dt.timedelta(minutes=10 * i), float(v)) for i, v in enumerate(vals)]
    rows += [("m", "S2", T0 + dt.timedelta(minutes=10 * i), float(v) + 1) for i, v in enumerate(np.round(rng.normal(0, 1, n), 3))]
    pdf = pd.DataFrame(rows, columns=["metric", "satellite", "ts", "value"])
    return spark.createDataFrame(pdf, "metric string, satellite string, ts timestamp_ntz, value double")


def test_isolation_score_ranks_outlier_first():
    rng = np.random.default_rng(0)
    w = rng.normal(0, 1, (200, 1))
    s_in = isolation_score(w, np.array([0.1]), np.random.default_rng(1))
    s_out = isolation_score(w, np.array([8.0]), np.random.default_rng(1))
    assert s_out > s_in
    assert -0.5 <= s_in <= 0.5 and -0.5 <= s_out <= 0.5


def test_forest_spike_highest_and_repeatable_and_block_invariant(spark):
    df = spike_frame(spark)
    a = rolling_isolation_forest(df, KEYS, ["value"], window="1D", min_periods=5).toPandas()
    b = rolling_isolation_forest(df, KEYS, ["value"], window="1D", min_periods=5, block="5D").toPandas()
    a = a.sort_values(KEYS + ["ts"]).reset_index(drop=True)
    b = b.sort_values(KEYS + ["ts"]).reset_index(drop=True)
    assert len(a) == len(b) and np.allclose(a.iso_score, b.iso_score)  # same seeds, same windows
    s = a[a.satellite == "S"].set_index("ts")
    # in a fixed isolation tree every point beyond the training range follows
    # the same path, so any out-of-range point of a row's window scores near the
    # top; the spike must be among the highest few of all rows
    spike = T0 + dt.timedelta(minutes=2000)
    assert (s.iso_score > s.iso_score.loc[spike]).sum() < 5
    # every row with at least min_periods rows of history has a score
    assert len(s) == 300 - 5


def test_isolation_forest_anomaly_normalised(spark):
    df = spike_frame(spark)
    r = isolation_forest_anomaly(df, KEYS, ["value"], window="1D", min_periods=5, sigma=3).toPandas()
    s = r[r.satellite == "S"].set_index("ts").sort_index()
    spike = T0 + dt.timedelta(minutes=2000)
    assert s["value_iso_score"].loc[spike] > 1                      # flagged
    assert s["value_iso_score"].loc[spike] >= s["value_iso_score"].quantile(0.95)


def test_one_class_nu_fraction_and_spike(spark):
    df = spike_frame(spark)
    r = one_class_svm_anomaly(df, KEYS, ["value"], nu=0.1, gamma=0.5).toPandas()
    for sat, g in r.groupby("satellite"):
        frac = (g.ocsvm_score < 0).mean()
        assert abs(frac - 0.1) < 0.02, (sat, frac)
    s = r[r.satellite == "S"].set_index("ts")
    assert s.ocsvm_score.idxmin() == T0 + dt.timedelta(minutes=2000)


def test_stateful_stream_equals_batch_over_several_batches(spark):
    d = tempfile.mkdtemp(prefix="orbitlens-state-")
    t = events_telemetry(spark, SF_SMALL)
    for i, (lo, hi) in enumerate([("2024-01-01", "2024-01-09"), ("2024-01-09", "2024-01-18"), ("2024-01-18", "2024-02-01")]):
        t.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))) \
         .coalesce(1).write.parquet(f"{d}/in/p{i}")
    schema = spark.read.parquet(f"{d}/in/p0").schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(f"{d}/in")
    det = stateful_moving_average(stream, KEYS, window="1D", min_periods=3, watermark="1 hour")
    ST.run_available_now(det, f"{d}/out", f"{d}/ck")
    got = spark.read.parquet(f"{d}/out").toPandas().sort_values(KEYS + ["ts"]).reset_index(drop=True)
    exp = moving_average_anomaly(t, KEYS, ["value"], window="1D", min_periods=3).toPandas() \
        .sort_values(KEYS + ["ts"]).reset_index(drop=True)
    assert len(got) == len(exp)
    for c in ["value_ma_anomaly_score", "value_ma_upper_bound", "value_ma_lower_bound"]:
        assert np.allclose(got[c].astype(float), exp[c].astype(float), equal_nan=True, atol=1e-9), c


def test_forest_refit_every_slot_is_block_invariant_and_ranks_spike(spark):
    df = spike_frame(spark)
    a = rolling_isolation_forest(df, KEYS, ["value"], window="1D", min_periods=5, refit_every="6H").toPandas()
    b = rolling_isolation_forest(df, KEYS, ["value"], window="1D", min_periods=5, refit_every="6H",
                                 block="7D").toPandas()
    a = a.sort_values(KEYS + ["ts"]).reset_index(drop=True)
    b = b.sort_values(KEYS + ["ts"]).reset_index(drop=True)
    assert np.allclose(a.iso_score, b.iso_score)
    s = a[a.satellite == "S"].set_index("ts")
    assert (s.iso_score > s.iso_score.loc[T0 + dt.timedelta(minutes=2000)]).sum() < 5


def test_forest_is_a_fixed_function_once_seeded():
    from orbitlens.operators.forest import Forest
    rng = np.random.default_rng(2)
    f = Forest(rng.normal(0, 1, (300, 2)), seed=11)
    x = np.array([0.2, -0.1])
    assert f.score(x) == f.score(x)                                  # same trees for every call
    assert f.score(np.array([6.0, 6.0])) > f.score(x)                # outlier isolated sooner
    assert Forest(f.S[:, :, :].reshape(-1, 2)[:300], seed=11).score(x) == Forest(f.S[:, :, :].reshape(-1, 2)[:300], seed=11).score(x)


def test_forest_subsamples_and_sorted_paths():
    """A long window: subsamples without replacement, evenly spread, at a cost that does not follow the window; one
    feature's paths over sorted samples are those of the general way."""
    import time

    from orbitlens.operators.forest import Forest, _subsamples
    rng = np.random.default_rng(8)
    for n in (257, 1024, 1025, 3000, 200_000):
        idx = _subsamples(np.random.default_rng(1), n, 100, 256)
        assert idx.shape == (100, 256) and idx.min() >= 0 and idx.max() < n
        assert all(len(set(r)) == 256 for r in idx.tolist())
        assert abs(idx.mean() / (n - 1) - 0.5) < 0.02
    for n in (2, 5, 200, 256, 257, 900, 5000):
        w = np.round(rng.normal(0, 1, (n, 1)), 2)
        for x in (-9.0, 0.0, float(w[0, 0]), 0.3, 40.0):
            f = Forest(w, 77)
            fast = f.score(np.array([x]))
            f.V = None                                                         # the general way
            assert fast == f.score(np.array([x]))
    same = Forest(np.ones((500, 1)), 3)
    assert same.score(np.array([1.0])) == same.score(np.array([5.0]))
    w = rng.normal(0, 1, (1_000_000, 1))
    began = time.time()
    scores = [Forest(w, i).score(np.array([x])) for i in range(20) for x in (0.0, 8.0)]
    assert time.time() - began < 10 and min(scores[1::2]) > max(scores[::2])
