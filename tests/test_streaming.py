"""Streaming = batch on out-of-order multi-file arrivals; late data; replay."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orbitlens.operators.detect import moving_average_anomaly
from orbitlens.operators.stats import bucket_stats
from orbitlens.sources.telemetry import events_telemetry
from orbitlens.streaming import telemetry as ST

KEYS = ["metric", "satellite"]
DAY = 86_400_000_000


def _write_parts(spark, d, ranges):
    t = events_telemetry(spark, SF_SMALL)
    for i, (lo, hi) in enumerate(ranges):
        part = t.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(f"{d}/in/part{i}")
    return t


def _rows(df, cols):
    return sorted(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else v) for v in r)
                  for r in df.select(*cols).collect())


def test_tumbling_stream_equals_batch_closed_buckets(spark):
    d = tempfile.mkdtemp(prefix="orbitlens-st-")
    # files land out of order: the middle period first
    t = _write_parts(spark, d, [("2024-01-10", "2024-01-20"), ("2024-01-01", "2024-01-10"),
                                ("2024-01-20", "2024-02-01")])
    schema = spark.read.parquet(f"{d}/in/part0").schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(f"{d}/in")
    st = ST.tumbling_stats_stream(stream, KEYS, "1 hour", watermark="30 days")
    ST.run_available_now(st, f"{d}/out", f"{d}/ck")
    got = spark.read.parquet(f"{d}/out")
    mx = t.agg(F.max("ts")).first()[0]
    exp = bucket_stats(t, KEYS, "60T", keep_empty=False)
    import datetime as dt
    exp = exp.filter(F.col("bucket_end") <= F.lit(mx - dt.timedelta(days=30)))
    cols = KEYS + ["bucket_end", "mean", "count", "median", "std", "min", "max", "max_diff"]
    assert _rows(got, cols) == _rows(exp, cols)


def test_late_rows_behind_watermark_are_dropped(spark):
    d = tempfile.mkdtemp(prefix="orbitlens-late-")
    t = _write_parts(spark, d, [("2024-01-20", "2024-02-01")])
    schema = spark.read.parquet(f"{d}/in/part0").schema
    src = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{d}/in")
    ST.run_available_now(ST.tumbling_stats_stream(src(), KEYS, "1 hour", watermark="1 hour"), f"{d}/out", f"{d}/ck")
    n1 = spark.read.parquet(f"{d}/out").count()
    # a file of old rows arrives after the watermark moved past them
    t.filter(F.col("ts") < F.lit("2024-01-05").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{d}/in/late")
    ST.run_available_now(ST.tumbling_stats_stream(src(), KEYS, "1 hour", watermark="1 hour"), f"{d}/out", f"{d}/ck")
    out = spark.read.parquet(f"{d}/out")
    assert out.filter(F.col("bucket_end") < F.lit("2024-01-06").cast("timestamp_ntz")).count() == 0
    assert out.count() >= n1


def test_lookback_detector_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="orbitlens-lb-")
    t = _write_parts(spark, d, [("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"),
                                ("2024-01-15", "2024-02-01")])
    schema = spark.read.parquet(f"{d}/in/part0").schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(f"{d}/in")
    det = lambda x: moving_average_anomaly(x, KEYS, ["value"], window="1D", min_periods=3)
    fn = ST.lookback_detector(det, keys=KEYS, history_path=f"{d}/hist", out_path=f"{d}/out", lookback_us=3 * DAY)
    q = stream.writeStream.foreachBatch(fn).option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(f"{d}/out").drop("batch_id")
    exp = det(t)
    cols = KEYS + ["ts", "value_ma_anomaly_score", "value_ma_upper_bound"]
    assert got.count() == t.count()
    assert _rows(got, cols) == _rows(exp, cols)


@pytest.mark.parametrize("carry", [["_new"], []])
def test_lookback_detector_gives_one_row_per_row(spark, carry):
    """Four copies of every row, also of one without a time: four results each, not sixteen."""
    d = tempfile.mkdtemp(prefix="orbitlens-lb4-")
    t = spark.createDataFrame([("m", "S", f"2024-01-01 00:{i:02d}:00", float(i % 7)) for i in range(40)] + [("m", "S2", None, 1.0)],
                              "metric string, satellite string, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    t = t.crossJoin(spark.range(4)).drop("id")
    det = lambda x: moving_average_anomaly(x, KEYS, ["value"], window="1D", min_periods=3, carry=[c for c in carry if c in x.columns])
    fn = ST.lookback_detector(det, keys=KEYS, history_path=f"{d}/hist", out_path=f"{d}/out", lookback_us=3 * DAY)
    fn(t, 0)
    got = spark.read.parquet(f"{d}/out/batch_id=0")
    cols = KEYS + ["ts", "value_ma_anomaly_score", "value_ma_upper_bound"]
    assert got.count() == 164
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, det(t).select(*cols).collect()))
    if carry:                                            # a later row at a known time: only itself
        fn(t.where("ts = TIMESTAMP_NTZ '2024-01-01 00:39:00'").limit(1), 1)
        assert spark.read.parquet(f"{d}/out/batch_id=1").count() == 1


def test_idempotent_replay(spark):
    d = tempfile.mkdtemp(prefix="orbitlens-idem-")
    w = ST.idempotent_batch_writer(f"{d}/out")
    df = events_telemetry(spark, SF_SMALL)
    w(df, 7)
    w(df, 7)  # the same batch replayed after a failure
    out = spark.read.parquet(f"{d}/out")
    assert out.count() == df.count()
    assert ST.dedup_latest(out, KEYS).count() == df.count()


def test_stateful_frames_equal_a_plain_loop():
    """The frames of all new points at once, late ones among known ones, against one point after the other."""
    import time

    import numpy as np

    from orbitlens.streaming.stateful import _frame_stats
    rng = np.random.default_rng(4)
    t = np.sort(rng.integers(-300, 5000, 700))
    x = np.round(rng.normal(3, 1, 700), 2)
    x[100:130], x[rng.integers(0, 700, 60)], x[300] = 0.1, np.nan, np.inf
    rows = np.flatnonzero(rng.random(700) < 0.7)
    mean, std = _frame_stats(t, x, rows, 97, 3)
    for i, m, s in zip(rows, mean, std):
        seg = x[:i][t[:i] > t[i - 1] - 97] if i else x[:0]
        seg = seg[np.isfinite(seg)]
        want = (seg.mean(), seg.std(ddof=1)) if len(seg) >= 3 else (np.nan, np.nan)
        assert np.allclose((m, s), want, rtol=1e-10, atol=1e-12, equal_nan=True)
    # rows without a time come first, as the smallest number, and open no frame
    mean, _ = _frame_stats(np.array([-2**63] * 4 + [10, 11]), np.arange(6.0), np.arange(6), 97, 1)
    assert np.isnan(mean[:5]).all() and mean[5] == 4.0
    # a window of 400,000 points costs no more a point than one of ten
    many = np.arange(400_000)
    began = time.time()
    mean, _ = _frame_stats(many, np.ones(400_000), many, 300_000, 5)
    assert np.nanmax(mean) == 1.0 and time.time() - began < 20


def test_bounds_join_keeps_its_state_on_disk(spark, tmp_path, monkeypatch):
    """Rows of one time meet in pairs, null series and null values included, and the state is not in the heap."""
    import datetime as dt
    import json
    import random
    import shutil

    from orbitlens.plans import q_streaming as QS
    rng, t0 = random.Random(4), dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=rng.randrange(3000)), None if i % 50 == 0 else rng.randrange(9),
             rng.choice(["a", "b", None]), None if i % 40 == 0 else round(rng.uniform(0, 50), 2)) for i in range(600)]
    rows += rows[:30]                                            # rows that come twice
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    df.coalesce(1).write.parquet(str(tmp_path / "made"))
    (tmp_path / "sf").mkdir()
    shutil.copy(next((tmp_path / "made").glob("part-*.parquet")), tmp_path / "sf" / "events.parquet")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    monkeypatch.setattr(ST, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = sorted(map(str, QS.q_stream_bounds_join(spark, str(tmp_path / "sf")).collect()))
    t = events_telemetry(spark, str(tmp_path / "sf"))
    b = spark.read.parquet(str(tmp_path / "stream-bounds" / "bounds"))
    on = [t[k].eqNullSafe(b[k]) for k in KEYS] + [t.ts == b.ts]
    score = F.round(F.greatest(b.lb - t.value, t.value - b.ub) + 1e-9, 4)
    want = sorted(map(str, t.join(b, on).select(t.metric, t.satellite, t.ts, score.alias("bounds_score")).collect()))
    assert len(got) > 600 and "metric=None" in "".join(got) and got == want
    kept = json.loads((tmp_path / "stream-bounds" / "ckpt" / "offsets" / "0").read_text().splitlines()[1])["conf"]
    assert kept[key].endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(key) == before
