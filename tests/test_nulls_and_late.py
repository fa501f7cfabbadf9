"""NULL values, NULL tags, late points and session zones."""

import datetime as dt
import re
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orbitlens.functions.time import to_epoch_ms
from orbitlens.operators.detect import bounds_anomaly
from orbitlens.operators.forest import rolling_isolation_forest
from orbitlens.operators.ocsvm import one_class_svm_anomaly
from orbitlens.operators.resample import resample_first
from orbitlens.operators.stats import bucket_stats
from orbitlens.sources.state import read_since
from orbitlens.streaming import telemetry as ST
from orbitlens.streaming.stateful import stateful_moving_average

KEYS = ["metric", "satellite"]
SCHEMA = "metric string, satellite string, ts timestamp_ntz, value double"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def frame(spark, rows):
    return spark.createDataFrame([("m", s, t, v) for s, t, v in rows], SCHEMA)


def test_statistics_count_null_rows_of_a_bucket(spark):
    df = frame(spark, [("S", at(0), 1.0), ("S", at(1), None), ("S", at(2), 5.0), ("S", at(61), None)])
    first, second = bucket_stats(df, KEYS, "60T").orderBy("bucket_end").collect()
    assert first["count"] == 2 and first["mean"] == 3.0 and first["median"] == 3.0
    assert first["energy"] == pytest.approx(26 / 3) and first["max_diff"] is None
    assert second["count"] == 0 and second["energy"] == 0.0 and second["mean"] is None


def test_resample_keeps_null_buckets_at_both_ends(spark):
    values = [None, None, 7.0, None, 9.0, None]
    df = frame(spark, [("S", at(10 * i), v) for i, v in enumerate(values)] + [("S", at(80), None), (None, at(0), None)])
    rows = resample_first(df, KEYS, "10T").where("satellite = 'S'").orderBy("ts").collect()
    assert [r["value"] for r in rows] == [7.0, 7.0, 7.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0]
    bare = resample_first(df, KEYS, "10T", fill=False).where("satellite = 'S'").orderBy("ts").collect()
    assert [r["value"] for r in bare] == [None, None, 7.0, None, 9.0, None, None, None, None]
    assert [r["value"] for r in resample_first(df, KEYS, "10T").where("satellite is null").collect()] == [None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_ms_has_no_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' a, '2024-03-10 02:30:00' b, date'2024-03-10' c, 'no time' d") \
            .select(*[to_epoch_ms(c).alias(c) for c in "abcd"]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    night = int(dt.datetime(2024, 3, 10, 2, 30, tzinfo=dt.timezone.utc).timestamp()) * 1000
    assert (row["a"], row["b"], row["c"], row["d"]) == (night, night, night - 9_000_000, None)


def marks(spark, rows):
    return spark.createDataFrame([("p", "o", "m", s, t) for s, t in rows],
                                 "pipeline string, output string, metric string, satellite string, ts timestamp_ntz")


def test_read_since_prunes_by_a_literal_and_finds_null_tags(spark, tmp_path):
    df = frame(spark, [(s, at(60 * i), float(i)) for s in ("S", "new", None) for i in range(100)])
    df.write.parquet(f"{tmp_path}/t")
    got = read_since(spark.read.parquet(f"{tmp_path}/t"), marks(spark, [("S", at(6000)), (None, at(3000))]), KEYS, at(5940),
                     pipeline="p", output="o", default_lookback="10H")
    n = {r["satellite"]: r["count"] for r in got.groupBy("satellite").count().collect()}
    assert n == {"new": 11, None: 50}          # S is marked behind its last row
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-03T02:00" in pushed
    none = read_since(spark.read.parquet(f"{tmp_path}/t"), marks(spark, []), KEYS, at(5940), pipeline="p", output="o")
    assert none.groupBy("satellite").count().select("count").distinct().collect() == [(25,)]


def test_null_tag_keeps_its_scores(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, [(s, at(10 * i), float(v)) for s in ("S", None) for i, v in enumerate(rng.normal(0, 1, 50))])
    svm = one_class_svm_anomaly(df, KEYS, ["value"]).groupBy("satellite").agg(F.count("ocsvm_score").alias("n")).collect()
    assert sorted((r["satellite"] or "", r["n"]) for r in svm) == [("", 50), ("S", 50)]
    bounds = df.select(*KEYS, "ts", F.lit(-1.0).alias("LB"), F.lit(1.0).alias("UB"))
    assert bounds_anomaly(df, bounds, KEYS).count() == 100


def test_forest_refit_does_not_depend_on_uneven_blocks(spark):
    rng = np.random.default_rng(4)
    df = frame(spark, [("S", at(10 * i), float(v)) for i, v in enumerate(rng.normal(0, 1, 260))])
    runs = [rolling_isolation_forest(df, KEYS, ["value"], window="7H", min_periods=5, refit_every="5H", block=b)
            .toPandas().sort_values("ts")["iso_score"].to_numpy() for b in (None, "11H", "30D")]
    assert len(runs[0]) == 255
    assert np.allclose(runs[0], runs[2]) and np.allclose(runs[1], runs[2])


def test_points_late_within_the_watermark_are_scored(spark):
    d = tempfile.mkdtemp(prefix="orbitlens-late-")
    rng = np.random.default_rng(2)
    rows = [("S", at(10 * i), float(v)) for i, v in enumerate(rng.normal(0, 1, 120))]
    late = rows[35:40] + [("S", rows[60][1], 0.5)]               # the last one has the time of a known point
    batches = [rows[:35] + rows[40:61], late, rows[61:]]
    for i, part in enumerate(batches):
        frame(spark, part).coalesce(1).write.parquet(f"{d}/in/p{i}")
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1) \
        .option("latestFirst", "false").parquet(f"{d}/in")
    det = stateful_moving_average(stream, KEYS, window="6H", min_periods=3, watermark="1 day")
    ST.run_available_now(det, f"{d}/out", f"{d}/ck")
    out = spark.read.parquet(f"{d}/out").toPandas()
    assert len(out) == 121 and (out["ts"] == pd.Timestamp(rows[60][1])).sum() == 2
    assert out.sort_values("ts")["value_ma_upper_bound"].notna().sum() > 110


def test_outer_merge_and_exogenous_fill_keep_null_tags(spark):
    from orbitlens.operators.joins import merge_exogenous
    history = frame(spark, [(s, at(60 * i), float(i)) for s in ("S", None) for i in range(3)]).withColumnRenamed("value", "y")
    future = frame(spark, [(s, at(60 * i), float(10 * i)) for s in ("S", None) for i in (1, 4)]).withColumnRenamed("value", "x")
    got = merge_exogenous(history, future, KEYS, ["x"]).where("satellite is null").orderBy("ts").collect()
    assert [(r["y"], r["x"]) for r in got] == [(0.0, 10.0), (1.0, 10.0), (2.0, 10.0), (None, 40.0)]
    tiled = merge_exogenous(history, future, KEYS, ["x"], block_us=7_200_000_000).where("satellite = 'S'").orderBy("ts").collect()
    assert [r["x"] for r in tiled] == [10.0, 10.0, 10.0, 40.0]
