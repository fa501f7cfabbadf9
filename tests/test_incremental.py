"""Incremental runs (P1 + K9 + S12): consecutive runs neither overlap nor
leave a hole, and together equal one batch computation."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from orbitlens.operators.stats import bucket_stats
from orbitlens.plans import pipelines as P
from orbitlens.sources.telemetry import events_telemetry

KEYS = ["metric", "satellite"]


def test_two_runs_chain_through_marks(spark):
    d = tempfile.mkdtemp(prefix="orbitlens-inc-")
    t = events_telemetry(spark, SF_SMALL)
    schema = "pipeline string, output string, metric string, satellite string, ts timestamp_ntz"
    marks = spark.createDataFrame([], schema)
    # run 1 at day 10 (no marks: starts at now - 24 h, aligned to the hour)
    # each run sees only the data that has arrived by its "now"
    now1 = "2024-01-10 12:00:00"
    t1 = t.filter(F.col("ts") <= F.lit(now1).cast("timestamp_ntz"))
    P.run_and_commit(P.aggregation(t1, marks, KEYS, now1), P.aggregation_marks(t1, marks, KEYS, now1),
                     out_path=f"{d}/out", marks_path=f"{d}/marks1")
    marks1 = spark.read.parquet(f"{d}/marks1")
    # run 2 at day 20 reads from the stored marks
    now2 = "2024-01-20 12:00:00"
    t2 = t.filter(F.col("ts") <= F.lit(now2).cast("timestamp_ntz"))
    P.run_and_commit(P.aggregation(t2, marks1, KEYS, now2), P.aggregation_marks(t2, marks1, KEYS, now2),
                     out_path=f"{d}/out", marks_path=f"{d}/marks2")
    out = spark.read.parquet(f"{d}/out").drop("date")
    # no (series, ts) written twice
    dup = out.groupBy("metric", "satellite", "ts").count().filter("count > 1").count()
    assert dup == 0
    # For series that received a mark in run 1, run 2 continues exactly at the
    # mark: the mean rows of both runs equal one batch computation from the
    # series' first written bucket to its run-2 mark.  (A series without a
    # mark starts at now - 24 h, the default mark, as in the reference.)
    m1 = spark.read.parquet(f"{d}/marks1").select(*KEYS)
    m2 = spark.read.parquet(f"{d}/marks2").select(*KEYS, F.col("ts").alias("_m2"))
    got = (out.filter(F.col("metric").endswith("_agg_mean_60T"))
           .withColumn("metric", F.regexp_replace("metric", "_agg_mean_60T$", ""))
           .join(m1, on=KEYS))
    first = got.groupBy(*KEYS).agg(F.min("ts").alias("_lo"))
    exp = (bucket_stats(t2, KEYS, "60T").join(first, on=KEYS).join(m2, on=KEYS)
           .filter((F.col("bucket_end") >= F.col("_lo")) & (F.col("bucket_end") <= F.col("_m2"))
                   & F.col("mean").isNotNull()))
    g = sorted((r.metric, r.satellite, r.ts, round(r.value, 9)) for r in got.collect())
    e = sorted((r.metric, r.satellite, r.bucket_end, round(r.mean, 9)) for r in exp.collect())
    assert len(g) > 0 and g == e


def test_marks_of_silent_series_and_other_pipelines_stay(spark, tmp_path):
    import datetime as dt

    import orbitlens.plans.pipelines as P
    schema = "pipeline string, output string, metric string, satellite string, ts timestamp_ntz"
    rows = spark.createDataFrame([("m", "S", dt.datetime(2024, 1, 1), 1.0)], "metric string, satellite string, ts timestamp_ntz, value double")
    path, keys = str(tmp_path / "marks"), ["metric", "satellite"]
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    P.run_and_commit(rows, spark.createDataFrame([("a", "o", "m", "S", t[0]), ("a", "o", "n", "S", t[0]), ("b", "o", "m", None, t[2])], schema),
                     out_path=str(tmp_path / "out"), marks_path=path)
    P.run_and_commit(rows, spark.createDataFrame([("a", "o", "m", "S", t[1])], schema), out_path=str(tmp_path / "out"), marks_path=path)
    got = {(r.pipeline, r.metric, r.satellite): r.ts for r in P.current_marks(spark, path, keys).collect()}
    assert got == {("a", "m", "S"): t[1], ("a", "n", "S"): t[0], ("b", "m", None): t[2]}


def test_rows_and_marks_of_one_run_survive_a_crash_between_them(spark, tmp_path):
    from orbitlens.streaming.telemetry import dedup_latest
    t = events_telemetry(spark, SF_SMALL)
    none = spark.createDataFrame([], "pipeline string, output string, metric string, satellite string, ts timestamp_ntz")
    now, out, path = "2024-01-10 12:00:00", str(tmp_path / "out"), str(tmp_path / "marks")
    rows, marks = P.aggregation_run(t, none, KEYS, now)
    write = lambda batch: P.write_metrics(rows, out, batch_id=batch)
    write("1")                                                 # died here, before the marks
    P.run_and_commit(rows, marks, out_path=out, marks_path=path, batch_id="1")
    stored = spark.read.parquet(out)
    assert stored.count() == rows.count() > 0
    top = {(r.metric, r.satellite): r.ts for r in P.current_marks(spark, path, KEYS).collect()}
    last = stored.where(F.col("metric").endswith("_agg_count_60T")).groupBy("metric", "satellite").agg(F.max("ts").alias("ts"))
    assert top == {(r.metric.removesuffix("_agg_count_60T"), r.satellite): r.ts for r in last.collect()}
    write("2")                                                 # another run wrote the same rows
    assert spark.read.parquet(out).count() == 2 * rows.count()
    assert dedup_latest(spark.read.parquet(out), ["metric", "satellite"]).count() == rows.count()


def test_bounds_monitor_runs_chain_through_two_marks(spark):
    """Two runs joined by their marks write what one run writes; the two outputs keep marks of their own (the bounds lag behind)."""
    from orbitlens.plans import pipelines as P
    from orbitlens.sources.telemetry import events_telemetry, sample_first
    df = events_telemetry(spark, "/root/testdata/sf0.001")
    keys, now = ["metric", "satellite"], "2024-01-31 00:00:00"
    bounds = sample_first(df, keys, "10T").select(*keys, "ts", F.lit(20.0).alias("lb"), F.lit(60.0).alias("ub"))
    start = df.select(*keys).distinct().withColumn("ts", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
    marks = start.select(F.lit("bounds_monitor").alias("pipeline"), F.explode(F.array(F.lit("resample"), F.lit("bounds"))).alias("output"), *keys, "ts")
    cut, known = "2024-01-20 00:00:00", "2024-01-17 00:00:00"
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    a, more = P.bounds_monitor_run(df.where(F.col("ts") <= F.lit(cut).cast("timestamp_ntz")), bounds.where(F.col("ts") <= F.lit(known).cast("timestamp_ntz")),
                                   marks, keys, cut, every="10T")
    first = rows(a)
    after = marks.unionByName(more).groupBy("pipeline", "output", *keys).agg(F.max("ts").alias("ts")).checkpoint()
    assert after.groupBy(*keys).agg(F.countDistinct("ts").alias("n")).where("n = 2").count() > 5
    b, _ = P.bounds_monitor_run(df, bounds, after, keys, now, every="10T")
    whole, _ = P.bounds_monitor_run(df, bounds, marks, keys, now, every="10T")
    assert sorted(first + rows(b)) == rows(whole) and len(first) > 100
