"""Physical-plan properties of the main operators (scan pruning, pushdown,
shuffle count, hot-series tiling)."""

import re

import __spark_entry__ as E
from conftest import SF_SMALL
from orbitlens.operators.windows import rolling_stats
from orbitlens.sources.telemetry import events_telemetry, read_metrics


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_single_scan_pruned_two_exchanges(spark):
    p = plan(E.entry(spark))
    assert p.count("FileScan parquet") == 1
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "props" not in schema and "event_id" not in schema
    # partial aggregates of (series, bucket), then the small statistics table by series
    assert p.count("Exchange hashpartitioning") == 2


def test_filters_reach_the_scan(spark):
    t = events_telemetry(spark, SF_SMALL)
    r = read_metrics(t, ["click", "view"], "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    p = plan(r)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", p).group(1)
    assert "event_type" in pushed and "ts" in pushed


def test_tiled_rolling_partitions_by_block(spark):
    t = events_telemetry(spark, SF_SMALL)
    p = plan(rolling_stats(t, ["metric", "satellite"], "value", "1D", tile_us=2 * 86_400_000_000))
    assert re.search(r"hashpartitioning\([^)]*_blk", p)


def test_statistics_pipeline_scans_once(spark):
    p = plan(E.queries()["bucket_stats_hourly"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 1


def _partitioned_by_series_alone(df, keys):
    """Window specifications of the optimized plan whose partition keys are just the series keys."""
    import re
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    found = []
    for line in plan.split("\n"):
        m = re.search(r"Window \[.*?\], \[([^\]]*)\], \[", line)
        if m and sorted(re.sub(r"#\d+L?", "", m[1]).split(", ")) == sorted(keys):
            found.append(line.strip()[:200])
    return found


def test_grids_are_not_windowed_by_series_alone(spark):
    """Resampling and the regular series partition raw and grid rows by time block as well; only one-row-per-block tables are by series."""
    from orbitlens.forecast.features import regular_series
    from orbitlens.operators.resample import resample_first
    from orbitlens.plans.catalog import KEYS, tele
    t = tele(spark, "/root/testdata/sf0.001")
    for df in (resample_first(t, KEYS, "10s"), regular_series(t, KEYS)):
        for line in _partitioned_by_series_alone(df, KEYS):
            assert "blk" in line, line


def test_rolling_frames_only_grow(spark):
    """No rolling statistic slides a frame over its rows: a point's cost does not depend on how many a window holds."""
    t = events_telemetry(spark, SF_SMALL)
    for tile in (None, 2 * 86_400_000_000):
        for shift in (0, 1):
            p = plan(rolling_stats(t, ["metric", "satellite"], "value", "1D", shift=shift, tile_us=tile))
            frames = re.findall(r"specifiedwindowframe\((Range|Row)Frame, ([^,]+)", p)
            assert frames and not [f for f in frames if f[0] == "Range" and not f[1].startswith("unboundedpreceding")], frames
