"""The reference's five request-builder cases restated as read_metrics results,
plus cases it does not cover (several metrics / tags, limit, empty result)."""

import datetime as dt

import pandas as pd
import pytest

from orbitlens.sources.telemetry import read_metrics

T0 = dt.datetime(2021, 7, 1, 15, 0, 0)  # 1625151600000 ms


@pytest.fixture(scope="module")
def tele(spark):
    rows = []
    for i in range(0, 7200, 15):
        for metric in ["metric1", "metric2"]:
            for host in ["server1", "server2"]:
                rows.append((metric, host, T0 + dt.timedelta(seconds=i), float(i % 97)))
    pdf = pd.DataFrame(rows, columns=["metric", "host", "ts", "value"])
    return spark.createDataFrame(pdf, "metric string, host string, ts timestamp_ntz, value double")


def test_basic(tele):
    r = read_metrics(tele, ["metric1"], 1625151600000).toPandas()
    assert set(r.metric) == {"metric1"} and r.ts.min() == pd.Timestamp(T0) and len(r) == 2 * 480


def test_end_inclusive(tele):
    r = read_metrics(tele, ["metric1"], 1625151600000, 1625155200000).toPandas()
    assert r.ts.max() == pd.Timestamp(T0 + dt.timedelta(hours=1))
    assert len(r) == 2 * 241


def test_tags(tele):
    r = read_metrics(tele, ["metric1"], 1625151600000, tags={"host": "server1"}).toPandas()
    assert set(r.host) == {"server1"} and len(r) == 480


def test_resample(tele):
    r = read_metrics(tele, ["metric1"], 1625151600000, resample=60).toPandas()
    assert len(r) == 2 * 120
    assert (r.ts.dt.second == 0).all()
    first = r[(r.host == "server1")].sort_values("ts").iloc[1]
    assert first.value == float(60 % 97)


def test_everything(tele):
    r = read_metrics(tele, ["metric1", "metric2"], 1625151600000, 1625155200000,
                     tags={"host": "server2"}, resample=60, limit=5).toPandas()
    assert len(r) == 2 * 5 and set(r.host) == {"server2"}


def test_empty(tele):
    assert read_metrics(tele, ["nope"], 1625151600000).count() == 0


def test_limit_of_every_series(tele):
    """One request per metric and host: each series shows its own first points, whatever other series hold."""
    r = read_metrics(tele, ["metric1", "metric2"], 1625151600000, limit=3, limit_by=["metric", "host"]).toPandas()
    assert r.groupby(["metric", "host"]).size().to_dict() == {(m, h): 3 for m in ("metric1", "metric2") for h in ("server1", "server2")}
    assert len(read_metrics(tele, ["metric1"], 1625151600000, limit=3).toPandas()) == 3


def test_limit_query_reads_every_series(spark):
    import __spark_entry__ as E
    r = E.queries()["read_metrics_limit"](spark, "/root/testdata/sf0.001").toPandas()
    assert r.groupby(["metric", "satellite"]).size().to_dict() == {(m, f"SAT{i}"): 5 for m in ("click", "view", "purchase", "signup", "error") for i in range(3)}
