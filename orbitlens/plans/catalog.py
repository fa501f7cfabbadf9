"""Registered queries: one per operator / pipeline of the inventory.

Every entry is ``(spark, sf_dir) -> DataFrame`` over the given test tables
(whole tables, no row caps) and, where the operator is exact, an
equivalent SQL text for DuckDB over the same parquet files.  Floating point
outputs are rounded with ``functions.output.q`` on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.functions.output import round_doubles
from orbitlens.functions.time import DAY, HOUR
from orbitlens.operators.detect import moving_average_anomaly
from orbitlens.operators.stats import STAT_NAMES, bucket_stats, drop_open_bucket
from orbitlens.plans import sqlparts as S
from orbitlens.sources.telemetry import events_telemetry

KEYS = ["metric", "satellite"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        import functools

        @functools.wraps(fn)
        def run(spark, sf_dir):
            from orbitlens.session import ship_package
            ship_package(spark)      # Python workers import the package from the shipped zip
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def tele(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_telemetry(spark, sf_dir)


# ---------------------------------------------------------------- statistics
def hourly_stats(spark, sf_dir) -> DataFrame:
    return bucket_stats(tele(spark, sf_dir), KEYS, "60T")


@register("bucket_stats_hourly", sql=f"""
WITH {S.TELE}, {S.stats_ctes()}
SELECT metric, satellite, bucket_end, {S.rounded(STAT_NAMES, exclude=("count",))} FROM stats
""")
def q_bucket_stats_hourly(spark, sf_dir):
    return round_doubles(hourly_stats(spark, sf_dir))


# ------------------------------------------------------ flagship: P5 D1 branch
def ma_on_hourly_mean(spark, sf_dir) -> DataFrame:
    st = drop_open_bucket(hourly_stats(spark, sf_dir), KEYS)
    return moving_average_anomaly(st, KEYS, ["mean"], window="3D", min_periods=1, sigma=4.0,
                                  delta=0.01, ts="bucket_end")


_ma_ctes, _ma_sel = S.ma_sql("closed", "bucket_end", ["mean"], 3 * DAY, 1, 4.0, 0.01)


@register("ma_anomaly_hourly_mean", sql=f"""
WITH {S.TELE}, {S.stats_ctes()},
closed AS (SELECT * FROM (SELECT *, max(bucket_end) OVER (PARTITION BY metric, satellite) AS last_b FROM stats)
           WHERE bucket_end < last_b),
{_ma_ctes}
{_ma_sel}
""")
def q_ma_anomaly_hourly_mean(spark, sf_dir):
    return round_doubles(ma_on_hourly_mean(spark, sf_dir))


__all__ = ["QUERIES", "SQL", "register", "KEYS", "HOUR"]


def load_all():
    """Import every module that registers queries (idempotent); returns the registries."""
    from orbitlens.plans import q_basic, q_forecast, q_models, q_pipelines, q_series, q_streaming  # noqa: F401
    return QUERIES, SQL
