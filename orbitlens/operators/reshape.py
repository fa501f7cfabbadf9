"""Reshape (R1-R3): long <-> wide.

The canonical form is long; pivot only at the edge and always with an
explicit list of values, so the schema is static and Spark does not run an
extra job to discover the distinct labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def series_label(tag_cols: list[str], metric: str = "metric"):
    """``metric`` or ``metric (tag: v), (tag2: v)`` over sorted, non-empty tags."""
    parts = [F.when(F.coalesce(F.col(t), F.lit("")) != "", F.concat(F.lit(f"({t}: "), F.col(t), F.lit(")")))
             for t in sorted(tag_cols)]
    if not parts:
        return F.col(metric)
    joined = F.concat_ws(", ", *parts)
    return F.when(joined == "", F.col(metric)).otherwise(F.concat(F.col(metric), F.lit(" "), joined))


def pivot_by_series(df: DataFrame, *, tag_cols: list[str], values: list[str] | None,
                    ts: str = "ts", value: str = "value", metric: str = "metric") -> DataFrame:
    """One row per timestamp, one column per series label.

    ``values`` must list the labels (static schema).  The reference raises on
    duplicate (ts, label); here ``first`` keeps one value.
    """
    if values is None:
        raise ValueError("pivot_by_series needs the explicit list of series labels")
    lab = df.withColumn("_label", series_label(tag_cols, metric))
    return lab.groupBy(ts).pivot("_label", values).agg(F.first(value))


def unpivot_metrics(df: DataFrame, ids: list[str], value_cols: list[str], *,
                    metric: str = "metric", value: str = "value") -> DataFrame:
    """R2: wide -> long, one row per (ids, metric column)."""
    return df.unpivot(ids, value_cols, metric, value)


def split_by_tags(df: DataFrame, tag_cols: list[str]) -> DataFrame:
    """The reference loops over tag combinations; here the tag set is a key.

    Returns one row per tag combination with its row count and time span -
    the blocks a per-tag loop would visit - computed in one aggregation.
    """
    return df.groupBy(*tag_cols).agg(F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first_ts"),
                                     F.max("ts").alias("last_ts"))
