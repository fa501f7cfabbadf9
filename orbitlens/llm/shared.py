"""Intermediate tables in the folder that driver and executors share.

The folder is the cluster's ``spark.checkpoint.dir``; only where that is unset on a
local master (tests) a fresh one is made and set.  A stored table cuts lineage and
survives lost executors.  Tables lie under ``orbitlens-<application id>`` and
can be removed when the application has ended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.session import checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    return checkpoint_dir(spark)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/orbitlens-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of the files behind ``docs`` as the planner knows them (no job); where it knows nothing, the summed texts."""
    known = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return known if known < 1 << 50 else docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def bucket_number(docs: DataFrame, text_col: str, bucket_bytes: int) -> int:
    """Hash buckets for work on ``docs``: one per ``bucket_bytes`` of input, and no fewer than shuffle partitions."""
    least = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-input_bytes(docs, text_col) // bucket_bytes))
