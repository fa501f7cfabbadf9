"""Labelled rows for the trained operators: a bounded sample, never a held-out row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text leaves 0 modulo 5; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_cols: list[str], per_class: int, strata: str) -> DataFrame:
    """Text rows (doc_id, text, labels) to learn from: per value of ``strata`` the
    ``per_class`` ids of least hash.  An id with several label rows takes the
    largest labels; the id list is bounded, so it is broadcast to the texts."""
    own = (labels.select(F.col("doc_id").cast("long").alias("l_id"), *[F.col(c).cast("int").alias(c) for c in label_cols])
           .where(F.col("l_id").isNotNull() & ~held_out(F.col("l_id"))).dropna()
           .groupBy("l_id").agg(*[F.max(c).alias(c) for c in label_cols]))
    # at most per_class rows of a class: top rows by hash, without ranking a whole class in one task
    top = None
    for value in (0, 1):
        part = own.where(F.col(strata) == value).orderBy(F.xxhash64("l_id"), "l_id").limit(per_class)
        top = part if top is None else top.unionAll(part)
    rows = docs.join(F.broadcast(top), F.col("doc_id") == F.col("l_id")).drop("l_id")
    return rows


def one_row_per_id(rows: DataFrame) -> DataFrame:
    """Repeated ids of the sample keep one row."""
    w = Window.partitionBy("doc_id").orderBy("body")
    return rows.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")
