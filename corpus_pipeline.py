"""Corpus pipeline: documents to token ids in five stages.

1. quality classifier (line CRF): rejected documents go;
2. n-gram Jaccard join: of every group of linked texts one row stays, of the
   smallest id (rows without an id are in no group and stay; rows that share an
   id but not a linked text are each a document of their own);
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scan: spans are replaced by ``<secret>``, every document stays;
5. SentencePiece: token ids, their count and digest, checked by decoding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept.  Stages 1 to 4 return the columns of ``docs``; extra columns
pass through.  An empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.llm.decontaminate import drop_leaks
from orbitlens.llm.jaccard_join import jaccard_join
from orbitlens.llm.quality_crf import keep_good
from orbitlens.llm.queries import SPM_MODEL, table
from orbitlens.llm.secrets import redact
from orbitlens.llm.shared import stored
from orbitlens.llm.spm import encode
from orbitlens.session import ship_package


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    # a row's own key: rows that share an id link only if their texts do
    own = docs.where("doc_id is not null").withColumn("_key", F.xxhash64("doc_id", "text"))
    group = jaccard_join(own, id_col="_key").select(F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).distinct()
    first = (own.select("_key", "doc_id").distinct().join(group, "_key").groupBy("_group")
             .agg(F.min(F.struct("doc_id", "_key")).alias("f")).select(F.col("f._key").alias("_keep")))
    kept = own.join(first, F.col("_key") == F.col("_keep"), "left_semi")
    # equal texts with one id keep one row: the least
    rows = kept.groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return rows.unionByName(docs.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    with open(SPM_MODEL, "rb") as f:
        model = f.read()
    return encode(docs, model)


STAGES = [("quality classifier", quality_stage), ("n-gram Jaccard join", dedup_stage),
          ("benchmark decontamination", decontamination_stage), ("secret scan", secret_stage),
          ("sentencepiece", token_stage)]

#: learned weights and tokenisation have no SQL form; tests/llm/test_pipeline.py holds the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
