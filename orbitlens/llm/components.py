"""Connected components of a link table by alternating star steps.

Large star: every node hands its larger neighbours to the smallest node it
knows; small star: it hands its smaller neighbours and itself to the smallest.
The links shrink to stars round the smallest node of each component in a
number of rounds that grows with the logarithm of its size.  Links stay in
Spark; each round's result is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm.shared import shared_dir


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is the smallest node it reaches."""
    shared_dir(links.sparkSession)
    e = (links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .where("u <> v").distinct().checkpoint())
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
             .unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint())
        now = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if before is not None and (now.n, now.x) == before:
            break
        before = (now.n, now.x)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
