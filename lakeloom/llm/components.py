"""Connected components by alternating large-star and small-star.

Input: a DataFrame of edges (u, v) of longs. Output: (node, component), a row for each node that has an edge to another,
the component being its least node. Each round is written to the shared folder, so lost executors cost one round at most.
Null ends and loops are left out; repeated edges count once; no edges give no rows. A node that very many edges meet is
summed up before the shuffle and then met by a join, which splits where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import delete, reread, scratch

MAX_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the least of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.join(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "u")
    return near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of these; edges come as (larger, smaller)."""
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = ordered.join(ordered.groupBy("u").agg(F.min("v").alias("m")), "u")
    return near.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    spark = edges.sparkSession
    now = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum((F.xxhash64("v", "u") % 1000003))).first()
    path = scratch(spark, "components")
    now = reread(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), path)
    before = mark(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        nxt = scratch(spark, "components")
        now = reread(_small(_large(now)), nxt)
        delete(spark, path)
        path, after = nxt, mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components didn't settle in {MAX_ROUNDS} rounds")
    # settled: every edge goes from a node to its component
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
