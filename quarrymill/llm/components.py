"""Connected components of a large edge table by alternating large-star and small-star rounds.

Every round is aggregations and equi-joins; a node with very many neighbours is reduced by partial
aggregation and its edges stay rows, so that no neighbourhood is gathered. Each round's edges are written to
the shared folder, which cuts the lineage. Nodes are longs; a component's label is its least node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import dropped, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("lu"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("lu")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "lu")
    moved = down.join(least, F.col("u") == F.col("lu")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select(F.col("lu").alias("u"), F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(u, v) -> (node, label) for every node that has an edge to another node."""
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    before, now = None, _state(edges)
    while now != before and now[0]:
        last, edges = edges, written(_small_star(_large_star(edges)), "cc-edges")
        before, now = now, _state(edges)
        dropped(last)
    # At the fixed point every edge leads to its component's least node.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
