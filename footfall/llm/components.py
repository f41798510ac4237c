"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Joins every neighbour of a node (the larger ones, or the smaller ones and itself) to the
    least node among the node and its neighbours. The minimum is aggregated before the shuffle and
    the join is one that adaptive execution splits where a node has very many edges."""
    if large:
        sides = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    moved = sides.where("b > a") if large else sides
    out = moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.union(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def component_roots(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node, root): for every node of an edge the least node that
    can be reached from it. Each round is written to the shared folder, which cuts the lineage."""
    now = written(spark, edges.where("a != b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == seen:
            break
        seen = mark
        now = written(spark, _stars(_stars(now, large=True), large=False), "edges")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
