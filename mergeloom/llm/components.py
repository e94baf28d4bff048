"""Connected components by alternating large and small stars.

Each round is two groupings and two joins over the remaining edges; edges are
written between rounds. Nothing is gathered on the driver but two sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable. Nodes without an edge
    to another node are not listed. `edges` has bigint columns a and b."""
    edges = cut_lineage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(nearest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        nearest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(nearest, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        edges = cut_lineage(small.select("e.*").where("a <> b").distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
