"""Connected components of an edge table: large-star and small-star rounds until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0])


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (node, component): the smallest node that each node of an edge reaches.

    A round groups by node with partial minima and joins them back, so no neighbourhood is collected anywhere; a node with
    very many edges is split by the skew join. Loops and repeated edges are ignored.
    """
    edges = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = cut_lineage(edges)
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = met.select("u", F.col("m").alias("v")).unionByName(met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        edges = cut_lineage(small)
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
