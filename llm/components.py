"""Connected components of a link table, by alternating star joins.

Every round points a node's neighbours at its smallest neighbour, first the
larger ones (large star), then the smaller ones (small star), until all edges
lead straight to roots. Only joins and minimum aggregates, which combine
before the shuffle; each round is a written table, so no lineage grows and
nothing is collected but a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads from a node of its own to a root: one aggregate, of which a row comes back."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("out")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("out")))).alias("e")).select("e.*")
    per = ends.groupBy("node").agg(F.sum("out").alias("out"), F.count(F.lit(1)).alias("all"))
    return per.filter("out > 1 or (out = 1 and all > 1)").limit(1).count() == 0


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, component)``, component the smallest reachable node.

    Nodes without a link (or linked with themselves only) are not listed;
    null ends link nothing; repeated links count once.
    """
    edges = written(links.select("a", "b").filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _settled(edges):
        edges = written(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
