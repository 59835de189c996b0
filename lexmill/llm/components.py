"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import staged, with_group


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the smallest node it reaches.

    Each round joins every link with the smallest neighbour of one end: only
    (key, minimum) pairs are aggregated, and the minima of the few nodes with very
    many links are broadcast, so that no node's links have to fit a task. A round's
    links are written to the shared folder; rounds end when the links no longer
    change, after about log(nodes) rounds. Null ends and links of a node to itself
    count for nothing.
    """
    edges = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    before, total = None, edges.count()
    while True:
        edges = staged(_small_star(_large_star(edges, total), total), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, total = now, now[0]
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("degree"))
    return with_group(both.where("b > a"), least, "a", "degree", total).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    others = with_group(down, least, "a", "degree", total).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
