"""Connected components of a large edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest node around it."""
    around = _neighbours(edges)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return around.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its
    smallest node. Repeated edges and loops do no harm.

    Each round is a written table, so a lost executor costs at most one round; the
    number of rounds grows with the logarithm of the longest path.
    """
    now = written(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    mark = None
    while True:
        now = written(_small_star(_large_star(now)).distinct(), "edges")
        new = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("try_sum(CAST(b AS DECIMAL(38)))")).first()
        if new == mark or not new[0]:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
