"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(v, comp) for every vertex of ``edges`` (a, b: long), comp being the smallest vertex
    that is reachable. Alternating large and small stars: every vertex points its larger
    neighbours, then itself and its smaller ones, at its smallest neighbour, until all edges
    lead from a vertex with no other edge to the smallest one. The number of rounds grows with the logarithm of the longest path; edges never
    leave Spark, each round is a stored table."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("b", "a")) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        both = both.toDF("u", "w")
        least = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u")
        out = joined.where("w > u" if large else "w <> m").select(F.col("w").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.union(least.where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")))
        return stored(out.where("a <> b").distinct(), "stars")

    def settled(e: DataFrame) -> bool:
        """Every vertex has one edge to a smaller one, or none and is the end of edges."""
        ends = e.select(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
            e.select("b", F.lit(0), F.lit(1))
        )
        return ends.groupBy("v").agg(F.sum("down").alias("n"), F.max("up").alias("up")).where("n + up > 1").isEmpty()

    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = stored(e.distinct(), "stars")
    while not settled(e):
        e = star(star(e, True), False)
    roots = e.select(F.col("b").alias("v"), F.col("b").alias("comp")).distinct()
    return stored(e.select(F.col("a").alias("v"), F.col("b").alias("comp")).union(roots), "components")
