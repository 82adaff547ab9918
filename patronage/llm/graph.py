"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from patronage.functions.stages import cut


def _mark(edges: DataFrame) -> tuple:
    """Number and order-free sum of the edges: equal for equal sets."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): each linked id and the least id it reaches; columns a and b hold the ends.

    Alternating large-star and small-star steps (each links a vertex's neighbours to the
    least of them) until nothing changes; every step is an aggregate and a join whose
    hot side Spark can split, and is stored before the next.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    edges = cut(links.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = cut(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            ends = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return ends.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
