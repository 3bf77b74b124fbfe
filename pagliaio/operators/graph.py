"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagliaio.session import cut_lineage


def components(edges: DataFrame, left: str = "u", right: str = "v", max_rounds: int = 100) -> DataFrame:
    """``member, component``: every vertex with the least vertex of its component.

    Large-star and small-star steps replace edges until all are stars around their
    least vertex; both are one partial aggregation and one join. NULL ends and loops
    are ignored. The driver sees one number a round.
    """
    current = cut_lineage(
        edges.select(F.col(left).cast("string").alias("a"), F.col(right).cast("string").alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    )
    before = None
    for _ in range(max_rounds):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return current.select(F.col("v").alias("member"), F.col("u").alias("component")).unionByName(current.select(F.col("u").alias("member"), F.col("u").alias("component"))).distinct()
        before = state
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(down, "v").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(large.join(down, "v").select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a <> b")
        current = cut_lineage(small.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    raise RuntimeError(f"components are not stable after {max_rounds} rounds")
