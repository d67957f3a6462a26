"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node and component (the smallest node it reaches) of every node that has an edge (a, b).

    Alternates two steps until nothing changes, which takes a number of rounds that grows
    with the logarithm of the nodes: link all larger neighbours of a node to its smallest one,
    then all smaller ones. Sums are made before exchanges; the joins carry pairs of numbers.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    table = scratch.save(both, f"{name}-0")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    before, round_ = table.agg(F.count(F.lit(1)), mark).first(), 0
    while True:
        every = table.union(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = every.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = every.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        round_ += 1
        table = scratch.save(small, f"{name}-{round_}")
        scratch.drop(f"{name}-{round_ - 1}")
        after = table.agg(F.count(F.lit(1)), mark).first()
        if after == before:
            break
        before = after
    own = table.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return table.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own)
