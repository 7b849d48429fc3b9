"""Connected components of an edge table, by alternating star contraction, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, join_by_key, mark, written


#: Edges of a node from which its minimum is broadcast to them instead of shuffling them together.
HOT = 1 << 12


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v: long): the root is the component's smallest node.

    Each round points every node's larger neighbours at its smallest one, then every node's smaller neighbours. Node
    minima are aggregates with partial sums, so that no node's neighbours meet in one task.
    """
    at = mark()
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(most_rounds):
        tangled = e.groupBy("u").count().where("count > 1").select("u").unionByName(e.join(e.select(F.col("u").alias("v")), "v", "left_semi").select(F.col("v").alias("u")))
        if tangled.isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_by_key(both.where("v > u"), least, "u", "n", hot=HOT).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        pairs = join_by_key(large, least, "u", "n", hot=HOT)
        small = pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        before, at = at, mark()
        e = written(small.distinct())
        drop(edges.sparkSession, before, before + 1)  # the last round's
    raise RuntimeError("components did not settle")
