"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import forget, materialise


def _minima(pairs: DataFrame, node: str, other: str) -> DataFrame:
    """(node, _least) in a written table, so that a join to it can split a hot node."""
    return materialise(
        pairs.groupBy(node).agg(F.min(other).alias("_least")).withColumnRenamed(node, "_node"), "star"
    )


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, which has none itself."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    bad = F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
    return degrees.agg(bad).first()[0] == 0


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of the edges with the smallest node it is connected to.

    Nodes are long numbers; loops, repeated edges and nulls are left out. Each
    round links all larger neighbours of a node to its least neighbour, then
    all smaller ones, until the edges form stars; the number of rounds grows
    with the logarithm of the longest path. Minima are combined before the
    shuffle and joined back from a written table, so no task needs a whole
    neighbourhood.
    """
    current = materialise(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct(),
        "edges",
    )
    while not _is_stars(current):
        both = current.unionByName(current.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least_of = _minima(both, "hi", "lo")
        least = least_of.withColumn("_least", F.least("_node", "_least"))
        large = materialise(
            both.where("lo > hi")
            .join(least, F.col("hi") == F.col("_node"))
            .select(F.col("lo").alias("hi"), F.col("_least").alias("lo")),
            "edges",
        )
        forget(current, least_of)
        least = _minima(large, "hi", "lo")
        current = materialise(
            large.join(least, F.col("hi") == F.col("_node"))
            .where("lo > _least")
            .select(F.col("lo").alias("hi"), F.col("_least").alias("lo"))
            .unionByName(least.select(F.col("_node").alias("hi"), F.col("_least").alias("lo")))
            .distinct(),
            "edges",
        )
        forget(large, least)
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
