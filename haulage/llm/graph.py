"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulage.session import stored


def _print_of(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """(node, root) for every node of the links ``(a, b)``: the smallest node that links lead to.

    Every round hangs the larger neighbours of each node, then the smaller ones, to the smallest neighbour; the number of
    rounds grows with the logarithm of the graph. Each round is written out, which cuts lineage. Neighbours are never
    gathered, only their minimum, so a node with any number of links is a partial aggregate and a join that adaptive
    execution splits.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{label}-0")
    seen, step = _print_of(edges), 0
    while seen[0]:
        step += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "k")
        large = both.join(least, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, f"{label}-{step}a")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = large.join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct(), f"{label}-{step}b")
        now = _print_of(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
