"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.llm.common import forget, store


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge table; root is the smallest node reachable.

    Each round is a handful of aggregations and joins on the node, written to the shared folder, so a
    lost executor costs one round at most; minima are combined before the shuffle, and a hub's joins
    are ones that adaptive execution can split. Rounds grow with the logarithm of the nodes. Null
    ends and self-links are ignored; an empty table gives an empty result.
    """
    now = store(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = store(both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        head = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(head, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = store(small.unionByName(head.select("u", F.col("m").alias("v"))).distinct())
        after = mark(new)
        forget(now), forget(large)
        now = new
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
