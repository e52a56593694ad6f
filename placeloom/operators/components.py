"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeloom.plans.cut import cut_table, release


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; a component is named by its smallest node.

    Large and small stars alternate until the edges no longer change (Kiveris et al., 2014): each round is grouping
    and joining on nodes, and the number of rounds grows with the logarithm of the longest path. Each round is cut by
    a table, and the table before goes. Loops and edges with a null end only name their node; repeated and reversed edges count once; no edges give no rows.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    e = cut_table(ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        last, e = e, cut_table(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        release(last)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    loops = ends.select(F.col("a").alias("node")).unionByName(ends.select(F.col("b").alias("node"))).distinct()
    return loops.join(e.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "node").alias("component"))
