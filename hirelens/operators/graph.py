"""Connected components as joins and aggregates over an edge table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.session import written


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, component), the smallest
    node reachable. Isolated nodes do not appear.

    Alternates large-star and small-star steps, written as joins and ``min``
    aggregates (a hub's neighbours are pre-aggregated before the shuffle, never
    gathered in one place), until the edges form stars. Each round is written to the
    shared folder; their number grows with the logarithm of the longest path.
    """
    e = (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
         .where("a <> b").distinct())
    e = written(e, "cc")
    while True:
        # large star: every larger neighbour moves to the smallest node around u
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(m, "u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: smaller neighbours of a, and a itself, move to the smallest of them
        m = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(m.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        new = written(small, "cc")
        # a forest of stars: no node is both a child and a parent, and none has two parents
        role = new.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
            new.select("b", F.lit(0), F.lit(1)))
        role = role.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
        if not role.where("child > 1 OR child = 1 AND parent = 1").agg(F.count(F.lit(1))).first()[0]:
            break
        e = new
    return new.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        new.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
