"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow.llm.rows import staged


def _star(pairs: DataFrame) -> DataFrame:
    """Edges (u, v) joined with the least node among u and its listed neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node reachable.

    Each round rewires edges towards smaller nodes and is written to the shared folder; the result
    is reached when a round changes nothing. Work per round is a grouped minimum (partial sums
    first) and a join on the node, so a node with very many edges is split like any skewed key.
    Loops, repeated and two-way edges are allowed; an empty table gives an empty result.
    """
    e = (edges.filter("a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = staged(e, "edges")
    seen = None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if mark == seen or mark["n"] == 0:
            break
        seen = mark
        # large star: the larger neighbours of u go to the least node around u
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the least of them
        small = _star(large)
        e = staged(small.select("u", F.col("m").alias("v"))
                   .unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                   .distinct(), "edges")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
