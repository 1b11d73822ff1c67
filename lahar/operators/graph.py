"""Connected components by contraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JUMPS = 2


def components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, root): every node of edges (x, y) with the smallest node it is connected to. Nodes of any ordered type.

    Each round every node points to the first node beside it in the order of their hashes, in which chains of pointers
    are short whatever the graph; pointers jump JUMPS times, and edges are drawn anew between what their ends point to.
    Edges within a node vanish, equal ones become one, and settled components take no part in later rounds, so a round
    works on what is left. Roots have no pointer, and are left out of what jumps look up. In the end pointers are
    followed from the last round back to the first, and each component takes the name of its smallest node. Null ends
    count as no edge.
    """
    hashed = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v")).alias(c)
    some = edges.where("x IS NOT NULL AND y IS NOT NULL")
    lone = some.where("x = y").select(F.col("x").alias("node"), F.col("y").alias("root")).distinct()
    ends = some.select(hashed("x"), hashed("y"))
    left = cut(ends.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    rounds = []
    while not left.isEmpty():
        # a node without a smaller neighbour is a root of this round and has no pointer
        points = cut(left.groupBy("x").agg(F.min("y").alias("to")))
        for _ in range(JUMPS):
            beyond = points.select(F.col("x").alias("to"), F.col("to").alias("next"))
            points = points.join(beyond, "to", "left").select("x", F.coalesce("next", "to").alias("to"))
        points = cut(points)
        rounds.append(points)
        one = points.select("x", F.col("to").alias("to_x"))
        two = points.select(F.col("x").alias("y"), F.col("to").alias("to_y"))
        moved = left.join(one, "x", "left").join(two, "y", "left").select(F.coalesce("to_x", "x").alias("x"), F.coalesce("to_y", "y").alias("y"))
        left = cut(moved.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    if not rounds:
        return lone
    final = rounds[-1]
    for points in reversed(rounds[:-1]):
        later = final.select(F.col("x").alias("to"), F.col("to").alias("root"))
        followed = points.join(later, "to", "left").select("x", F.coalesce("root", "to").alias("to"))
        final = followed.unionByName(final)
    final = cut(final)
    found = cut(final.select("x", "to").unionByName(final.select(F.col("to").alias("x"), "to").distinct()))
    named = found.groupBy("to").agg(F.min("x.v").alias("root"))
    found = found.join(named, "to").select(F.col("x.v").alias("node"), "root")
    return found.unionByName(lone.join(found.select("node"), "node", "left_anti"))
