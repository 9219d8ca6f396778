"""Connected components of a table of links, by randomised contraction.

In each round every node looks at itself and its neighbours and moves to the one with the least
random number; links between the places moved to remain. The number of nodes falls by a constant
factor per round, also on long paths. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; ``component`` is the least node in it.

    Links are undirected; loops, repeats and null ends (left out) are allowed.
    """
    edges = materialize(links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    at = materialize(nodes.select("node", F.col("node").alias("place")), "places")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        draw = lambda c: F.xxhash64(F.col(c), F.lit(turn))  # noqa: B023, E731
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(draw("b").alias("h"), F.col("b").alias("n"))).alias("best"))
        here = F.struct(draw("a").alias("h"), F.col("a").alias("n"))
        moves = materialize(best.select(F.col("a").alias("old"), F.least(F.col("best"), here)["n"].alias("new")), "moves")
        moved = edges.join(moves, edges["a"] == moves["old"]).select(F.col("new").alias("a"), "b")
        moved = moved.join(moves, moved["b"] == moves["old"]).select("a", F.col("new").alias("b"))
        edges = materialize(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        at = at.join(moves, at["place"] == moves["old"], "left").select("node", F.coalesce("new", "place").alias("place"))
        at = materialize(at, "places")
    least = materialize(at.groupBy("place").agg(F.min("node").alias("component")).withColumnRenamed("place", "of"), "least")
    return at.join(least, at["place"] == least["of"]).select("node", "component")
