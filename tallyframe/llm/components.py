"""Connected components of a graph of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.store import dropped, written


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node reachable) for every node of the links ``(a, b)``.

    In each round every node points all its neighbours, and itself, at the smallest node it sees.  Links are kept
    distinct and never grow beyond two for each one given; the rounds grow with the logarithm of the longest path.
    Loops and repeated links are allowed; null ends are dropped.
    """
    start = links.select("a", "b").where("a is not null and b is not null")
    nodes = written(start.select("a", "b").distinct(), "links")
    edges, rounds = nodes.where("a <> b"), 0
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        sent = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, rounds = edges, rounds + 1
        edges = written(sent.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "links")
        if rounds > 1:  # the first round reads the links given, which name all nodes
            dropped(before)
        # Done when each node has one parent and no parent has one itself.
        parents = edges.groupBy("a").agg(F.count("b").alias("n"))
        roots = edges.select(F.col("b").alias("a")).distinct()
        unsettled = parents.join(roots.withColumn("root", F.lit(True)), "a", "left").where("n > 1 or root")
        if unsettled.isEmpty():
            break
    every = nodes.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return every.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
