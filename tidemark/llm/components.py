"""Connected components of an edge table, by alternating large-star and small-star steps.

Nothing is gathered: each step is a grouped minimum and a join, and ends in a table in the shared folder, so a lost executor costs a
retried task. A node with very many neighbours is combined before it is shuffled (MIN) and salted in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, spread_join


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is the least node of the component."""
    edges = edges.select("a", "b").filter("a <> b")
    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark, n = None, now.count()
    for _ in range(limit):
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        large = spread_join(both, low, ["a"], 2 * n).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = materialise(large, "large-stars")
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = spread_join(large, low, ["a"], n).filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialise(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).collect()[0]
        if seen == mark:
            break
        mark, n = seen, seen.n
    else:
        raise RuntimeError("components didn't settle")
    # Settled: every edge leads from a node to its label.
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
