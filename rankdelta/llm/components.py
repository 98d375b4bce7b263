"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rankdelta.llm.common import release, written


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The table of edges and its state (rows, sum of hashes), observed while it is written."""
    seen = Observation()
    e = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")), "cc")
    return e, (seen.get["n"], seen.get["s"])


def large_star(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest of its neighbourhood to its larger neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them."""
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    Neighbourhoods are never gathered: a step is a minimum per node (summed
    before the shuffle) and an equi-join, which Spark splits where a hub's edges
    are too many for a task.  Every round is written to the shared folder; the
    table's state, observed on the way, tells when nothing moves any more.
    """
    e, state = _written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while state[0]:
        last = e
        e, new = _written(small_star(large_star(last)))
        release(last)
        if new == state:
            break
        state = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
