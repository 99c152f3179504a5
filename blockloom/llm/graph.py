"""Connected components as joins and aggregations (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_io import discard, materialize

#: Nodes with more than one in so many edge ends are hubs: at most so many, looked up by broadcast.
HUB_SHARE = 1000


def _with_least(edges: DataFrame, least: DataFrame, ends: int) -> DataFrame:
    """(u, v, m): edges with what `least` (u, m, n) says of u. The edges of hubs stay where they are, so that no task gathers
    them; only the other nodes' are shuffled."""
    hubs = least.where(F.col("n") * HUB_SHARE > ends).select(F.col("u").alias("hub"), F.col("m").alias("hub_m"))
    told = edges.join(F.broadcast(hubs), edges["u"] == hubs["hub"], "left")
    rest = told.where("hub is null").select("u", "v").join(least.select("u", "m"), "u")
    return told.where("hub is not null").select("u", "v", F.col("hub_m").alias("m")).unionAll(rest.select("u", "v", "m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of the edges, component the smallest node it reaches; loops count for nothing, nor do
    repeated edges; an empty table gives an empty result.

    Each round is written to the shared folder, and the one before deleted; no adjacency list is ever collected, so hubs of
    any degree are sums and minima."""
    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    state, n = None, e.count()
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = _with_least(both, low, 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _with_least(large, least, 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        new = materialize(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(e, large)
        e = new
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()  # two numbers
        if (row["n"], row["s"]) == state:
            break
        state, n = (row["n"], row["s"]), row["n"]
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
