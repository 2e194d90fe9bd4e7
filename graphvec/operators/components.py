"""Weakly connected components by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014): O(log^2 n) rounds,
each a few shuffles of the edge list.  Neighbour lists are never gathered: a node's smallest
neighbour is a grouped minimum that joins back to the edges, so a node with a third of all
edges is split like any other skewed join key.  Rounds end in a written table of the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphvec.storage import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    # one row: the number of edges and two sums that tell one edge set from another
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.sum(F.hash("u", "v").cast("bigint"))).first()
    return tuple(r)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every endpoint of `edges` (u, v of one orderable type); component
    is the smallest node reachable.  Self-loops and repeated edges are fine; a self-loop alone
    yields no row, as nodes without other edges are their own component."""
    now = materialize(edges.select("u", "v").where("u <> v").distinct(), "cc")
    state = _state(now)
    for _ in range(max_rounds):
        now = materialize(_small_star(_large_star(now)), "cc")
        before, state = state, _state(now)
        if before == state:
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
