"""Context for a completion: what lies near the entities that a question finds.

A random walk with restarts from the entities, in its push form: a node passes its residual mass
on to its neighbours as long as that is at least `least` for each of them, and keeps the share
`stay`.  So a question touches at most 1 / (stay * least) edges, however large the graph
or a node is.  Nodes with a text are then packed, most mass first, into a budget of words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphvec.operators.metrics import both_ways, simple_links
from graphvec.storage import broadcast_if_small, materialize

STAY, LEAST, ROUNDS, BUDGET = 0.2, 0.0005, 6, 400
FEW = 1_000_000  # rows that are broadcast


def walk_mass(seeds: DataFrame, edges: DataFrame, stay: float = STAY, least: float = LEAST, rounds: int = ROUNDS) -> DataFrame:
    """(qid, id, mass) from `seeds` (qid, id), which share a mass of 1 by question; edges (src, dst) count in both
    directions.  Mass that `rounds` pushes have not settled stays where it is."""
    links = materialize(simple_links(edges), "links", "zstd")
    degree = materialize(both_ways(links).groupBy(F.col("u").alias("id")).agg(F.count("*").alias("degree")), "degrees", "zstd")
    start = materialize(seeds.select("qid", "id").distinct(), "seeds")
    share = start.groupBy("qid").agg((1.0 / F.count("*")).alias("rest"))
    state = start.join(share, "qid").select("qid", "id", F.lit(0.0).alias("mass"), "rest")
    for _ in range(rounds):
        # what a walk touches is small beside the graph, which therefore stays where it is
        state = materialize(state, "walk")
        near = degree.join(broadcast_if_small(state.where("rest > 0").select("id").distinct(), FEW), "id", "left_semi")
        state = materialize(state.join(near, "id", "left"), "walk")
        pushes = F.round("rest", 12) >= F.lit(least) * F.col("degree")  # null, and so no push, without neighbours
        active = state.where(pushes).select("qid", F.col("id").alias("u"), (F.col("rest") * (1 - stay) / F.col("degree")).alias("rest"))
        if active.isEmpty():
            break
        kept = state.select("qid", "id", F.when(pushes, F.col("mass") + stay * F.col("rest")).otherwise(F.col("mass")).alias("mass"), F.when(pushes, 0.0).otherwise(F.col("rest")).alias("rest"))
        passed = both_ways(links).join(broadcast_if_small(active, FEW), "u").select("qid", F.col("v").alias("id"), F.lit(0.0).alias("mass"), "rest")
        state = kept.unionAll(passed).groupBy("qid", "id").agg(F.sum("mass").alias("mass"), F.sum("rest").alias("rest"))
    return state.select("qid", "id", (F.col("mass") + F.col("rest")).alias("mass"))


def pack(mass: DataFrame, texts: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(qid, id, mass, place, words, text): of the nodes with a text (id, text), those that fit into `budget`
    words by question, most mass first; what comes after the first that does not fit is left out."""
    rows = mass.join(texts, "id").withColumn("words", F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    by = Window.partitionBy("qid").orderBy(F.desc(F.round("mass", 9)), "id")  # bounded by what a walk touches
    rows = rows.withColumns({"place": F.row_number().over(by), "_sum": F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    return rows.where(F.col("_sum") <= budget).drop("_sum")
