"""Retrieval flows: what an answering model would be given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphvec.operators.vector import batch_search
from graphvec.operators.walk import connections


def chunks(collection: DataFrame, queries: DataFrame, limit: int = 15) -> DataFrame:
    """(qid, id, cosine, rank, payload): the closest points of a text collection."""
    return batch_search(collection, queries, limit).join(collection.select("id", "payload"), "id")


def insights(collection: DataFrame, queries: DataFrame, nodes: DataFrame, edges: DataFrame, limit: int = 15) -> DataFrame:
    """(qid, node, src, ...): the connections of the entities closest to each query."""
    near = batch_search(collection, queries, limit).select("qid", F.col("id").alias("node"))
    return near.join(connections(nodes, edges, near.select(F.col("node").alias("id"))), "node")
