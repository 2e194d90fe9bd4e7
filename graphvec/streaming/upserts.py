"""Extension: streams of changes, committed batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphvec.sources.collections import CollectionStore
from graphvec.sources.graph_store import GraphStore


def stream_graph(nodes: DataFrame | None, edges: DataFrame | None, store: GraphStore, checkpoint: str):
    """Upsert streams of nodes and edges into the store; returns the started queries.  A batch
    rewrites the buckets it meets.  Upserts are idempotent, so a batch that is replayed after a failure changes nothing."""
    def commit_nodes(batch: DataFrame, _: int) -> None:
        store.merge(nodes=batch)

    def commit_edges(batch: DataFrame, _: int) -> None:
        store.merge(edges=batch)

    started = []
    for name, df, commit in (("nodes", nodes, commit_nodes), ("edges", edges, commit_edges)):
        if df is not None:
            started.append(df.writeStream.foreachBatch(commit).option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start())
            started[-1].awaitTermination()
    return started


def stream_points(points: DataFrame, store: CollectionStore, name: str, checkpoint: str):
    """Upsert a stream of points (POINTS columns and seq) into a collection."""
    def commit(batch: DataFrame, _: int) -> None:
        store.create_collection(name)
        store.create_data_points(name, batch)

    return points.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events by type and tumbling window; events later than the watermark are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
