"""Extension: weakly connected components kept while edges stream in.

A node gets a label once, and `roots` says which component a label belongs to.  A batch's edges
meet the stored labels of their ends; components of the (few) components that they join give the
new roots.  Only rows of new nodes, and roots that change, are written: a merge of two large
components rewrites roots, not nodes.  A component is named by its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphvec.operators.components import components
from graphvec.sources.commits import BUCKETS, Table, VersionedTables
from graphvec.storage import broadcast_if_small, materialize


def _newer(key: str):
    return lambda old, new: old.join(new.select(key), key, "left_anti").unionByName(new)


LABELS = Table(T.StructType([T.StructField("node", T.StringType()), T.StructField("label", T.StringType())]), ["node"], _newer("node"))
ROOTS = Table(T.StructType([T.StructField("label", T.StringType()), T.StructField("component", T.StringType())]), ["label"], _newer("label"))


class StreamedComponents:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.log = spark, VersionedTables(spark, root, buckets)

    def current(self) -> DataFrame:
        """(node, component) of every node met so far."""
        version = self.log.version()
        return self.log.read("labels", LABELS, version).join(self.log.read("roots", ROOTS, version), "label").select("node", "component")

    def add(self, edges: DataFrame) -> int:
        """Take in edges (u, v): one commit, whose version is returned.  A self-loop makes its node known;
        edges with a null end are left out; a batch that comes again changes nothing."""
        version = self.log.version()
        e = materialize(edges.select(F.col("u").cast("string").alias("u"), F.col("v").cast("string").alias("v")).where("u is not null and v is not null").distinct(), "batch")
        met = e.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        roots = self.log.read("roots", ROOTS, version)
        known = met.join(self.log.read("labels", LABELS, version), "node", "left").join(roots, "label", "left")
        known = materialize(known.select("node", "label", F.coalesce("component", "node").alias("component")), "batch-nodes")
        ends = e
        for side in "uv":
            ends = ends.join(known.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side)
        joined = materialize(components(ends.select(F.col("cu").alias("u"), F.col("cv").alias("v"))), "batch-components")
        moved = joined.where("node <> component").select(F.col("node").alias("component"), F.col("component").alias("to"))
        old = roots.join(broadcast_if_small(moved, 100_000), "component").select("label", F.col("to").alias("component"))
        fresh = known.where("label is null").select("node", "component")
        first = fresh.join(moved, "component", "left").select(F.col("node").alias("label"), F.coalesce("to", "component").alias("component"))
        return self.log.apply({"labels": (LABELS, fresh.select("node", F.col("node").alias("label")), None), "roots": (ROOTS, materialize(old.unionByName(first), "new-roots"), None)})


def stream_components(edges: DataFrame, store: StreamedComponents, checkpoint: str):
    """Feed a stream of edges (u, v) into `store`; it must be its only writer."""
    return edges.writeStream.foreachBatch(lambda batch, _: store.add(batch) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
