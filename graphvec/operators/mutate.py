"""Graph upserts and deletions: every function takes tables and returns the table after."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphvec.schema import EDGE_KEY


def latest_attributes(rows: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """rows (keys, attr, value, seq) -> the value of the highest seq of each attribute.  A later
    null wins too: it travels inside a struct, which is not null itself."""
    won = rows.groupBy(*keys, "attr").agg(F.max_by(F.struct("value"), seq).alias("_v"))
    return won.select(*keys, "attr", F.col("_v.value").alias("value"))


def _upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], hot: Sequence[str]) -> DataFrame:
    """Key-wise merge: columns and attributes that `new` gives replace those of `old`.  Of rows
    of `new` with equal keys the highest ord is the latest; the first ord of a key stays."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    seq = F.struct("_age", "ord")
    props = both.select(*keys, F.struct("_age", "ord").alias("seq"), F.explode("props").alias("attr", "value"))
    merged = latest_attributes(props, keys).groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("attr", "value")))).alias("props"))
    rows = both.groupBy(*keys).agg(
        F.min_by("ord", seq).alias("ord"), *[F.max_by(c, F.when(F.col(c).isNotNull(), seq)).alias(c) for c in hot], F.max_by("updated_at", seq).alias("updated_at"))
    empty = F.create_map().cast("map<string,string>")
    return rows.join(merged, list(keys), "left").withColumn("props", F.coalesce("props", empty)).select(*old.columns)


def upsert_nodes(nodes: DataFrame, new: DataFrame) -> DataFrame:
    return _upsert(nodes, new, ["id"], ["type", "name"])


def upsert_edges(edges: DataFrame, new: DataFrame) -> DataFrame:
    """Keyed by (src, dst, key); updated_at is now, whatever the input says.  The three parts
    of the key must be there: one bad row fails the whole batch."""
    bad = F.col("src").isNull() | F.col("dst").isNull() | F.col("key").isNull()
    checked = new.withColumn("src", F.when(bad, F.raise_error(F.lit("an edge needs source, target and relationship"))).otherwise(F.col("src")))
    return _upsert(edges, checked.withColumn("updated_at", F.current_timestamp()), EDGE_KEY, ["relationship_name", "relationship_type"])


def edges_from_tuples(spark, rows: Sequence[tuple]) -> DataFrame:
    """Edges from (source, target, relationship[, properties]); all are checked first."""
    import json

    from graphvec.schema import EDGES

    out = []
    for i, row in enumerate(rows):
        if len(row) not in (3, 4):
            raise ValueError(f"edge {i} has {len(row)} parts, not 3 or 4")
        src, dst, key = (str(x) if type(x).__name__ == "UUID" else x for x in row[:3])
        if not all(isinstance(x, str) for x in (src, dst, key)):
            raise ValueError(f"edge {i}: source, target and relationship must be texts")
        props = dict(row[3]) if len(row) == 4 and row[3] else {}
        out.append((src, dst, key, i, props.get("relationship_name"), props.get("relationship_type"), None, {k: json.dumps(v, default=str) for k, v in props.items()}))
    return spark.createDataFrame(out, EDGES)


def delete_nodes(nodes: DataFrame, edges: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Without the nodes of `ids` (id) and their edges; unknown ids are ignored."""
    left = edges.join(ids.select(F.col("id").alias("src")), "src", "left_anti").join(ids.select(F.col("id").alias("dst")), "dst", "left_anti")
    return nodes.join(ids, "id", "left_anti"), left.select(*edges.columns)


def cut_from_predecessors(edges: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """Without the edges (any -> id) of that key."""
    hit = ids.select(F.col("id").alias("dst"), F.lit(label).alias("key"))
    return edges.join(hit, ["dst", "key"], "left_anti").select(*edges.columns)


def cut_to_successors(edges: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """Without the edges (id -> any) of that key."""
    hit = ids.select(F.col("id").alias("src"), F.lit(label).alias("key"))
    return edges.join(hit, ["src", "key"], "left_anti").select(*edges.columns)
