"""A property graph kept as two Parquet tables, and its node-link JSON form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphvec.errors import EngineInitialization
from graphvec.functions.text import canonical_id, parse_time
from graphvec.operators.mutate import upsert_edges, upsert_nodes
from graphvec.schema import EDGE_KEY, EDGES, NODES
from graphvec.sources.commits import BUCKETS, Table, VersionedTables
from graphvec.storage import remove

_FIXED = {"id", "source", "target", "key", "updated_at"}


def empty_graph(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame([], NODES), spark.createDataFrame([], EDGES)


def read_node_link(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a node-link document.  Ids that are UUIDs are put in canonical form;
    times may be epoch milliseconds or ISO texts.  A document that is not JSON, or whose times
    cannot be read, raises; nothing is overwritten."""
    schema = T.StructType([T.StructField("nodes", T.ArrayType(T.MapType(T.StringType(), T.StringType()))), T.StructField("links", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])
    doc = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)

    def rows(column: str) -> DataFrame:
        return doc.select(F.posexplode(column).alias("ord", "m")).withColumn("ord", F.col("ord").cast("bigint"))

    def time(m):
        raw = m["updated_at"]
        parsed = parse_time(raw)
        return F.when(raw.isNull() | parsed.isNotNull(), parsed).otherwise(F.raise_error(F.concat(F.lit("unreadable time "), raw)).cast("timestamp"))

    m = F.col("m")
    props = F.map_filter(m, lambda k, _: ~k.isin(*_FIXED))
    nodes = rows("nodes").select(canonical_id(m["id"]).alias("id"), "ord", m["type"].alias("type"), m["name"].alias("name"), time(m).alias("updated_at"), props.alias("props"))
    edges = rows("links").select(
        canonical_id(m["source"]).alias("src"), canonical_id(m["target"]).alias("dst"), m["key"].alias("key"), "ord", m["relationship_name"].alias("relationship_name"),
        m["relationship_type"].alias("relationship_type"), time(m).alias("updated_at"), props.alias("props"))
    return nodes, edges


def write_node_link(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """The graph as one JSON document, a line for each node and edge in order.  The lines are
    made and sorted in parallel; one task only copies them into the single file."""
    attributes = F.coalesce("props", F.create_map().cast("map<string,string>"))

    def lines(df: DataFrame, section: int, names: dict[str, str]) -> DataFrame:
        millis = F.unix_millis("updated_at").cast("string")
        fixed = F.map_from_arrays(F.array(*[F.lit(n) for n in [*names, "updated_at"]]), F.array(*[F.col(c).cast("string") for c in names.values()], millis))
        own = F.map_concat(F.map_filter(attributes, lambda k, _: ~k.isin(*names, "updated_at")), F.map_filter(fixed, lambda _, v: v.isNotNull()))
        return df.select(F.lit(section).alias("section"), "ord", F.to_json(own).alias("line"))

    spark = nodes.sparkSession
    n = lines(nodes, 1, {"id": "id", "type": "type", "name": "name"})
    e = lines(edges, 3, {"source": "src", "target": "dst", "key": "key", "relationship_name": "relationship_name", "relationship_type": "relationship_type"})
    heads = spark.createDataFrame(
        [(0, 0, '{"directed": true, "multigraph": true, "graph": {}, "nodes": ['), (2, 0, '], "links": ['), (4, 0, "]}")], "section int, ord bigint, line string")
    first = {1: nodes.agg(F.min("ord")).first()[0], 3: edges.agg(F.min("ord")).first()[0]}
    body = n.unionAll(e).withColumn("line", F.when(
        ((F.col("section") == 1) & (F.col("ord") == F.lit(first[1]))) | ((F.col("section") == 3) & (F.col("ord") == F.lit(first[3]))), F.col("line")
    ).otherwise(F.concat(F.lit(","), "line")))
    heads.unionAll(body).orderBy("section", "ord").select("line").coalesce(1).write.mode("overwrite").text(path)


NODE_TABLE = Table(NODES, ["id"], upsert_nodes)
EDGE_TABLE = Table(EDGES, EDGE_KEY, upsert_edges)
TABLES = {"nodes": NODE_TABLE, "edges": EDGE_TABLE}


class GraphStore:
    """Versions of (nodes, edges) under `root`.  A commit names all files of a version at once, so
    readers never see half a write, and a writer that was overtaken starts again from the newer
    version.  `save` writes a whole graph, `merge` and `delete_nodes` only the buckets they change."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = VersionedTables(spark, self.root, buckets)

    def load(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The last committed graph, or that of a version; an empty one before the first commit."""
        version = self.log.version() if version is None else version
        return tuple(self.log.read(name, table, version) for name, table in TABLES.items())

    def save(self, nodes: DataFrame, edges: DataFrame) -> int:
        return self.log.replace({"nodes": (NODE_TABLE, nodes), "edges": (EDGE_TABLE, edges)})

    def merge(self, nodes: DataFrame | None = None, edges: DataFrame | None = None) -> int:
        """Upsert nodes and edges in one commit; returns its version."""
        return self.log.apply({n: (TABLES[n], df, None) for n, df in (("nodes", nodes), ("edges", edges)) if df is not None})

    def delete_nodes(self, ids: DataFrame) -> int:
        """Delete the nodes of `ids` (id) and their edges in one commit; returns its version."""
        edges = self.load()[1]
        ends = [edges.join(ids.select(F.col("id").alias(side)), side, "left_semi").select(*EDGE_KEY) for side in ("src", "dst")]
        return self.log.apply({"nodes": (NODE_TABLE, None, ids.select("id")), "edges": (EDGE_TABLE, None, ends[0].unionByName(ends[1]))})

    def delete(self) -> None:
        """Drop the graph and the files of all its versions: the next load is empty."""
        self.log.replace({"nodes": (NODE_TABLE, None), "edges": (EDGE_TABLE, None)})
        remove(self.spark, self.root, ["data"])

    def query(self, sql: str) -> DataFrame:
        """Extension: SQL over the views nodes and edges."""
        nodes, edges = self.load()
        nodes.createOrReplaceTempView("nodes")
        edges.createOrReplaceTempView("edges")
        return self.spark.sql(sql)


#: graph adapters by name
GRAPH_ADAPTERS: dict[str, type] = {"tables": GraphStore}


def use_graph_adapter(name: str, adapter: type) -> None:
    """Make `adapter(spark, root)` known as a graph store."""
    GRAPH_ADAPTERS[name] = adapter


def graph_store(name: str, spark: SparkSession, root: str):
    if name not in GRAPH_ADAPTERS:
        raise EngineInitialization(f"no graph adapter {name!r}; known are {', '.join(sorted(GRAPH_ADAPTERS))}")
    return GRAPH_ADAPTERS[name](spark, root)
