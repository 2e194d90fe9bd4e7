"""Vector collections as Parquet folders under one root."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphvec.errors import CollectionNotFound, EngineInitialization
from graphvec.functions.text import payload_with_id
from graphvec.functions.vectors import PROFILES
from graphvec.operators import hybrid, inverted_file, vector
from graphvec.schema import POINTS
from graphvec.sources.commits import BUCKETS, Table, VersionedTables

#: profile name -> how that backend behaves (score profile, limits, missing collections, whether a hit's
#: payload gets its id, and `keep`: what a row of a batch search needs, given cosine and score)
ADAPTERS: dict[str, dict] = {}


def use_vector_adapter(name: str, **behaviour) -> None:
    ADAPTERS[name] = behaviour


use_vector_adapter("redis", profile="redis_norm", clamp=False, missing="empty", create=False, keep="1 - cosine < 0.1")
use_vector_adapter("qdrant", profile="distance", clamp=False, missing="empty", create=False, payload_id=True, keep="cosine > 0.9")
use_vector_adapter("opensearch", profile="opensearch", clamp=True, missing="raise", create=True)
use_vector_adapter("azureaisearch", profile="azure", clamp=True, missing="empty", create=True, payload_id=True)


POINT_TABLE = Table(POINTS, ["id"], vector.upsert)


class CollectionStore:
    """Create, fill, search and drop collections.  All collections of a root share one log of
    commits; an upsert or a deletion rewrites the buckets of the points it names."""

    def __init__(self, spark: SparkSession, root: str, embed=vector.hash_embedding, adapter: str = "qdrant", prefix: str = "", buckets: int = BUCKETS, history: bool = False):
        if not root or embed is None:
            raise EngineInitialization("a collection store needs a root and an embedder")
        if adapter not in ADAPTERS:
            raise EngineInitialization(f"no vector adapter {adapter!r}; known are {', '.join(sorted(ADAPTERS))}")
        self.spark, self.root, self.embed, self.prefix = spark, root.rstrip("/"), embed, prefix
        self.behaviour = ADAPTERS[adapter]
        self.log, self.history_kept = VersionedTables(spark, self.root, buckets), history

    def _name(self, name: str) -> str:
        return f"{self.prefix}_{name}".lower() if self.prefix else name

    def has_collection(self, name: str) -> bool:
        return self._name(name) in self.log.names()

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The collection as it is, or as it was at a version."""
        if self._name(name) not in self.log.names(version):
            raise CollectionNotFound(name)
        return self.log.read(self._name(name), POINT_TABLE, version)

    def create_collection(self, name: str) -> None:
        if not self.has_collection(name):
            self.log.commit(lambda tables: ({self._name(name): {}, **tables}, None))

    def create_vector_index(self, index: str, field: str) -> None:
        self.create_collection(f"{index}_{field}")

    def index_data_points(self, index: str, field: str, rows: DataFrame) -> None:
        self.create_vector_index(index, field)
        self._upsert(f"{index}_{field}", vector.index_points(rows, self.embed).withColumn("seq", F.lit(0)), "seq")

    def create_data_points(self, name: str, points: DataFrame, seq: str = "seq") -> None:
        """Upsert `points`; a collection that is not there is made or an error, as the backend has it."""
        if self.behaviour["create"]:
            self.create_collection(name)
        elif not self.has_collection(name):
            raise CollectionNotFound(name)
        self._upsert(name, points, seq)

    def _upsert(self, name: str, points: DataFrame, seq: str) -> None:
        self.log.apply({self._name(name): (POINT_TABLE, points.select(*POINTS.names, F.col(seq).cast("bigint").alias("seq")), None)})

    def retrieve(self, name: str, ids: DataFrame) -> DataFrame:
        return vector.retrieve(self.read(name), ids)

    def delete_data_points(self, name: str, ids: DataFrame) -> int:
        """How many rows went."""
        deleted = self.read(name).join(ids.select("id"), "id", "left_semi").count()
        self.log.apply({self._name(name): (POINT_TABLE, None, ids.select("id"))})
        return deleted

    def search(self, name: str, vector_: list[float] | None = None, text: str | None = None, limit: int | None = vector.DEFAULT_LIMIT) -> DataFrame:
        """(id, score, payload) of the closest points."""
        embed = lambda texts: [r[0] for r in self.spark.createDataFrame([(t,) for t in texts], "t string").select(self.embed(F.col("t"))).collect()]
        if not self.has_collection(name):
            if self.behaviour["missing"] == "raise":
                raise CollectionNotFound(name)
            return self.spark.createDataFrame([], "id string, score double, payload string")
        hits = vector.search(self.read(name), vector_, text, embed, limit, self.behaviour["profile"], self.behaviour["clamp"], with_payload=True)
        self._note("search", name, text, limit)
        return self._payload(hits).select("id", "score", "payload")

    def _payload(self, hits: DataFrame) -> DataFrame:
        return hits.withColumn("payload", payload_with_id(F.col("payload"), F.col("id"))) if self.behaviour.get("payload_id") else hits

    def _note(self, kind: str, name: str, text: str | None, limit: int | None) -> None:
        if self.history_kept:
            row = self.spark.createDataFrame([(kind, self._name(name), text, limit)], "kind string, collection string, text string, n int").withColumn("at", F.current_timestamp())
            row.coalesce(1).write.mode("append").parquet(f"{self.root}/history")

    def history(self) -> DataFrame:
        """(kind, collection, text, n, at): the searches made with a store that keeps its history."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/history")
        schema = "kind string, collection string, text string, n int, at timestamp"
        there = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.root}/history") if there else self.spark.createDataFrame([], schema)

    def _found(self, name: str, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The collection, and queries (qid, text) or (qid, vector) with vectors."""
        if not self.has_collection(name):
            if self.behaviour["missing"] == "raise":
                raise CollectionNotFound(name)
            points = self.spark.createDataFrame([], POINTS)
        else:
            points = self.read(name)
        return points, queries if "vector" in queries.columns else queries.withColumn("vector", self.embed(F.col("text")))

    def build_index(self, name: str, **options) -> dict:
        """Store a vector index of the collection as it is; what it holds is returned.  Writing to the
        collection makes it out of date, and searches exact, until it is built again."""
        version, at = self.log.version(), f"data/{uuid.uuid4().hex}"
        about = inverted_file.build(self.read(name, version), f"{self.root}/{at}", **options)
        self.log.commit(lambda tables: ({**tables, f"{self._name(name)}#index": {"index": at, "of": f"version/{version}"}}, None))
        return about

    def _index(self, name: str) -> str | None:
        """Where the collection's index is, if it is there and the collection is what it was."""
        tables = self.log.entry(self.log.version())["tables"]
        index = tables.get(f"{self._name(name)}#index")
        if not index:
            return None
        then = self.log.entry(int(index["of"].split("/")[1]))["tables"].get(self._name(name))
        return f"{self.root}/{index['index']}" if then == tables.get(self._name(name)) else None

    def batch_search(self, name: str, queries: DataFrame, limit: int | None = vector.DEFAULT_LIMIT, with_vectors: bool = False, indexed: bool = False) -> DataFrame:
        """(qid, id, score, rank, payload[, vector]) for queries (qid, text) or (qid, vector): the
        closest rows of each, less those that the backend's `keep` rules out; with `indexed` those that an up-to-date index finds."""
        points, q = self._found(name, queries)
        k, path = vector.effective_limit(limit, self.behaviour["clamp"]), self._index(name) if indexed else None
        asked = q.select("qid", "vector")
        hits = inverted_file.search(self.spark, path, asked, k) if path and k else vector.batch_search(points, asked, k)
        hits = hits.withColumn("score", PROFILES[self.behaviour["profile"]](F.col("cosine"))).where(self.behaviour.get("keep", "true"))
        self._note("batch", name, None, limit)
        hits = hits.join(points.select("id", "payload", *(["vector"] if with_vectors else [])), "id")
        return self._payload(hits).select("qid", "id", "score", "rank", "payload", *(["vector"] if with_vectors else []))

    def hybrid_search(self, name: str, queries: DataFrame, limit: int | None = vector.DEFAULT_LIMIT) -> DataFrame:
        """(qid, id, score, rank, payload) for queries (qid, text[, vector]): ranks of the words
        and of the vectors, fused."""
        points, q = self._found(name, queries)
        k = vector.effective_limit(limit, self.behaviour["clamp"])
        words = hybrid.bm25(points.select("id", "text"), q.select("qid", "text"), k)
        fused = hybrid.fuse(words, vector.batch_search(points, q.select("qid", "vector"), k), k)
        self._note("hybrid", name, None, limit)
        return self._payload(fused.join(points.select("id", "payload"), "id")).select("qid", "id", "score", "rank", "payload")

    def prune(self) -> None:
        """Drop every collection of this store (and prefix), and the files that no collection has any
        more; readers of older versions must have ended."""
        mine = self._name("") if self.prefix else ""
        self.log.commit(lambda tables: ({n: f for n, f in tables.items() if not n.startswith(mine)}, None))
        self.log.vacuum()
