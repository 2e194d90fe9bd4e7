"""Vector collections: upsert, lookup, exact and approximate cosine search.

A collection is a table (id, text, vector, payload).  One query is a scoring expression and a
top-k that Spark keeps per task.  Many queries go in blocks: a block of query vectors is a
matrix of bounded size, each batch of rows is multiplied with it, and a batch sends on its own
best k of each query only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphvec.errors import InvalidValue
from graphvec.functions.vectors import PROFILES, cosine

DEFAULT_LIMIT = 15
MAX_LIMIT = 10_000
QUERY_BLOCK = 2048
SCORE_ROWS = 64  # queries whose scores with a batch are held at a time
JOIN_BLOCK = 20_000  # rows of one side of a similarity join's group


def upsert(collection: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Whole rows replace rows of the same id; of several new ones the highest `seq` wins."""
    cols = collection.columns
    both = collection.withColumn("_s", F.lit(-1).cast("bigint")).unionAll(new.select(*cols, F.col(seq).cast("bigint").alias("_s")))
    return both.groupBy("id").agg(F.max_by(F.struct(*cols), "_s").alias("r")).select("r.*")


def retrieve(collection: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, payload, score 0) of the known ids; missing ones are left out."""
    return ids.join(collection.select("id", "payload"), "id").withColumn("score", F.lit(0.0))


def delete(collection: DataFrame, ids: DataFrame) -> DataFrame:
    return collection.join(ids.select("id"), "id", "left_anti")


def effective_limit(limit: int | None, clamp: bool = False) -> int:
    """None is the default; without `clamp` nothing is found below 1, with it at least 1 and at
    most MAX_LIMIT rows are."""
    k = DEFAULT_LIMIT if limit is None else limit
    return min(max(k, 1), MAX_LIMIT) if clamp else max(k, 0)


def search(collection: DataFrame, vector: Sequence[float] | None = None, text: str | None = None, embed=None, limit: int | None = DEFAULT_LIMIT,
           profile: str = "distance", clamp: bool = False, with_payload: bool = False) -> DataFrame:
    """(id, score[, payload]) of the closest rows; ties go by id.  A vector wins over a text."""
    if vector is None and text is None:
        raise InvalidValue("give a query text or a query vector")
    if vector is None:
        vector = embed([text])[0]
    q = F.lit([float(x) for x in vector])
    c = collection.select("id", *(["payload"] if with_payload else []), cosine(F.col("vector"), q).alias("_c")).where(F.col("_c").isNotNull())
    scored = c.withColumn("score", PROFILES[profile](F.col("_c")))
    return scored.orderBy(F.desc("_c"), "id").limit(effective_limit(limit, clamp)).drop("_c")


def _normalised(v: np.ndarray) -> np.ndarray:
    n = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, n, out=np.full_like(v, np.nan), where=n > 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array column in double precision; null or odd-sized ones become zeros."""
    if column.null_count == 0 and len(column.flatten()) == dim * len(column) and column.flatten().null_count == 0:
        offsets = np.diff(np.asarray(column.offsets))
        if (offsets == dim).all():
            return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    rows = [x if x is not None and len(x) == dim and None not in x else [0.0] * dim for x in column.to_pylist()]
    return np.array(rows, np.float64).reshape(-1, dim)


def batch_search(collection: DataFrame, queries: DataFrame, limit: int | None = DEFAULT_LIMIT, min_cosine: float | None = None, block: int = QUERY_BLOCK) -> DataFrame:
    """(qid, id, cosine, rank) for each of `queries` (qid, vector): its closest `limit` rows, and
    of these only those above `min_cosine`."""
    k = effective_limit(limit)
    blocks = max(1, math.ceil(queries.count() / block))
    found = [_block_search(collection, queries.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i), k) for i in range(blocks)]
    w = Window.partitionBy("qid").orderBy(F.desc(F.round("cosine", 12)), "id")
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked if min_cosine is None else ranked.where(F.col("cosine") > min_cosine)


def _best(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the best k of each row, and of all that tie with the k-th; not a number counts as none."""
    np.copyto(score, -np.inf, where=np.isnan(score))
    if score.shape[1] <= k:
        return np.nonzero(score > -np.inf)
    least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k, None] - 1e-12
    return np.nonzero((score >= least) & (score > -np.inf))


def _block_search(collection: DataFrame, queries: DataFrame, k: int, planes: np.ndarray | None = None) -> DataFrame:
    """(qid, id, cosine) of each batch's best; with `planes` only of the rows in near buckets."""
    rows = queries.where("vector is not null").select("qid", "vector").toArrow()  # one block of queries
    id_type, qid_type = collection.schema["id"].dataType.simpleString(), queries.schema["qid"].dataType.simpleString()
    schema = f"qid {qid_type}, id {id_type}, cosine double"
    spark = collection.sparkSession
    if not rows.num_rows or not k:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast((rows.column("qid").combine_chunks(), _normalised(np.array(rows.column("vector").to_pylist(), np.float64)), planes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q, planes = held.value
        asked = _codes(q, planes) if planes is not None else None
        for b in batches:
            ids, rows = b.column(0), _normalised(_matrix(b.column(1), q.shape[1])).T
            codes = _codes(rows.T, planes) if planes is not None else None
            for a in range(0, len(q), SCORE_ROWS):  # a slice of the scores at a time
                part = q[a : a + SCORE_ROWS] @ rows
                if planes is not None:
                    part[~_near_buckets(asked[:, a : a + SCORE_ROWS], codes, planes.shape[1])] = np.nan
                row, col = _best(part, k)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(row + a)), ids.take(pa.array(col)), pa.array(part[row, col])], names=["qid", "id", "cosine"])

    return collection.select("id", "vector").mapInArrow(run, schema)


def similarity_edges(points: DataFrame, threshold: float, block_rows: int | None = None) -> DataFrame:
    """(u, v, cosine) for all u < v above the threshold, exact.  Rows are dealt into blocks and
    each pair of blocks is one group, so a group's size does not grow with the table.  A row goes to as
    many groups as there are blocks, so blocks are as large as a task may hold; small tables have smaller ones, to
    keep tasks busy.  A group compares slices and sends on each one's links at once."""
    n = points.count()
    blocks = math.ceil(n / block_rows) if block_rows else max(math.ceil(n / JOIN_BLOCK), min(math.ceil(n / 500), 12))
    blocks = max(1, blocks)
    p = points.select("id", "vector").withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    p = p.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    p = p.select("id", "vector", "b", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"))
    id_type = points.schema["id"].dataType.simpleString()

    def pairs(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        ids, home = t.column("id").combine_chunks(), t.column("b").to_numpy()
        column = t.column("vector").combine_chunks()
        dim = max((len(x) for x in column if x.is_valid), default=0)
        v = _normalised(_matrix(column, dim))
        i, j = (k.as_py() for k in key)
        left, right = np.flatnonzero(home == i), np.flatnonzero(home == j)
        others = v[right].T
        for at in range(0, len(left), 128):
            c = v[left[at : at + 128]] @ others
            a, b = np.nonzero(c > threshold)  # not a number: a zero or odd-sized vector
            u, w = ids.take(pa.array(left[at + a])), ids.take(pa.array(right[b]))
            out = pa.RecordBatch.from_arrays([pc.min_element_wise(u, w), pc.max_element_wise(u, w), pa.array(c[a, b])], names=["u", "v", "cosine"])
            yield out.filter(pc.less(u, w) if i == j else pc.not_equal(u, w))

    return p.groupBy("i", "j").applyInArrow(pairs, f"u {id_type}, v {id_type}, cosine double")


def approximate_search(collection: DataFrame, queries: DataFrame, limit: int = DEFAULT_LIMIT, tables: int = 24, bits: int = 8, seed: int = 42, block: int = QUERY_BLOCK) -> DataFrame:
    """(qid, id, cosine, rank) from rows that share a random-hyperplane bucket with the query
    in one of `tables` tables or sit one bit away; scores are exact.  Queries go in blocks, as in
    batch_search: a batch of rows meets their buckets where it is, so no pair of a query and a row is shuffled but a batch's best."""
    first = collection.where("vector is not null").select("vector").first()
    dim = len(first["vector"]) if first else 1  # an empty collection gives no rows
    planes = np.random.default_rng(seed).normal(size=(tables, bits, dim))
    blocks = max(1, math.ceil(queries.count() / block))
    found = [_block_search(collection, queries.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i), limit, planes) for i in range(blocks)]
    w = Window.partitionBy("qid").orderBy(F.desc(F.round("cosine", 12)), "id")
    return reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def _codes(v: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[tables, n]: the bucket of each row in each table; a zero vector has those of no positive side."""
    sign = np.nan_to_num(v) @ planes.reshape(-1, planes.shape[2]).T > 0
    return np.ascontiguousarray((sign.reshape(len(v), *planes.shape[:2]) @ (1 << np.arange(planes.shape[1]))).T)


def _near_buckets(asked: np.ndarray, codes: np.ndarray, bits: int) -> np.ndarray:
    """[queries, rows]: whether a row is in a query's bucket, or one bit away, in some table."""
    met = np.zeros((asked.shape[1], codes.shape[1]), bool)
    near = np.array([0, *(1 << i for i in range(bits))])
    for q, c in zip(asked, codes):
        known, place = np.unique(c, return_inverse=True)
        wanted = np.isin(q[:, None] ^ known[None, :], near)  # buckets that have rows, not rows
        met |= wanted[:, place]
    return met


def hash_embedding(text: Column, dim: int = 64) -> Column:
    """Deterministic embedding of a text column without a model: signed word hashes summed into
    `dim` places, built from DataFrame functions."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    places = F.sequence(F.lit(0), F.lit(dim - 1))
    sign = lambda h: F.when(F.shiftright(h, 32).bitwiseAND(F.lit(1)) == 1, 1.0).otherwise(-1.0)
    return F.transform(places, lambda i: F.aggregate(F.filter(hashes, lambda h: F.pmod(h, F.lit(dim)) == i), F.lit(0.0), lambda acc, h: acc + sign(h)).cast("float"))


def index_points(rows: DataFrame, embed=hash_embedding) -> DataFrame:
    """rows (id, index_fields, <fields>) -> points whose text is the first index field."""
    fields = [c for c in rows.columns if c not in ("id", "index_fields")]
    named = F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), F.array(*[F.col(f).cast("string") for f in fields]))
    text = F.try_element_at(named, F.get("index_fields", 0))
    return rows.select(F.col("id").cast("string").alias("id"), text.alias("text"), embed(text).alias("vector"), F.to_json(F.struct("id", *fields)).alias("payload"))


