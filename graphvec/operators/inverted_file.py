"""A stored vector index: an inverted file whose cells are partitions.

Centroids come from k-means on directions over a bounded sample (at most SAMPLE rows, chosen by
a hash of the id); a round is one Spark job that adds up the sample's vectors by cell.  Then every
row is filed under its COPIES nearest centroids: `codes` holds its vector as bytes, partitioned by cell, `rows` the
vectors themselves, in buckets by id.  A query reads the codes of the cells next to it, which partition pruning
finds, keeps its best candidates, and only these are looked up in `rows` and scored exactly.

How many cells a query needs depends on how the vectors lie.  `build` measures that: for sample rows taken as queries it
compares the cells of their true neighbours in the sample with the order in which a query
would visit them, and keeps the smallest number of cells that reaches the wanted recall.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphvec.functions.vectors import cosine
from graphvec.operators.vector import _matrix, _normalised
from graphvec.storage import materialize

SAMPLE = 50_000
CALIBRATION = 256  # sample rows taken as queries
MAX_CELLS = 4096
COPIES = 2
ROUNDS = 8
WIDER = 6  # candidates looked up for each row asked for
BUCKETS = 64


def _directions(column: pa.Array, dim: int) -> np.ndarray:
    return np.nan_to_num(_normalised(_matrix(column, dim)))


def _nearest(v: np.ndarray, centroids: np.ndarray, k: int) -> np.ndarray:
    return np.argsort(-(v @ centroids.T), axis=1, kind="stable")[:, :k]


def centroids_of(sample: DataFrame, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """`cells` directions of `sample` (id, vector), from its first rows by id hash on."""
    start = sample.orderBy(F.xxhash64("id"), "id").limit(cells).select("vector").toArrow()  # at most MAX_CELLS rows
    dim = len(start.column(0)[0])
    c = _directions(start.column(0).combine_chunks(), dim)
    for _ in range(rounds):
        held = sample.sparkSession.sparkContext.broadcast(c)  # MAX_CELLS vectors at most

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(held.value)
            for b in batches:
                v = _directions(b.column(0), dim)
                np.add.at(total, _nearest(v, held.value, 1)[:, 0], v)
            met = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(list(total[met]), pa.list_(pa.float64()))], names=["cell", "total"])

        parts = sample.select("vector").mapInArrow(sums, "cell bigint, total array<double>").toArrow()  # a row for each cell and task
        new = np.zeros_like(c)
        np.add.at(new, parts.column("cell").to_numpy(), np.array(parts.column("total").to_pylist(), np.float64).reshape(-1, dim))
        empty = ~new.any(axis=1)
        new[empty] = c[empty]
        c = np.round(_normalised(new), 9)
    return c


def _cells_needed(sample: np.ndarray, c: np.ndarray, k: int, recall: float, copies: int) -> int:
    """Fewest cells in which sample rows, as queries, find `recall` of their k nearest others."""
    asked = sample[:: max(1, len(sample) // CALIBRATION)]
    near = np.argsort(-(asked @ sample.T), axis=1)[:, 1 : k + 1]
    place = np.empty((len(asked), len(c)), np.int64)
    np.put_along_axis(place, np.argsort(-(asked @ c.T), axis=1, kind="stable"), np.arange(len(c))[None, :].repeat(len(asked), 0), axis=1)
    own = _nearest(sample, c, copies)
    first = np.stack([place[i][own[near[i]]].min(axis=1) for i in range(len(asked))])  # when a neighbour is met first
    return int(np.sort(first.ravel())[min(first.size - 1, math.ceil(recall * first.size))]) + 1 if first.size else 1


def build(points: DataFrame, path: str, cells: int | None = None, recall: float = 0.97, k: int = 10, copies: int = COPIES) -> dict:
    """Write an index of `points` (id, vector) under `path`; what it holds is returned.  Rows without a vector, and
    zero vectors, are left out.  An empty table gives an index that finds nothing."""
    spark = points.sparkSession
    rows = points.select("id", "vector").where("vector is not null and exists(vector, x -> x <> 0)")
    n = rows.count()
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int")
    rows.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/rows")
    every = max(1, math.ceil(n / SAMPLE))
    sample = materialize(rows.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(every)) == 0), "index-sample")
    held = sample.orderBy("id").limit(2 * SAMPLE).select("vector").toArrow()  # the bounded sample
    copies = copies if n > 1 else 1
    cells = min(cells or max(1, math.isqrt(2 * n)), MAX_CELLS, max(1, held.num_rows))
    c = centroids_of(sample, cells) if n else np.zeros((1, 1))
    copies = min(copies, len(c))
    flat = held.column(0).combine_chunks() if n else pa.array([], pa.list_(pa.float32()))
    probes = _cells_needed(_directions(flat, c.shape[1]), c, k, recall, copies) if n > 1 else 1
    kept = spark.sparkContext.broadcast(c)
    kind = points.schema["id"].dataType.simpleString()

    def file_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _directions(b.column(1), kept.value.shape[1])
            own = _nearest(v, kept.value, copies)
            scale = np.abs(v).max(axis=1, keepdims=True) / 127
            code = np.round(v / np.where(scale > 0, scale, 1)).astype(np.int8)
            for j in range(copies):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in code], pa.binary()), pa.array(own[:, j], pa.int32())], names=["id", "code", "cell"])

    filed = rows.mapInArrow(file_rows, f"id {kind}, code binary, cell int")
    salt = F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(n / len(c) / 1_000_000)))).alias("salt")  # a cell of many rows is several files
    filed.repartition("cell", salt).write.partitionBy("cell").parquet(f"{path}/codes")
    about = {"rows": n, "cells": len(c), "copies": copies, "probes": probes, "id": kind}
    spark.createDataFrame([(json.dumps(about), [x.tolist() for x in c])], "about string, centroids array<array<double>>").coalesce(1).write.parquet(f"{path}/index")
    return about


def read_about(spark: SparkSession, path: str) -> tuple[dict, np.ndarray]:
    r = spark.read.parquet(f"{path}/index").first()
    return json.loads(r["about"]), np.array(r["centroids"], np.float64)


def probed(queries: DataFrame, c: np.ndarray, probes: int) -> DataFrame:
    """(qid, vector, cells): the cells that each query visits."""
    kept = queries.sparkSession.sparkContext.broadcast(c)
    kind = queries.schema["qid"].dataType.simpleString()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _directions(b.column(1), kept.value.shape[1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(v), pa.list_(pa.float64())), pa.array(list(_nearest(v, kept.value, probes).astype(np.int32)), pa.list_(pa.int32()))], names=["qid", "vector", "cells"])

    return queries.where("vector is not null").select("qid", "vector").mapInArrow(visit, f"qid {kind}, vector array<double>, cells array<int>")


def search(spark: SparkSession, path: str, queries: DataFrame, limit: int = 15, probes: int | None = None, block: int = 2048) -> DataFrame:
    """(qid, id, cosine, rank): the closest rows that the index finds for `queries` (qid, vector), with
    exact scores.  Queries go in blocks of bounded size; a block reads its own cells only."""
    about, c = read_about(spark, path)
    asked = materialize(probed(queries, c, min(probes or about["probes"], len(c))), "probes")
    kind, dim = asked.schema["qid"].dataType.simpleString(), c.shape[1]
    found = None
    blocks = max(1, math.ceil(asked.count() / block))
    for i in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i).toArrow()  # one block of queries
        by_cell: dict[int, list[int]] = {}
        for q, cells in enumerate(rows.column("cells").to_pylist()):
            for cell in cells:
                by_cell.setdefault(cell, []).append(q)
        v = np.array(rows.column("vector").to_pylist(), np.float64).reshape(-1, dim)
        held = spark.sparkContext.broadcast((rows.column("qid").combine_chunks(), v, {x: np.array(y) for x, y in by_cell.items()}))
        take = limit * WIDER

        def candidates(batches: Iterator[pa.RecordBatch], held=held, take=take) -> Iterator[pa.RecordBatch]:
            names, v, by_cell = held.value
            for b in batches:
                cells = b.column(2).to_numpy()
                for cell in np.unique(cells):
                    at, qs = np.flatnonzero(cells == cell), by_cell.get(int(cell))
                    if qs is None:
                        continue
                    code = np.frombuffer(b"".join(b.column(1).take(pa.array(at)).to_pylist()), np.int8).reshape(-1, v.shape[1])
                    score = v[qs] @ _normalised(code.astype(np.float64)).T
                    best = np.argpartition(-score, min(take, score.shape[1]) - 1, axis=1)[:, :take]
                    row = np.repeat(np.arange(len(qs)), best.shape[1])
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(qs[row])), b.column(0).take(pa.array(at[best.ravel()])), pa.array(score[row, best.ravel()])], names=["qid", "id", "near"])

        codes = spark.read.schema(f"id {about['id']}, code binary, cell int").parquet(f"{path}/codes").where(F.col("cell").isin(sorted(by_cell)))
        best = codes.select("id", "code", "cell").mapInArrow(candidates, f"qid {kind}, id {about['id']}, near double").groupBy("qid", "id").agg(F.max("near").alias("near"))
        w = Window.partitionBy("qid").orderBy(F.desc("near"), "id")
        best = best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= take).select("qid", "id")
        found = best if found is None else found.unionAll(best)
    full = spark.read.schema(f"id {about['id']}, vector array<float>, bucket int").parquet(f"{path}/rows").select("id", F.col("vector").alias("own"))
    scored = found.join(asked.select("qid", "vector"), "qid").join(full, "id").select("qid", "id", cosine(F.col("vector"), F.col("own")).alias("cosine"))
    w = Window.partitionBy("qid").orderBy(F.desc(F.round("cosine", 12)), "id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def rows_read(spark: SparkSession, path: str, queries: DataFrame, probes: int | None = None) -> DataFrame:
    """(qid, codes, share): how many codes each query reads, and how large a part of all rows that is."""
    about, c = read_about(spark, path)
    sizes = spark.read.parquet(f"{path}/codes").groupBy("cell").agg(F.count("*").alias("n"))
    cells = probed(queries, c, min(probes or about["probes"], len(c))).select("qid", F.explode("cells").alias("cell"))
    return cells.join(F.broadcast(sizes), "cell").groupBy("qid").agg(F.sum("n").alias("codes")).withColumn("share", F.col("codes") / about["rows"])  # a row a cell
