"""SimHash near-duplicates by a segment-popcount embedding.

Fingerprint: XXH64 of every 4-word shingle, bit set where over half of the hashes have it.
Embedding: the 64 bits are cut into 32 segments of 2 bits; a segment's popcount (0 to 2) is one
axis, so a fingerprint is a point of a 32-dimensional grid, and the Manhattan distance of two
points is at most their Hamming distance.  Range join: the axes form three blocks.  Points at
Manhattan distance 4 or less differ by at most 1 in some block, hence in at most one axis of
it; each point is filed once per axis under its block's other coordinates (32 cells a point),
and two linked points meet in a cell.  In a cell the Manhattan bound over bytes drops most
pairs, and the bits of an XOR decide the rest.

A cell sends on a spanning forest of its links, never its pairs.  Cells over CELL_ROWS are cut
into tiles, and each pair of tiles is one task-sized group, so no cell lands in one task.
Equal fingerprints are merged first.  Components come from star contraction over the links between fingerprints.

Edge cases: null and word-less texts have fingerprint zero and link like others; a text of
under 4 words is one shingle; repeated rows share a fingerprint; rows that share a doc_id but not the
text are linked by their fingerprints only; a row with a null doc_id
gets a fingerprint but takes no part in links, its component is null; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphvec.llm.near_copies import near_copies
from graphvec.operators.components import components
from graphvec.storage import broadcast_if_small, materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
CELL_ROWS = 4096
BLOCKS = ((0, 11), (11, 22), (22, 32))  # axes of the three blocks


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = len(words) - shingle + 1
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[i : i + (1 << 14)], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def cell_keys(fp: np.ndarray) -> np.ndarray:
    """[n, 32] cells of each fingerprint: block coordinates with one axis left free."""
    f = fp.view(np.uint64)
    pairs = (f & np.uint64(0x5555555555555555)) + ((f >> np.uint64(1)) & np.uint64(0x5555555555555555))  # 2 bits an axis
    out = []
    for k, (a, b) in enumerate(BLOCKS):
        block = (pairs >> np.uint64(2 * a)) & np.uint64((1 << 2 * (b - a)) - 1)
        for axis in range(b - a):
            out.append((block & ~np.uint64(3 << 2 * axis)) | np.uint64((k << 40) | (axis << 32)))
    return np.stack(out, axis=1).view(np.int64)


def _file_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            b = whole.slice(at, 4096)
            fp, rep = (np.asarray(b.column(i)) for i in (0, 1))
            keys = cell_keys(np.ascontiguousarray(fp))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(fp, keys.shape[1])), pa.array(np.repeat(rep, keys.shape[1]))], names=["cell", "fp", "rep"])


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of a[i] and b[i] for all i, in place; a label is the smallest row of its set."""
    while True:
        la, lb = labels[a], labels[b]
        if not (la != lb).any():
            return
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def links_in_groups(group: np.ndarray, fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by group -> a spanning forest (rows i, j) of the links within groups."""
    n = len(fp)
    labels = np.arange(n)
    counts = np.bitwise_count(fp.view(np.uint8).reshape(-1, 8)).astype(np.int8)  # sums of four axes each
    live = np.arange(n)
    d = 0
    while True:
        d += 1
        live = live[live + d < n]
        live = live[group[live] == group[live + d]]
        if not len(live):
            break
        for at in range(0, len(live), 1 << 16):
            i = live[at : at + (1 << 16)]
            near = np.abs(counts[i] - counts[i + d]).sum(axis=1) <= max_bits  # the Manhattan bound
            i = i[near]
            i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= max_bits]
            if len(i):
                _merge(labels, i, i + d)
    i = np.flatnonzero(labels != np.arange(n))
    return i, labels[i]


def _link(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def solve(rows: np.ndarray) -> pa.RecordBatch | None:
            cell, tiles, fp, rep = rows
            edge = (cell[1:] != cell[:-1]) | (tiles[1:] != tiles[:-1])
            group = np.concatenate(([0], np.cumsum(edge)))
            i, j = links_in_groups(group, np.ascontiguousarray(fp).view(np.uint64), max_bits)
            u, v = np.maximum(rep[i], rep[j]), np.minimum(rep[i], rep[j])
            uv = np.unique(np.stack([u, v]), axis=1) if len(u) else np.zeros((2, 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(uv[0]), pa.array(uv[1])], names=["u", "v"])

        for b in batches:
            rows = np.stack([np.asarray(b.column(i)) for i in range(4)])
            held.append(rows)
            if sum(x.shape[1] for x in held) < 50_000:
                continue
            rows = np.concatenate(held, axis=1)
            last = np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on in the next batch
            held = [rows[:, cut:]]
            if cut:
                yield solve(rows[:, :cut])
        if held and (rows := np.concatenate(held, axis=1)).shape[1]:
            yield solve(rows)

    return run


def links(points: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """points (fp, rep), fp distinct -> links (u, v) between reps that connect just what
    linked fingerprints connect.  Right for max_bits up to 5: three blocks share the distance."""
    if max_bits > 5:
        raise ValueError("three blocks of axes bound a distance of at most 5")
    filed = points.select("fp", "rep").mapInArrow(_file_in_cells, "cell bigint, fp bigint, rep bigint")
    sizes = filed.groupBy("cell").count().where(F.col("count") > cell_rows)
    hot = materialize(sizes.select("cell", F.ceil(F.col("count") / (cell_rows / 2)).cast("int").alias("n")), "cells")
    dealt = filed.join(broadcast_if_small(hot, 100_000), "cell", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    dealt = dealt.withColumn("t", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    tiles = F.least("t", "o").cast("bigint") * F.lit(1 << 31) + F.greatest("t", "o")
    dealt = dealt.select("cell", tiles.alias("tiles"), "fp", "rep")
    return dealt.repartition("cell", "tiles").sortWithinPartitions("cell", "tiles").mapInArrow(_link(max_bits), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `docs`."""
    fps = materialize(fingerprints(docs, text_col, id_col), "fingerprints")
    points = materialize(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    found = materialize(components(links(points.select("fp", F.col("fp").alias("rep")), max_bits)), "fingerprint-groups")
    named = points.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fp", "component_id")
    r = fps.join(named, "fp", "left")
    return r.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def near_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(node, component) of the doc_ids that have near copies: linked by SimHash fingerprints, or by
    the exact check that follows, which finds what a distance of 4 bits is too narrow for."""
    near = near_duplicates(docs, text_col, id_col).where("doc_id <> component_id").select(F.col("doc_id").alias("u"), F.col("component_id").alias("v"))
    exact = near_copies(docs, text_col, id_col).where("doc_id <> component_id").select(F.col("doc_id").alias("u"), F.col("component_id").alias("v"))
    return components(materialize(near, "simhash-links").unionAll(exact))


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`docs` with the smallest doc_id of each group of texts whose 5-word shingles have a Jaccard
    similarity of 0.8 or more (near_copies)."""
    ids = near_copies(docs, text_col, id_col).where("doc_id = component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return _first_rows(docs, ids, text_col, id_col)


def keep_one_linked(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`docs` with the smallest doc_id of each of near_groups."""
    later = materialize(near_groups(docs, text_col, id_col).where("node <> component").select(F.col("node").alias(id_col)), "later-copies")
    ids = docs.where(F.col(id_col).isNotNull()).select(id_col).distinct().join(later, id_col, "left_anti")
    return _first_rows(docs, ids, text_col, id_col)


def _first_rows(docs: DataFrame, ids: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """The rows of `docs` with one of `ids`, one row each; null ids all stay.  Of rows that repeat
    a doc_id the one with the smallest text stays, and of equal texts the one with the smallest
    other columns, as JSON."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, id_col)]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias(id_col), F.col(text_col).alias("text"), F.to_json(F.struct(F.lit(0), *rest)).alias("rest"))
    first = F.row_number().over(Window.partitionBy(id_col).orderBy("text", "rest"))
    kept = rows.join(ids, id_col, "left_semi").withColumn("first", first).where("first = 1").select("row.*")
    return kept.unionAll(docs.where(F.col(id_col).isNull()))
