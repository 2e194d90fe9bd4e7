"""Near copies by exact Jaccard similarity of word shingles.

Two texts are linked if their sets of 5-word shingles have a Jaccard similarity of 4/5 or more.
A SimHash distance does not find these: at 0.8 two fingerprints differ by about 9.7 of 64 bits
with a deviation of 2.9, and no range join is selective at the 18 bits that would catch them.

1 Equal sets are merged: one row, the smallest doc_id's, stands for all.
2 Prefix filter.  Under one order of all shingles, two linked sets share a shingle among the
  first n - ceil(4n/5) + 1 of each, whatever the order is.  Shingles that are frequent in a
  sample come last, so that common lines seldom bring texts together.
3 Texts that share such a shingle are compared: first all with the smallest doc_id of the
  shingle, then, after linked texts have become components, all pairs in different components.
  Crowded shingles are cut into tiles.  A pair first meets a bound that loses none: each set
  has parities of its hashes, at least BITS, and two sets differ in at least as many shingles as bits.
  Rows of a shingle of over CROWD texts carry their parities, folded to BITS, into the tiles, so
  that of a large group of half-alike texts only pairs within the bound leave a task.
  Every pair that stays is verified on the whole sets.

Shingles are compared by their XXH64, 64 bits.  Edge cases: null and word-less texts have equal,
empty sets; a text of under 5 words is one shingle; a null doc_id takes no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphvec.llm.suffix_dedup import _dropping_shuffles
from graphvec.operators.components import components
from graphvec.storage import broadcast_if_small, discard, materialize

SHINGLE = 5
SIMILAR = (4, 5)  # Jaccard similarity as a fraction
SEED = 42
CELL_ROWS = 4096
SAMPLE = 5000  # texts whose shingles are counted
FREQUENT = 5  # texts of the sample that make a shingle frequent
SLICE_ROWS = 256
BITS = 1024
CROWD = 32  # texts of a shingle from which on parities travel with its rows


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())], np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SIMILAR[1] * both >= SIMILAR[0] * (len(a) + len(b) - both)


def parities(s: np.ndarray) -> bytes:
    bits = max(BITS, 1 << (2 * len(s)).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Parities that differ; the longer row of bits is folded to the length of the other."""
    x, y = sorted((np.frombuffer(v, np.uint64) for v in (a, b)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def folded(bits: bytes) -> bytes:
    """BITS parities of any number of them."""
    y = np.frombuffer(bits, np.uint64)
    while len(y) > BITS // 64:
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return y.tobytes()


def prefix_length(n: int) -> int:
    return n + (-SIMILAR[0] * n) // SIMILAR[1] + 1 if n else 0


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            b = whole.slice(at, SLICE_ROWS)
            sets = [shingle_set(t) for t in b.column(1).to_pylist()]
            sigs = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sigs, pa.binary()), pa.array(map(len, sets), pa.int32()), pa.array(map(parities, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["rep", "sig", "n", "bits", "shingles"])


def _all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in b.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s, np.int64))], names=["key"])


def _prefixes(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = frequent.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                held, sizes = [], []
                for s in b.column(1).to_pylist():
                    s = np.frombuffer(s, np.int64)
                    often = np.zeros(len(s), np.int64)
                    if len(keys) and len(s):
                        k = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                        often = np.where(keys[k] == s, counts[k], 0)
                    held.append(s[np.lexsort((s, often))[: prefix_length(len(s))]])
                    sizes.append(len(s))
                times = [len(x) for x in held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(held)), pa.array(np.repeat(np.asarray(b.column(0)), times)), pa.array(np.repeat(np.array(sizes, np.int32), times))],
                    names=["key", "rep", "n"])

    return run


def _drop_single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and rep -> those whose key another row has."""
    carry = None  # the last row, and whether its key came before it
    for b in batches:
        if not b.num_rows:
            continue
        if carry is not None:
            b = pa.Table.from_batches([carry[0], b]).combine_chunks().to_batches()[0]
        key = np.asarray(b.column(0))
        same = key[1:] == key[:-1]
        keep = np.concatenate(([carry is not None and carry[1]], same)) | np.concatenate((same, [False]))
        carry = b.slice(b.num_rows - 1), bool(keep[-1])
        if b.num_rows > 1:
            yield b.slice(0, b.num_rows - 1).filter(pa.array(keep[:-1]))
    if carry is not None and carry[1]:
        yield carry[0]


def _near(rep: np.ndarray, n: np.ndarray, label: np.ndarray, i: np.ndarray, j: np.ndarray, bits: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Pairs (i, j) of rows whose sizes and parities allow a link and whose components differ."""
    near = (label[i] != label[j]) & (SIMILAR[1] * np.minimum(n[i], n[j]) >= SIMILAR[0] * np.maximum(n[i], n[j]))
    i, j = i[near], j[near]
    if bits is not None and len(i):
        apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
        near = (SIMILAR[1] + SIMILAR[0]) * apart <= (SIMILAR[1] - SIMILAR[0]) * (n[i] + n[j])
        i, j = i[near], j[near]
    if len(i):
        uv = np.unique(np.stack([np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(uv[0]), pa.array(uv[1])], names=["u", "v"])


def _with_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key (key, rep, n) -> pairs of each row and the first row of its key."""
    hub = np.zeros((3, 0), np.int64)
    for b in batches:
        rows = np.concatenate([hub, np.stack([np.asarray(b.column(i)).astype(np.int64) for i in range(3)])], axis=1)
        if not rows.shape[1]:
            continue
        key, rep, n = rows
        edge = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(edge)[np.cumsum(edge) - 1]
        yield from _near(rep, n, rep, first, np.arange(len(key)))
        hub = rows[:, first[-1:]]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and tiles (key, tiles, rep, n, label, bits) -> all pairs to verify."""
    held: list[np.ndarray] = []
    none = bytes(BITS // 8)  # equal parities, which exclude nothing

    def solve(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, tiles, rep, n, label = rows[:5]
        bits = np.ascontiguousarray(rows[5:].T).view(np.uint64)
        group = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]) | (tiles[1:] != tiles[:-1]))))
        live, d = np.arange(len(rep)), 0
        while len(live):
            d += 1
            live = live[live + d < len(rep)]
            live = live[group[live] == group[live + d]]
            yield from _near(rep, n, label, live, live + d, bits)

    for b in batches:
        bits = np.frombuffer(b"".join(x or none for x in b.column(5).to_pylist()), np.int64).reshape(-1, BITS // 64)
        held.append(np.concatenate([np.stack([np.asarray(b.column(i)).astype(np.int64) for i in range(5)]), bits.T]))
        if sum(x.shape[1] for x in held) < 50_000:
            continue
        rows = np.concatenate(held, axis=1)
        last = np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))
        cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on in the next batch
        held = [rows[:, cut:]]
        if cut:
            yield from solve(rows[:, :cut])
    if held and (rows := np.concatenate(held, axis=1)).shape[1]:
        yield from solve(rows)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            b = whole.slice(at, SLICE_ROWS)
            good = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield b.select(["u", "v"]).filter(pa.array(good, pa.bool_()))


def _within_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        n = np.asarray(b.column(2)).astype(np.int64) + np.asarray(b.column(3))
        apart = np.array([differing(x, y) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist())], np.int64)
        yield b.select(["u", "v"]).filter(pa.array((SIMILAR[1] + SIMILAR[0]) * apart <= (SIMILAR[1] - SIMILAR[0]) * n))


def _both(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    for c in "uv":
        pairs = pairs.join(rows.select(F.col("rep").alias(c), *[F.col(x).alias(x + c) for x in columns]), c)
    return pairs.select("u", "v", *[x + c for x in columns for c in "uv"])


def verified(pairs: DataFrame, unique: DataFrame) -> DataFrame:
    """The linked ones of `pairs`; whole sets are read only for pairs within the bound."""
    bound = _both(pairs.distinct(), unique, "n", "bits").mapInArrow(_within_bound, "u bigint, v bigint")
    near = materialize(bound.distinct(), "near-pairs")
    asked = near.select(F.explode(F.array("u", "v")).alias("rep")).distinct()
    sets = unique.join(broadcast_if_small(asked, 100_000), "rep", "left_semi").select("rep", "sig", "shingles").dropDuplicates(["rep", "sig"])
    sets = materialize(sets, "asked-sets")
    links = materialize(_both(near, sets, "shingles").mapInArrow(_verify, "u bigint, v bigint"), "near-links")
    discard(near, sets)
    return links


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(folded, b.column(1).to_pylist()), pa.binary())], names=["rep", "bits"])


def _dealt(rows: DataFrame, unique: DataFrame, cell_rows: int) -> tuple[DataFrame, tuple[DataFrame, ...]]:
    """(key, tiles, rep, n, label, bits): crowded keys are cut into tiles; each pair of tiles is a
    group.  A rep of several texts has a row for the parities of each.  With the tables written for it."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("rows"), (F.min("label") < F.max("label")).alias("open"))
    sizes = materialize(sizes.where("open").select("key", F.when(F.col("rows") > cell_rows, F.ceil(F.col("rows") / (cell_rows / 2))).otherwise(1).cast("int").alias("t"), (F.col("rows") > CROWD).alias("crowd")), "cells")
    sized = dealt = materialize(rows.join(broadcast_if_small(sizes, 100_000), "key"), "sized")
    bits = unique.select("rep", "bits").mapInArrow(_folded, "rep bigint, bits binary")
    dealt = dealt.where("not crowd").withColumn("bits", F.lit(None).cast("binary")).unionByName(dealt.where("crowd").join(bits, "rep"))
    dealt = dealt.withColumn("a", F.pmod(F.xxhash64("rep"), F.col("t")).cast("int"))
    dealt = dealt.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
    tiles = F.least("a", "b").cast("bigint") * F.lit(1 << 31) + F.greatest("a", "b")
    return dealt.select("key", tiles.alias("tiles"), "rep", "n", "label", "bits").repartition("key", "tiles").sortWithinPartitions("key", "tiles"), (sizes, sized)


def near_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", cell_rows: int = CELL_ROWS) -> DataFrame:
    """(doc_id, component_id) for every row of `docs` with a doc_id."""
    spark = docs.sparkSession
    d = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with _dropping_shuffles(spark):
        sets = materialize(d.mapInArrow(_sets, "rep bigint, sig binary, n int, bits binary, shingles binary"), "sets")
        least = materialize(sets.groupBy("sig").agg(F.min("rep").alias("least")), "set-owners")
        copies = materialize(sets.select("rep", "sig").join(least, "sig").where("rep <> least").select("rep", "sig").distinct(), "equal-sets")
        unique = sets.join(broadcast_if_small(copies, 100_000), ["rep", "sig"], "left_anti")

        every = max(1, least.count() // SAMPLE)
        sample = unique.where(F.pmod(F.xxhash64("sig"), F.lit(every)) == 0).select("shingles").mapInArrow(_all_shingles, "key bigint")
        often = sorted((r[0], r[1]) for r in sample.groupBy("key").count().where(F.col("count") >= FREQUENT).collect())
        frequent = spark.sparkContext.broadcast(tuple(np.array([r[k] for r in often], np.int64) for k in (0, 1)))

        filed = unique.select("rep", "shingles").mapInArrow(_prefixes(frequent), "key bigint, rep bigint, n int")
        filed = filed.repartition("key").sortWithinPartitions("key", "rep")
        shared = materialize(filed.mapInArrow(_drop_single, "key bigint, rep bigint, n int"), "shared-shingles")

        hubs = shared.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(_with_first, "u bigint, v bigint")
        links = verified(hubs, unique)
        found = materialize(components(links), "near-components")

        named = shared.join(found.select(F.col("node").alias("rep"), F.col("component").alias("label")), "rep", "left")
        named = materialize(named.select("key", "rep", "n", F.coalesce("label", "rep").alias("label")), "labelled")
        discard(shared, found)
        dealt, written = _dealt(named, unique, cell_rows)
        links = links.unionAll(verified(dealt.mapInArrow(_pairs, "u bigint, v bigint"), unique))
        discard(named, *written)
        found = materialize(components(links), "near-components")
        owners = least.join(found.withColumnRenamed("node", "least"), "least", "left").select("sig", F.coalesce("component", "least").alias("component_id"))
        out = materialize(sets.select(F.col("rep").alias("doc_id"), "sig").join(owners, "sig").select("doc_id", "component_id"), "near-copies")
        discard(sets, least, copies, links, found)
        return out
