"""N-gram Jaccard join by a count-vector R-tree.

Texts are sets of 4-word shingles; two sets link at a Jaccard similarity of 85 / 100 or more.
Points: shingles are hashed into groups, and a set's counts of its groups are a point.  The
overlap of two sets is at most the sum of the smaller count of each group, so a pair (a node) whose
sum of coordinate minima is too small holds no link.

Directory.  The groups are cut into segments, whose number follows from a size class (sizes of
a class differ by the ratio 0.85 at most, so links stay within a class and the next).  Linked sets differ in
at most T shingles, hence in at most T segments: of any T + 1 segments of the smaller set one is
met with equal counts.  A set is filed under all segments of its class, and asks with its T + 1
fullest ones there and in the next class; rows of a segment with equal counts form a node.
Sets that merely share a passage seldom agree on a whole segment.

Links.  Two rounds compare the rows of a node with one of them, a hub, and linked sets become
components.  Nodes that then hold several components are bulk-loaded as R-trees of the rows' counts
(boxes of LEAF points, boxes of boxes) and joined with themselves from the root: pairs of boxes, then of points, whose
summed minima or sizes exclude a link are dropped.  Large nodes are cut into tiles, and each
pair of tiles is a tree of its own.  Surviving pairs are verified on the whole sets.  Equal sets
are merged first: one row stands for all.

Shingles are compared by their XXH64, and sets that hash alike in 128 bits are equal.  Edge cases: a null
text and one without words have an empty set, linked with nothing; under four words the whole sequence is the
one shingle; rows that repeat a doc_id are texts of their own and share a component only if linked;
a null doc_id has no component, and makes none; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphvec.llm.near_copies import shingle_set
from graphvec.operators.components import components
from graphvec.storage import broadcast_if_small, discard, materialize

SHINGLE = 4
PERCENT = 85
SLICE_ROWS = 256
FINE = 256  # groups of a segment
COARSE = 64  # groups of a point in a tree
FINEST = 4096  # groups, at most, by which a tree's pairs are looked at again before they are sent
LEAF = 16  # points of a box, and boxes of a box above
TILE_ROWS = 2048
CROWD = 64  # rows; larger nodes do not send a pair that an earlier one sends
#: counts of a segment are told apart by their sum with these weights, modulo 2^64
WEIGHTS = np.random.default_rng(42).integers(0, 1 << 63, FINE, np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def linked(both: int | np.ndarray, n: int | np.ndarray, m: int | np.ndarray) -> bool | np.ndarray:
    return (100 + PERCENT) * both >= PERCENT * (n + m)


def most_apart(n: int) -> int:
    """In how many shingles two linked sets of n together differ at most."""
    return (100 - PERCENT) * n // (100 + PERCENT)


@functools.cache
def class_ends() -> np.ndarray:
    """Largest size of each class: a set and one that it links with are in one class or in neighbouring ones."""
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, 100 * ends[-1] // PERCENT))
    return np.array(ends, np.int64)


def segments_of(size_class: int) -> int:
    """A quarter more than a probe asks for, so that it can leave out its emptiest ones."""
    t = most_apart(2 * int(class_ends()[size_class]))
    return t + 1 + (t + 3) // 4 + (t > 0)


def segment_keys(s: np.ndarray, size_class: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, count) of each segment of a sorted set under a class's cut."""
    k = segments_of(size_class)
    at = ((s >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)  # segments are ranges of the hash
    ends = np.searchsorted(at, np.arange(k + 1, dtype=np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(WEIGHTS[(s & np.uint64(FINE - 1)).astype(np.int64)])))
    x = (sums[ends[1:]] - sums[ends[:-1]]) ^ ((np.arange(k, dtype=np.uint64) + np.uint64(size_class << 40)) * MIX)
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32)), np.diff(ends)


def filed(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, asks): all segments of the set's own class, of which the fullest ask, and those that
    ask in the next class."""
    n, ends = len(s), class_ends()
    own = int(np.searchsorted(ends, n))
    keys, asks = [], []
    for c in (own, own + 1) if 100 * n // PERCENT > ends[own] else (own,):
        key, count = segment_keys(s, c)
        t = most_apart(n + min(int(ends[c]), 100 * n // PERCENT))
        fullest = np.zeros(len(key), bool)
        fullest[np.argsort(-count, kind="stable")[: t + 1]] = True
        keys.append(key if c == own else key[fullest])
        asks.append(fullest if c == own else fullest[fullest])
    return np.concatenate(keys), np.concatenate(asks)


def point(s: np.ndarray, groups: int | None = None) -> np.ndarray:
    """Counts of the shingles by group: a power of two of groups, about 4 shingles in each."""
    groups = groups or max(COARSE, 1 << (len(s) // 4).bit_length())
    return np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.uint16 if len(s) < 1 << 16 else np.uint32)


def packed(s: np.ndarray) -> bytes:
    return point(s).tobytes()


def unpacked(p: bytes, n: int) -> np.ndarray:
    return np.frombuffer(p, np.uint16 if n < 1 << 16 else np.uint32)


def folded(p: np.ndarray, groups: int) -> np.ndarray:
    return p.astype(np.int64).reshape(-1, groups).sum(axis=0)


def most_common(a: np.ndarray, b: np.ndarray) -> int:
    """Sum of the coordinate minima; the finer point is folded to the other's groups."""
    groups = min(len(a), len(b))
    return int(np.minimum(folded(a, groups), folded(b, groups)).sum())


# --- the tree ------------------------------------------------------------------------------

def bulk_load(points: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(order, levels): rows sorted by recursive cuts at the median of the widest coordinate, and from
    the leaves to the root the largest counts and the smallest and largest size of each box."""
    order, cuts = np.arange(len(n)), [(0, len(n))]
    while cuts:
        a, b = cuts.pop()
        if b - a <= LEAF:
            continue
        rows = order[a:b]
        wide = int(np.argmax(points[rows].max(axis=0) - points[rows].min(axis=0)))
        order[a:b] = rows[np.argsort(points[rows, wide], kind="stable")]
        half = a + max(LEAF, (b - a) // 2 // LEAF * LEAF)
        cuts += [(a, half), (half, b)]
    levels, high, least, most = [], points[order], n[order], n[order]
    while len(high) > 1 or not levels:
        at = np.arange(0, len(high), LEAF)
        high, least, most = np.maximum.reduceat(high, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
        levels.append((high, least, most))
    return order, levels


def tree_pairs(points: np.ndarray, n: np.ndarray, chunk: int = 1 << 12) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows that their points and sizes let link, each once: the tree joined with itself."""
    if len(n) < 2:
        return
    order, levels = bulk_load(points, n)
    levels = [(points[order], n[order], n[order]), *levels]

    def meets(level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        high, least, most = levels[level]
        near = (100 * most[i] >= PERCENT * least[j]) & (100 * most[j] >= PERCENT * least[i])
        i, j = i[near], j[near]
        near[near] = linked(np.minimum(high[i], high[j]).sum(axis=1), least[i], least[j])
        return near

    todo = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        level, i, j = todo.pop()
        if len(i) > chunk:
            todo += [(level, i[at : at + chunk], j[at : at + chunk]) for at in range(0, len(i), chunk)]
            continue
        keep = meets(level, i, j)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if not level:
            yield order[i], order[j]
            continue
        below = len(levels[level - 1][1])
        step = np.arange(LEAF)
        a = np.repeat(i[:, None] * LEAF + step, LEAF, axis=1).ravel()
        b = np.tile(j[:, None] * LEAF + step, (1, LEAF)).ravel()
        live = (a < below) & (b < below) & (a <= b) & ((a < b) | (level > 1))  # a box meets itself, a point does not
        todo.append((level - 1, a[live], b[live]))


def _same_groups(points: list[np.ndarray]) -> np.ndarray:
    """[rows, groups]: points folded to the groups that all of them have, FINEST at most."""
    groups = min(FINEST, *map(len, points))
    return np.stack([folded(p, groups).astype(np.int32) for p in points])


def near_pairs(fine: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (i, j) that the finer counts let link as well.  Texts that share half of their shingles
    pass the tree's few groups, and there is a pair for every two of a crowd; so they are dropped where they meet."""
    step = max(1, (1 << 20) // fine.shape[1])
    keep = [linked(np.minimum(fine[i[at : at + step]], fine[j[at : at + step]]).sum(axis=1), n[i[at : at + step]], n[j[at : at + step]]) for at in range(0, len(i), step)]
    keep = np.concatenate([np.zeros(0, bool), *keep])
    return i[keep], j[keep]


# --- Spark ---------------------------------------------------------------------------------

def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            b = whole.slice(at, SLICE_ROWS)
            sets = [shingle_set(t, SHINGLE) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array(map(len, sets), pa.int64()), pa.array(map(packed, sets), pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "sig", "n", "point", "shingles"])


def _filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            b = whole.slice(at, SLICE_ROWS)
            rows = [filed(np.frombuffer(s, np.uint64)) for s in b.column(2).to_pylist()]
            times = [len(k) for k, _ in rows]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([k for k, _ in rows]).view(np.int64)), pa.array(np.repeat(np.asarray(b.column(0)), times)), pa.array(np.repeat(np.asarray(b.column(1)), times)),
                     pa.array(np.concatenate([a for _, a in rows]))], names=["key", "row", "n", "asks"])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, those that ask first -> the rows of nodes of at least two of which one asks."""
    carry, before = None, None  # the last row, not yet sent; the key sent last
    asked = False  # whether the node of the last row has one that asks
    for b in batches:
        if not b.num_rows:
            continue
        if carry is not None:
            b = pa.Table.from_batches([carry, b]).combine_chunks().to_batches()[0]
        key, asks = np.asarray(b.column(0)), b.column(3).to_numpy(zero_copy_only=False)
        edge = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(edge)[np.cumsum(edge) - 1]
        open_ = asks[first] | ((key == key[0]) & asked)
        same = ~edge[1:]
        keep = (np.concatenate(([before == key[0]], same)) | np.concatenate((same, [False]))) & open_
        carry, asked = b.slice(b.num_rows - 1), bool(open_[-1])
        if b.num_rows > 1:
            before = key[-2]
            yield b.slice(0, b.num_rows - 1).filter(pa.array(keep[:-1]))
    if carry is not None and asked and before == carry.column(0)[0].as_py():
        yield carry


def _with_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, those that ask first (key, row, n, label) -> pairs of a row and the first of its node."""
    hub = np.zeros((4, 0), np.int64)
    for b in batches:
        rows = np.concatenate([hub, np.stack([np.asarray(b.column(i)) for i in range(4)])], axis=1)
        if not rows.shape[1]:
            continue
        key, row, n, label = rows
        edge = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(edge)[np.cumsum(edge) - 1]
        near = (label != label[first]) & (100 * np.minimum(n, n[first]) >= PERCENT * np.maximum(n, n[first]))
        if near.any():
            uv = np.unique(np.stack([np.minimum(row, row[first])[near], np.maximum(row, row[first])[near]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(uv[0]), pa.array(uv[1])], names=["u", "v"])
        hub = rows[:, first[-1:]]


def _tree_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and tiles (key, tiles, own, row, n, label, asks, asked, shared, point) -> pairs to verify.
    Two rows may meet in many crowded nodes and tiles; the first of these sends the pair."""
    held: list[pa.RecordBatch] = []

    def solve(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        row, n, label, asks, own = (t.column(c).to_numpy() for c in ("row", "n", "label", "asks", "own"))
        crowd = pc.max(pc.list_value_length(t.column("shared"))).as_py()
        low, high = divmod(t.column("tiles")[0].as_py(), 1 << 31)
        fine = _same_groups([unpacked(p, k) for p, k in zip(t.column("point").to_pylist(), n.tolist())])
        for i, j in tree_pairs(fine.reshape(len(n), -1, COARSE).sum(axis=1, dtype=np.int64), n):
            good = (label[i] != label[j]) & (asks[i] | asks[j]) & ((own[i] != own[j]) | (low == high))
            i, j = near_pairs(fine, n, i[good], j[good])
            if len(i) and crowd:
                some, at = np.unique(np.concatenate([i, j]), return_inverse=True)
                asked, shared = ([frozenset(x) for x in t.column(c).take(pa.array(some)).to_pylist()] for c in ("asked", "shared"))
                first = np.array([asked[x].isdisjoint(shared[y]) and shared[x].isdisjoint(asked[y]) for x, y in at.reshape(2, -1).T.tolist()], bool)
                i, j = i[first], j[first]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(row[i], row[j])), pa.array(np.maximum(row[i], row[j]))], names=["u", "v"])

    for b in batches:
        key, tiles = np.asarray(b.column(0)), np.asarray(b.column(1))
        edges = np.flatnonzero((key[1:] != key[:-1]) | (tiles[1:] != tiles[:-1])) + 1
        for a, z in zip([0, *edges], [*edges, b.num_rows]):
            if held and z > a and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) != (int(key[a]), int(tiles[a])):
                yield from solve(held)
                held = []
            if z > a:
                held.append(b.slice(a, z - a))
    if held:
        yield from solve(held)


def _within_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, m = np.asarray(b.column(2)), np.asarray(b.column(3))
        both = [most_common(unpacked(x, k), unpacked(y, j)) for x, y, k, j in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), n.tolist(), m.tolist())]
        yield b.select(["u", "v"]).filter(pa.array(linked(np.array(both, np.int64), n, m), pa.bool_()))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            b = whole.slice(at, SLICE_ROWS)
            sets = [[np.frombuffer(x, np.uint64) for x in b.column(c).to_pylist()] for c in (2, 3)]
            good = [bool(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))) for x, y in zip(*sets)]
            yield b.select(["u", "v"]).filter(pa.array(good, pa.bool_()))


def _both(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    for c in "uv":
        pairs = pairs.join(rows.select(F.col("row").alias(c), *[F.col(x).alias(x + c) for x in columns]), c)
    return pairs.select("u", "v", *[x + c for x in columns for c in "uv"])


def verified(pairs: DataFrame, unique: DataFrame) -> DataFrame:
    """The linked ones of `pairs` (u, v): first by the points, then by the whole sets."""
    near = materialize(_both(pairs.distinct(), unique, "n", "point").mapInArrow(_within_bound, "u bigint, v bigint"), "near-pairs")
    asked = near.select(F.explode(F.array("u", "v")).alias("row")).distinct()
    sets = materialize(unique.join(broadcast_if_small(asked, 100_000), "row", "left_semi").select("row", "shingles"), "asked-sets")
    links = materialize(_both(near, sets, "shingles").mapInArrow(_verified, "u bigint, v bigint"), "links")
    discard(near, sets)
    return links


def _labelled(shared: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(components of `links`, rows of the nodes that hold several, with their labels)."""
    found = materialize(components(links), "components")
    named = shared.join(found.select(F.col("node").alias("row"), F.col("component").alias("label")), "row", "left").withColumn("label", F.coalesce("label", "row"))
    named = materialize(named.select("key", "row", "n", "label", "asks"), "labelled")
    several = named.groupBy("key").agg(F.count("*").alias("rows"), (F.min("label") < F.max("label")).alias("several")).where("several").select("key", "rows")
    return found, materialize(named.join(several, "key"), "open-nodes")


def _tiles(rows: DataFrame, unique: DataFrame, tile_rows: int) -> DataFrame:
    """Rows of nodes, with points; a node of over `tile_rows` is cut, and each pair of tiles is a group.  Half
    of a key names a node here; nodes that share a half are one.  In nodes of over CROWD rows, `shared` are such nodes of a row
    before this one, and `asked` those in which it asks; smaller ones send few pairs for a row."""
    d = rows.groupBy(F.shiftright("key", 32).cast("int").alias("key"), "row").agg(F.min("n").alias("n"), F.min("label").alias("label"), F.max("asks").alias("asks"))
    d = materialize(d, "half-keys")
    d = d.join(d.groupBy("key").agg(F.count("*").alias("rows")), "key")
    large = F.col("rows") > CROWD
    of_row = d.where(large).groupBy("row").agg(F.collect_list("key").alias("shared"), F.collect_list(F.when(F.col("asks"), F.col("key"))).alias("asked"))  # of one text
    d = d.withColumn("t", F.when(F.col("rows") > tile_rows, F.ceil(F.col("rows") / (tile_rows / 2))).otherwise(1).cast("int"))
    d = d.withColumn("own", F.pmod(F.xxhash64("row"), F.col("t")).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
    tiles = F.least("own", "b").cast("bigint") * F.lit(1 << 31) + F.greatest("own", "b")
    d = d.select("key", tiles.alias("tiles"), "own", "row", "n", "label", "asks", "rows").join(of_row, "row", "left").join(unique.select("row", "point"), "row")
    none = F.array().cast("array<int>")
    before = [F.when(large, F.filter(c, lambda k: k < F.col("key"))).otherwise(none).alias(c) for c in ("asked", "shared")]
    return d.select("key", "tiles", "own", "row", "n", "label", "asks", *before, "point").repartition("key", "tiles").sortWithinPartitions("key", "tiles")


def similar_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = d.mapInArrow(_sets, "doc_id bigint, sig binary, n bigint, point binary, shingles binary")
    sets = materialize(sets.withColumn("row", F.monotonically_increasing_id()), "sets")  # numbers hold once they are written
    named = sets.where("doc_id is not null and n > 0").select("row", "doc_id", "sig")
    owners = materialize(named.groupBy("sig").agg(F.min("row").alias("row"), F.min("doc_id").alias("least")), "owners")
    copies = materialize(named.join(owners.select("sig", F.col("row").alias("owner")), "sig").where("row <> owner").select("row"), "equal-sets")
    unique = sets.where("doc_id is not null and n > 0").join(broadcast_if_small(copies, 100_000), "row", "left_anti")

    nodes = unique.select("row", "n", "shingles").mapInArrow(_filed, "key bigint, row bigint, n bigint, asks boolean")
    nodes = nodes.repartition("key").sortWithinPartitions("key", F.desc("asks"), "row").mapInArrow(_asked, "key bigint, row bigint, n bigint, asks boolean")
    shared = materialize(nodes, "shared-nodes")

    hubs = shared.repartition("key").sortWithinPartitions("key", F.desc("asks"), "row").select("key", "row", "n", F.col("row").alias("label")).mapInArrow(_with_hub, "u bigint, v bigint")
    links = verified(hubs, unique)
    found, rest = _labelled(shared, links)
    # another hub for each node: a crowd of near copies has links to many of its members
    hubs = rest.repartition("key").sortWithinPartitions("key", F.desc("asks"), F.xxhash64("key", "row")).select("key", "row", "n", "label").mapInArrow(_with_hub, "u bigint, v bigint")
    links = links.unionAll(verified(hubs, unique))
    found, rest = _labelled(rest.drop("rows", "label"), links)
    pairs = _tiles(rest, unique, tile_rows).mapInArrow(_tree_join, "u bigint, v bigint")
    found = materialize(components(links.unionAll(verified(pairs, unique))), "components")

    labels = owners.join(found.withColumnRenamed("node", "row"), "row", "left").select("sig", "least", F.coalesce("component", "row").alias("component"))
    least = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = labels.join(least, "component").select("sig", "component_id")
    r = sets.select("doc_id", "sig", "n").join(labels, "sig", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return r.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
