"""LM scoring by online logistic context mixing.

A text is a sequence of tokens (words, then an end).  A token is a string of bits: the path to
its leaf in a Huffman tree over the most frequent VOCAB training words, the end, and an escape;
an escaped word's bytes, closed by a space, follow bit by bit.  Each bit is predicted by
several predictors: the tree itself, and counts of (hashed context, node) pairs of the
training texts, with one and two words of context for tree bits and one to four bytes for
spelled ones.  The stretched predictions are mixed by weights; which set of weights is used
is gated by how often each hashed context was seen.  Start weights are learned online on a
sixteenth of the training texts, and of the training words, by hash: while they are learned, this share is
not in the context counts, so that the weights meet contexts as an unknown text does; once they are learned, its counts
are added.  These texts are dealt into lanes
by their own values, a lane learns from its texts in a fixed order, and lanes are averaged in whole
numbers, so a score does not depend on how the input is split.  The weights start
alike for every text and are refined as the text is read, after every CHUNK tokens (every byte of a spelled word), from
what was read only, so the product of the bit probabilities is the model's probability.

Counting: word and context counts are summed over the whole training part.  A training text's contexts are in
the counts that score it, a held-out text's are not.  Context counts live in hashed
tables of a fixed number of slots, so what is broadcast has a bound; tasks send compressed
blocks of their counts, those of the learning share apart, summed in two rounds in 64 bits.  The spelling counts take each distinct
training word once, listed or not.  Words outside the vocabulary meet the full word
counts in a join, and are spelled once for each distinct word met there.

Edge cases: a null or empty text is just its end token; without training rows N and V are 0
and only escapes and ends are coded; repeated rows are scored one by one; a null doc_id has a
null crc32 and belongs to the training part; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphvec.storage import discard, materialize

VOCAB = 1 << 16
LONGEST = 64  # bytes of a vocabulary word, which bounds what is broadcast
WORD_SLOTS = 1 << 21  # each of two tables
BYTE_SLOTS = 1 << 20  # each of four
BLOCK = 1 << 16
CHUNK = 48
PART = 60_000  # tokens scored at a time
TALLY_PART = 24_000  # tokens counted at a time
LEARN_PART = 4_000  # tokens, or bytes of words, by which start weights move at a time
LEARN_SHARE = 16  # one in so many training texts and words tells the start weights
SLICE_BYTES = 4 << 20  # text split into words at a time, unless one text is longer
END = b"\n"  # no word holds white space
LOG2 = float(np.log10(2.0))


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """`batch` in runs of rows whose texts have at most SLICE_BYTES, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after another, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    flat, counts = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)  # white space at an end leaves an empty word
    so_far = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    ends = np.cumsum(counts)
    return flat.filter(full).cast(pa.binary()), so_far[ends] - so_far[ends - counts]


def halves(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(0, the rows that are counted at once) and (1, the rows of the learning share) of `batch`,
    whose last column tells them apart."""
    share = pc.fill_null(batch.column(batch.num_columns - 1), False)
    for k, rows in ((0, pc.invert(share)), (1, share)):
        part = batch.filter(rows)
        if part.num_rows:
            yield k, part


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


# --- word counts ---------------------------------------------------------------------------


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) over column text of `train`, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        texts = 0
        for whole in batches:
            texts += whole.num_rows
            for b in slices(whole, 0):
                words, _ = words_of(b.column(0))
                held.append(pa.Table.from_struct_array(words.value_counts()).rename_columns(["word", "c"]))
                if sum(t.num_rows for t in held) > 800_000:
                    summed = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])
                    held = [summed]
                    if summed.num_rows > 400_000:
                        yield from summed.to_batches()
                        held = []
        held.append(pa.table({"word": pa.array([END], pa.binary()), "c": pa.array([texts], pa.int64())}))
        yield from pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"]).to_batches()

    return train.select("text").mapInArrow(run, "word binary, c bigint").where("c > 0").groupBy("word").agg(F.sum("c").alias("c"))


class Code:
    """Huffman code of the vocabulary; symbol 0 is the escape, 1 the end."""

    def __init__(self, top: list[tuple[bytes, int]], escape: int, end: int):
        self.words = [b"", END, *(w for w, _ in top)]
        weights = [max(1, escape), max(1, end), *(c for _, c in top)]
        n = len(weights)
        heap = [(w, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        total = np.zeros(2 * n - 1)
        total[:n] = weights
        parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int8)
        fresh = n
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            parent[i] = parent[j] = fresh
            side[j] = 1
            total[fresh] = a + b
            heapq.heappush(heap, (a + b, fresh))
            fresh += 1
        ones = np.zeros(2 * n - 1)
        right = np.flatnonzero(side)
        ones[parent[right]] = total[right]
        self.tree = np.zeros(n, np.float32)  # stretched share of ones, by inner node
        self.tree[: n - 1] = np.log(ones[n:] / (total[n:] - ones[n:]))
        nodes, bits, sizes = [], [], []
        root = 2 * n - 2
        for leaf in range(n):
            path = []
            i = leaf
            while i != root:
                path.append((int(parent[i]) - n, int(side[i])))
                i = int(parent[i])
            path.reverse()
            nodes += [p for p, _ in path]
            bits += [s for _, s in path]
            sizes.append(len(path))
        self.nodes, self.bits, self.sizes = np.array(nodes, np.int32), np.array(bits, np.int8), np.array(sizes, np.int64)
        self.mixed = (self.nodes.astype(np.uint64) + np.uint64(1)) * _M2
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1])).astype(np.int64)
        self.tree_at, self.sign_at = self.tree[self.nodes], np.float32(1) - np.float32(2) * self.bits
        self.logc = np.array([0.0, *np.log10(np.array([end, *(c for _, c in top)], float) + 1)])
        self.known = np.array([0, int(end > 0), *([1] * len(top))], np.int64)

    def listed(self) -> pa.Array:
        return pa.array(self.words[2:], pa.binary())

    def expand(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of code bits of each token, place of each bit in nodes and bits)."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return sizes, np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - sizes), sizes)


# --- hashed contexts -----------------------------------------------------------------------

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _slot(context: np.ndarray, mixed: np.ndarray, slots: int) -> np.ndarray:
    """Slot of each pair of a context's hash and a node times _M2."""
    h = context ^ mixed
    h *= _M1
    h >>= np.uint64(64 - slots.bit_length() + 1)
    return h.view(np.int64)


def word_contexts(ids: np.ndarray, starts: np.ndarray, before: tuple[int, int] = (0, 0)) -> list[np.ndarray]:
    """Hash of the one and of the two tokens before each token; texts begin at `starts`, and
    `before` stands before the first token of each."""
    wide = ids.astype(np.uint64)
    one, two = np.concatenate((wide[:1], wide[:-1])), np.concatenate((wide[:2], wide[:-2]))[: len(wide)]
    second = starts + 1
    two[second[second < len(wide)]] = before[1]
    one[starts], two[starts] = before[1], before[0]
    one_hash, two_hash = (one + np.uint64(1 << 40)) * _M1, ((one + np.uint64(1)) * _M2 ^ (two + np.uint64(1)) * _M1) * _M2
    return [h ^ h >> np.uint64(31) for h in (one_hash, two_hash)]


def byte_bits(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(word, place of the byte, node times _M2, bit) of each bit of the words' bytes and
    closing spaces, and the hashes of the one to four bytes before; by place, then word."""
    raw = np.frombuffer(b"".join(w + b" " for w in words), np.uint8)
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    contexts, so_far = [], np.zeros(len(raw), np.uint64)
    by_place = np.argsort(place, kind="stable")
    for order in range(1, 5):
        earlier = np.zeros(len(raw), np.uint64)
        earlier[order:] = raw[:-order]
        earlier[place < order] = 0
        so_far = (so_far * np.uint64(257) + earlier + np.uint64(order)) * _M1
        so_far ^= so_far >> np.uint64(31)
        contexts.append(np.repeat(so_far[by_place], 8))
    raw = raw[by_place]
    values = raw.astype(np.int64)
    bits = np.unpackbits(raw[:, None], axis=1)
    nodes = np.stack([(values | 256) >> (8 - k) for k in range(8)], axis=1).astype(np.uint64)
    return np.repeat(word[by_place], 8), np.repeat(place[by_place], 8), (nodes.ravel() + np.uint64(1)) * _M2, bits.ravel(), contexts


class Tally:
    """Counts of zeros and ones by slot, sent on as compressed blocks."""

    def __init__(self, tables: int, slots: int):
        self.counts = np.zeros((tables, 2 * slots), np.uint32)
        self.added = 0

    def add(self, table: int, slot: np.ndarray, bit: np.ndarray) -> None:
        np.add.at(self.counts[table], 2 * slot + bit, np.uint32(1))
        self.added += len(slot)

    def overflow(self) -> Iterator[pa.RecordBatch]:
        """Sends the counts on before any of them could outgrow its 32 bits."""
        if self.added >= 1 << 31:
            yield from self.blocks()
            self.counts[:] = 0
            self.added = 0

    def blocks(self) -> Iterator[pa.RecordBatch]:
        for k, row in enumerate(self.counts):
            for at in range(0, len(row), BLOCK):
                part = row[at : at + BLOCK]
                if part.any():
                    yield _block(k, at // BLOCK, part)


def _block(table: int, block: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([table], pa.int32()), pa.array([block], pa.int32()), pa.array([zlib.compress(counts.astype(np.uint64).tobytes(), 1)], pa.binary())], names=["tab", "block", "counts"])


BLOCKS = "tab int, block int, counts binary"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the runs of equal (tab, block); one block is held at a time."""
    key, total = None, None
    for b in batches:
        for tab, block, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
            part = np.frombuffer(zlib.decompress(raw), np.uint64)
            if key != (tab, block):
                if key:
                    yield _block(*key, total)
                key, total = (tab, block), part.copy()
            else:
                total += part
    if key:
        yield _block(*key, total)


def packed(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Stretched share of ones in steps of 1/512 from -8 to 8, and in the two lowest bits how
    often the slot was seen: never, 1 to 3, 4 to 31 times, or more."""
    stretched = np.clip(np.log((n1 + 0.4) / (n0 + 0.4)), -8, 8 - 1 / 512)
    return (np.round(stretched * 512).astype(np.int16) << 2) | np.digitize(n0 + n1, (1, 4, 32)).astype(np.int16)


def added_up(blocks: DataFrame) -> DataFrame:
    """One block for each (tab, block): summed by groups of tasks and then over groups."""
    salted = blocks.withColumn("salt", F.spark_partition_id() % 32)
    first = salted.repartition("tab", "block", "salt").sortWithinPartitions("tab", "block", "salt").select("tab", "block", "counts").mapInArrow(_summed, BLOCKS)
    return first.repartition("tab", "block").sortWithinPartitions("tab", "block").mapInArrow(_summed, BLOCKS)


def gathered(blocks: DataFrame, tables: int, slots: int) -> np.ndarray:
    """Packed slots, [tables, slots], of blocks that stand by (tab, block); a fixed number of
    slots reaches the driver."""

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _summed(batches):
            for tab, block, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                n0, n1 = np.frombuffer(zlib.decompress(raw), np.uint64).reshape(-1, 2).astype(np.float64).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tab], pa.int32()), pa.array([block], pa.int32()), pa.array([zlib.compress(packed(n0, n1).tobytes(), 1)], pa.binary())], names=["tab", "block", "counts"])

    out = np.zeros((tables, slots), np.int16)
    half = BLOCK // 2
    for tab, block, raw in blocks.repartition("tab", "block").sortWithinPartitions("tab", "block").mapInArrow(learned, BLOCKS).toLocalIterator():
        part = np.frombuffer(zlib.decompress(raw), np.int16)
        out[tab, block * half : block * half + len(part)] = part
    return out


def with_share(blocks: DataFrame, tables: int) -> DataFrame:
    """The blocks of all training rows, from those without (tab below `tables`) and of the share."""
    return blocks.withColumn("tab", F.col("tab") % tables)


# --- mixing --------------------------------------------------------------------------------


def mix(inputs: list[np.ndarray], gate: np.ndarray, sign: np.ndarray, owner: np.ndarray, ends: np.ndarray, weights: np.ndarray, rate: float) -> np.ndarray:
    """log2 probability of each owner's bits; sign is 1 for a bit of 0 and -1 for a bit of 1.
    Rows stand by chunk, and `ends` says where each chunk ends.  weights: [owners, gates,
    inputs], refined in place after each chunk."""
    owners, gates, k = weights.shape
    flat = np.ascontiguousarray(weights.reshape(owners * gates, k).T)
    cells = owner * gates + gate
    against = np.empty(len(cells), np.float32)  # odds against the bit
    at = 0
    for end in ends:
        rows = slice(at, end)
        cell, s, odds = cells[rows], sign[rows], against[rows]
        x = [i[rows] for i in inputs]
        dot = flat[0].take(cell)
        dot *= x[0]
        for i in range(1, k):
            part = flat[i].take(cell)
            part *= x[i]
            dot += part
        np.clip(dot, -11, 11, out=dot)
        dot *= s
        np.exp(dot, out=odds)
        error = odds / (odds + np.float32(1))
        error *= s
        seen = np.sqrt(np.bincount(cell, minlength=owners * gates) + 16.0)
        for i in range(k):
            flat[i] -= rate * np.bincount(cell, error * x[i], owners * gates) / seen
        at = end
    weights[:] = flat.T.reshape(owners, gates, k)
    return np.bincount(owner, np.log1p(against), owners) / -np.log(2.0)


def _start(owners: int, starts: np.ndarray) -> np.ndarray:
    return np.repeat(starts[None].astype(np.float32), owners, axis=0)


def _word_starts() -> np.ndarray:
    """Weights by how often the one-word (rows of 4) and two-word contexts were seen."""
    w = np.zeros((16, 3))
    for a, b in itertools.product(range(4), range(4)):
        two, one = (0.0, 0.3, 0.4, 0.5)[b], (0.0, 0.16, 0.3, 0.42)[a]
        w[4 * a + b] = 1 - 0.5 * one - 0.6 * two, one, two
    return w


def _byte_starts() -> np.ndarray:
    """Weights by how often the two highest orders' contexts were seen."""
    w = np.zeros((16, 4))
    for a, b in itertools.product(range(4), range(4)):
        four = (0.0, 0.3, 0.5, 0.65)[b]
        three = (0.0, 0.3, 0.5, 0.6)[a] * (1 - 0.6 * four)
        w[4 * a + b] = 0.1, max(0.1, 0.9 - three - four), three, four
    return w


class WordModel:
    """Bits of the code, given the tokens before."""

    def __init__(self, code: Code, tables: np.ndarray, starts: np.ndarray, rate: float = 0.06):
        self.code, self.rate, self.tables, self.starts = code, rate, tables, starts

    def learn(self, texts: list[np.ndarray], seen: np.ndarray) -> None:
        """Moves the start weights by what texts outside the counts say, and adds to `seen` how
        many bits each set of weights met."""
        weights = self.starts[None].astype(np.float32)
        for text in texts:
            for at in range(0, len(text), LEARN_PART):
                before = tuple(np.concatenate((np.zeros(2, np.int64), text[:at]))[-2:])
                self._part([text[at : at + LEARN_PART]], before, weights, seen)
        self.starts = weights[0].astype(np.float64)

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """log2 probability of each text's code bits; long texts go in parts."""
        out = np.zeros(len(texts))
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= PART):
                size += len(texts[end])
                end += 1
            group = texts[at:end]
            weights = _start(len(group), self.starts)
            if size <= PART:
                out[at:end] = self._part(group, (0, 0), weights)
            else:
                before, ids = (0, 0), group[0]
                for i in range(0, len(ids), PART - PART % CHUNK):
                    piece = ids[i : i + PART - PART % CHUNK]
                    out[at] += self._part([piece], before, weights)[0]
                    before = tuple(np.concatenate((np.array(before), piece))[-2:])
            at = end
        return out

    def _part(self, texts: list[np.ndarray], before: tuple[int, int], weights: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(lengths) - lengths
        chunk = (np.arange(lengths.sum()) - np.repeat(starts, lengths)) // CHUNK
        by_chunk = np.argsort(chunk, kind="stable")
        ids = np.concatenate(texts)
        contexts = [c[by_chunk] for c in word_contexts(ids, starts[lengths > 0], before)]
        ids, owner = ids[by_chunk], np.repeat(np.arange(len(texts)), lengths)[by_chunk]
        sizes, at = self.code.expand(ids)
        mixed = self.code.mixed[at]
        inputs, gate = [self.code.tree_at[at]], np.zeros(len(at), np.int16)
        for k, c in enumerate(contexts):
            _unpack(self.tables[k].take(_slot(np.repeat(c, sizes), mixed, self.tables.shape[1])), inputs, gate)
        ends = np.cumsum(sizes)[np.cumsum(np.bincount(chunk)) - 1]
        if seen is not None:
            seen += np.bincount(gate, minlength=len(seen))
        return mix(inputs, gate, self.code.sign_at[at], np.repeat(owner, sizes), ends, weights, self.rate)


def _unpack(slots: np.ndarray, inputs: list[np.ndarray], gate: np.ndarray) -> None:
    """Adds an input, and its two bits to the gate, of which the last four count."""
    gate *= 4
    gate += slots & np.int16(3)
    gate &= 15
    inputs.append((slots >> np.int16(2)) * np.float32(1 / 512))


class Speller:
    """Bits of a word's bytes and the closing space."""

    def __init__(self, tables: np.ndarray, starts: np.ndarray, rate: float = 0.06):
        self.tables, self.rate, self.starts = tables, rate, starts

    def learn(self, words: list[bytes], seen: np.ndarray, more: bool = False) -> list[bytes]:
        """As WordModel.learn: words one after another move one set of start weights.  If `more` follow, the
        words of the last step, which may not be complete, are given back."""
        groups, size = [[]], 0
        for k, w in enumerate(words):
            groups[-1].append(k)
            size += len(w) + 1
            if size >= LEARN_PART:
                groups.append([])
                size = 0
        rest = [words[k] for k in groups.pop()] if more else []
        for group in filter(None, groups):
            word, place, mixed, bit, contexts = byte_bits([words[k] for k in group])
            inputs, gate = [], np.zeros(len(mixed), np.int16)
            for k, c in enumerate(contexts):
                _unpack(self.tables[k][_slot(c, mixed, self.tables.shape[1])], inputs, gate)
            seen += np.bincount(gate, minlength=len(seen))
            weights = self.starts[None].astype(np.float32)
            ends = np.cumsum(np.bincount(np.minimum(place, 63)))
            mix(inputs, gate, np.float32(1) - np.float32(2) * bit, np.zeros(len(word), np.int64), ends, weights, self.rate)
            self.starts = weights[0].astype(np.float64)
        return rest

    def score(self, words: list[bytes]) -> np.ndarray:
        out = []
        at = 0
        while at < len(words):
            end, size = at, 0
            while end < len(words) and (end == at or size + len(words[end]) <= PART):
                size += len(words[end])
                end += 1
            word, place, mixed, bit, contexts = byte_bits(words[at:end])
            inputs, gate = [], np.zeros(len(mixed), np.int16)
            for k, c in enumerate(contexts):
                _unpack(self.tables[k][_slot(c, mixed, self.tables.shape[1])], inputs, gate)
            ends = np.cumsum(np.bincount(np.minimum(place, 63)))  # the bytes from the 64th on are one chunk
            out.append(mix(inputs, gate, np.float32(1) - np.float32(2) * bit, word, ends, _start(end - at, self.starts), self.rate))
            at = end
        return np.concatenate(out) if out else np.zeros(0)


# --- Spark ---------------------------------------------------------------------------------

LEARNED = "cell int, weight bigint, seen bigint"
LANE_TEXTS, LANE_WORDS = 1024, 1 << 16  # texts and words in a lane, on average
UNITS = 10**9  # logarithms of spelled words are added up as whole numbers of this part of one
FIXED = 1 << 20  # weights are added up as whole numbers of this part of one


def _learned(starts: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    n = np.repeat(seen, starts.shape[1])
    return pa.RecordBatch.from_arrays([pa.array(np.arange(starts.size, dtype=np.int32)), pa.array(np.round(starts.ravel() * FIXED).astype(np.int64) * n), pa.array(n)], names=["cell", "weight", "seen"])


def averaged(rows: DataFrame, starts: np.ndarray) -> np.ndarray:
    """The mean of what the lanes learned, by the bits that each saw; `starts` where none did.
    Whole numbers are added, in whatever order.  One row a weight reaches the driver."""
    out = starts.copy().ravel()
    for cell, weight, seen in rows.groupBy("cell").agg(F.sum(F.col("weight").cast("decimal(38,0)")), F.sum("seen")).collect():
        if seen:
            out[cell] = round(int(weight) / int(seen) / FIXED, 4)
    return out.reshape(starts.shape)


def in_lanes(rows: DataFrame, column: str, lanes: int, *salt: str) -> DataFrame:
    """(lane, column) in runs of one lane each.  Lane and order follow from a row's own values, so
    what a lane learns does not depend on how the input is split; `salt` spreads copies over lanes."""
    h = F.xxhash64(F.lit(1), column, *salt)
    dealt = rows.select(F.pmod(h, F.lit(lanes)).cast("int").alias("lane"), h.alias("at"), column, *salt)
    return dealt.repartition("lane").sortWithinPartitions("lane", "at", column).select("lane", column)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batches cut where the lane changes."""
    for b in batches:
        lane = b.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(lane[1:] != lane[:-1]) + 1).tolist(), b.num_rows]
        for a, z in zip(edges, edges[1:]):
            if z > a:
                yield int(lane[a]), b.slice(a, z - a)


def numbered(texts: pa.Array, listed: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Token numbers of the texts one after another, each closed by 1 for the end; how many
    tokens each text has; and the words that are not listed, with their texts' places."""
    words, counts = words_of(texts)
    found = pc.index_in(words, value_set=listed)
    number = pc.fill_null(found, -2).to_numpy(zero_copy_only=False) + 2
    ids = np.ones(len(words) + len(counts), np.int64)
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(counts + 1) - 1] = False
    ids[inner] = number
    strange = found.is_null()
    return ids, counts + 1, words.filter(strange), np.repeat(np.arange(len(counts)), counts)[number == 0]


def score(docs: DataFrame, text_col: str = "text", vocab: int = VOCAB, word_slots: int = WORD_SLOTS, byte_slots: int = BYTE_SLOTS) -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 of the text's probability), n_bytes and bits_per_byte."""
    sc = docs.sparkSession.sparkContext
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col(text_col).cast("string").alias("text"))
    train = d.where(~F.col("held_out")).select("text")
    counts = materialize(word_counts(train), "word-counts")
    n, v, end = counts.agg(F.sum("c"), F.count("*"), F.sum(F.when(F.col("word") == F.lit(END), F.col("c")))).first()
    n, v, end = n or 0, v or 0, end or 0
    # a fixed number of words of bounded length
    # whole powers of two of counts, from the highest on, until they hold `vocab` words: at most 64 rows
    listable = counts.where((F.octet_length("word") <= LONGEST) & (F.col("word") != F.lit(END)))
    sizes = listable.groupBy(F.floor(F.log2("c")).alias("power")).count().orderBy(F.desc("power")).collect()
    held = list(itertools.accumulate(r["count"] for r in sizes))
    low = next((r["power"] for r, up_to in zip(sizes, held) if up_to >= vocab), 0)
    often = listable.where(F.floor(F.log2("c")) >= low).repartition(8)  # eight tasks send `vocab` words at most
    top = [(bytes(r["word"]), r["c"]) for r in often.orderBy(F.desc("c"), "word").limit(vocab).collect()]
    code = Code(top, n - end - sum(c for _, c in top), end)
    shared = sc.broadcast((code, code.listed()))

    def tally_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, listed = shared.value
        tally = Tally(4, word_slots)
        for whole in batches:
            for share, b in ((share, b) for share, rows in halves(whole) for b in slices(rows, 0)):
                ids, counts, _, _ = numbered(b.column(0), listed)
                contexts = word_contexts(ids, np.cumsum(counts) - counts)
                for at in range(0, len(ids), TALLY_PART):
                    yield from tally.overflow()
                    part = slice(at, at + TALLY_PART)
                    sizes, bits = code.expand(ids[part])
                    for k in range(2):
                        tally.add(2 * share + k, _slot(np.repeat(contexts[k][part], sizes), code.mixed[bits], word_slots), code.bits[bits])
        yield from tally.blocks()

    def tally_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(8, byte_slots)
        for share, b in (half for whole in batches for half in halves(whole)):
            words = b.column(0).to_pylist()
            at = 0
            while at < len(words):
                yield from tally.overflow()
                end, size = at, 0
                while end < len(words) and (end == at or size + len(words[end]) <= PART):
                    size += len(words[end])
                    end += 1
                _, _, mixed, bit, contexts = byte_bits(words[at:end])
                for k, c in enumerate(contexts):
                    tally.add(4 * share + k, _slot(c, mixed, byte_slots), bit)
                at = end
        yield from tally.blocks()

    apart = lambda c: F.pmod(F.xxhash64(c), F.lit(LEARN_SHARE)) == 0
    spelled_words = counts.where(F.col("word") != F.lit(END)).select("word")
    word_blocks = materialize(added_up(train.select("text", apart("text").alias("share")).mapInArrow(tally_words, BLOCKS)), "word-blocks")
    byte_blocks = materialize(added_up(spelled_words.select("word", apart("word").alias("share")).mapInArrow(tally_bytes, BLOCKS)), "byte-blocks")
    word_unlearned, byte_unlearned = (sc.broadcast(gathered(b.where(F.col("tab") < k), k, slots)) for b, k, slots in ((word_blocks, 2, word_slots), (byte_blocks, 4, byte_slots)))

    def learn_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, listed = shared.value
        for _, lane in itertools.groupby(runs(batches), lambda x: x[0]):
            model, seen = WordModel(code, word_unlearned.value, _word_starts()), np.zeros(16, np.int64)
            for _, whole in lane:
                for b in slices(whole, 1):
                    ids, counts, _, _ = numbered(b.column(1), listed)
                    model.learn(np.split(ids, np.cumsum(counts)[:-1]), seen)
            yield _learned(model.starts, seen)

    def learn_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lane in itertools.groupby(runs(batches), lambda x: x[0]):
            model, seen = Speller(byte_unlearned.value, _byte_starts()), np.zeros(16, np.int64)
            rest: list[bytes] = []
            for _, b in lane:
                rest = model.learn(rest + b.column(1).to_pylist(), seen, more=True)
            model.learn(rest, seen)
            yield _learned(model.starts, seen)

    texts = in_lanes(d.where(~F.col("held_out") & apart("text")), "text", max(1, end // LEARN_SHARE // LANE_TEXTS), "doc_id")
    word_starts = averaged(texts.mapInArrow(learn_words, LEARNED), _word_starts())
    words = in_lanes(spelled_words.where(apart("word")), "word", max(1, v // LEARN_SHARE // LANE_WORDS))
    byte_starts = averaged(words.mapInArrow(learn_bytes, LEARNED), _byte_starts())
    word_unlearned.destroy()
    byte_unlearned.destroy()
    word_tables = sc.broadcast(gathered(with_share(word_blocks, 2), 2, word_slots))
    byte_tables = sc.broadcast(gathered(with_share(byte_blocks, 4), 4, byte_slots))
    discard(word_blocks, byte_blocks)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, listed = shared.value
        model = WordModel(code, word_tables.value, word_starts)
        names = ["rid", "doc_id", "held_out", "n_tokens", "known", "logc", "bits", "n_bytes", "word", "n"]
        none = lambda k, kind: pa.nulls(k, kind)
        for whole in batches:
            for b in slices(whole, 3):
                ids, counts, strange, place = numbered(b.column(3), listed)
                starts = np.cumsum(counts) - counts
                bits = model.score(np.split(ids, starts[1:]))
                m = b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array(counts, pa.int64()), pa.array(np.add.reduceat(code.known[ids], starts), pa.int64()),
                     pa.array(np.add.reduceat(code.logc[ids], starts)), pa.array(bits), pc.fill_null(pc.binary_length(b.column(3)), 0).cast(pa.int64()), none(m, pa.binary()), none(m, pa.int64())], names=names)
                rids = pa.array(b.column(0).to_numpy(zero_copy_only=False)[place], pa.int64())
                met = pa.table({"rid": rids, "word": strange}).group_by(["rid", "word"], use_threads=False).aggregate([([], "count_all")])
                for t in met.to_batches():
                    r = t.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [t.column("rid"), none(r, pa.int64()), none(r, pa.bool_()), none(r, pa.int64()), none(r, pa.int64()), none(r, pa.float64()), none(r, pa.float64()),
                         none(r, pa.int64()), t.column("word"), t.column("count_all").cast(pa.int64())], names=names)

    schema = "rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, logc double, bits double, n_bytes bigint, word binary, n bigint"
    # rid ties a text's escaped words to its row, within this one written table
    rows = materialize(d.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", "text").mapInArrow(read, schema), "scores")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(byte_tables.value, byte_starts)
        for b in batches:
            words = b.column(1).dictionary_encode()  # the join leaves equal words together
            bits = speller.score(words.dictionary.to_pylist())[words.indices.to_numpy(zero_copy_only=False)]
            times = b.column(2).to_numpy(zero_copy_only=False)
            c = b.column(3).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.where(c > 0, times, 0), pa.int64()), pa.array(times * np.log10(c + 1.0)), pa.array(times * bits)], names=["rid", "known", "logc", "bits"])

    met = rows.where("word is not null").select("word", "rid", "n").join(counts, "word", "left").select("rid", "word", "n", F.coalesce("c", F.lit(0)).alias("c"))
    spelled = met.mapInArrow(spell, "rid bigint, known bigint, logc double, bits double")
    exact = lambda c: (F.sum(F.round(F.col(c) * UNITS).cast("bigint")) / UNITS).alias(f"{c}2")
    spelled = spelled.groupBy("rid").agg(F.sum("known").alias("known2"), exact("logc"), exact("bits"))
    r = rows.where("word is null").join(spelled, "rid", "left")
    both = lambda c: F.col(c) + F.coalesce(F.col(f"{c}2"), F.lit(0))
    return r.select(
        "doc_id", "held_out", "n_tokens", both("known").alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (both("logc") - F.col("n_tokens") * float(np.log10(n + v + 1.0))).alias("base_score"), (both("bits") * LOG2).alias("score"), "n_bytes",
        F.when(F.col("n_bytes") > 0, -both("bits") / F.col("n_bytes")).alias("bits_per_byte"))
