"""Removal of repeated 50-byte strings by blockwise suffix sorting with difference covers.

A byte goes if a LENGTH-byte string that covers it also starts in a document with a smaller
doc_id.  Sorting every suffix of the corpus would ship each of them, so only places that can
match are sorted, and none that matches is left out:

1 Anchors.  Winnowing marks the smallest hashed GRAM in each window of LENGTH bytes, so equal
  strings hold equal anchors at equal offsets.  A task sends on the anchors of its batch by
  bucket of the anchor's hash, with a hash of the anchor's neighbourhood (all strings of LENGTH
  bytes around it).  Of equal neighbourhoods in a batch only the smallest doc_id's travel; the
  others are compared with it byte by byte at once.  An anchor with LOCAL_HOT different
  neighbourhoods in one batch is split over buckets by neighbourhood.
2 Buckets.  A bucket is sorted at a time.  Each row with an equal neighbourhood in a smaller
  doc_id claims to equal the row before it; a claim is no proof, see step 4.  An anchor with
  different neighbourhoods may be the edge of a repeat: of each kind those of the smallest
  doc_id, everywhere it has them, go on to step 3.
3 Suffixes.  The neighbourhoods' bytes are laid out as a local text in which equal offsets from
  the anchor have equal residues modulo 13.  Ranks of the suffixes at the difference cover
  {0, 1, 3, 9} (mod 13) are found first, by prefix doubling from 13 to 39 bytes.  Then the
  suffixes of one offset at a time are sorted by their first 13 bytes, ties by the cover rank
  where both suffixes next meet the cover, and last by the final 13 bytes.  Suffixes that
  compare equal share LENGTH bytes; all but the smallest doc_id's are repeats.  An anchor with
  over `hot` neighbourhoods is split in two by the bytes that the upper and the lower half of
  its offsets share, again and again if need be, until a group is one string.
4 The bytes behind each claim are fetched from the document that it names and compared with the
  claiming document's when the repeats are cut out.  If any differ, two neighbourhoods had one
  hash: the attempt is void and another is made with another hash, of which all 64 bits travel.

Tasks hold a batch of texts, a bucket's different neighbourhoods or a block of them; there are
as many tasks as the bytes of the table ask for, and buckets as many as its anchors.

Edge cases: a null text is empty and stays so; texts shorter than LENGTH are never changed; a
null doc_id neither removes nor loses anything; rows that repeat a doc_id, with the same text or
another, are each judged on their own text and never remove from one another; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphvec.storage import broadcast_if_small, discard, materialize

LENGTH = 50
GRAM = 24
LEFT = LENGTH - GRAM  # bytes of a neighbourhood before the anchor
WIDTH = LEFT + LENGTH  # bytes of a neighbourhood
PERIOD, COVER = 13, (0, 1, 3, 9)  # a perfect difference set: covers every difference
SLOT = -(-WIDTH // PERIOD) * PERIOD  # a neighbourhood's place in the local text
BATCH_BYTES = 8 << 20
SEGMENT = 1 << 20  # bytes of a text hashed at a time
SLICE_ROWS = 256  # texts held as Python objects at a time
LOCAL_HOT = 64
BUCKET_ANCHORS = 150_000
TASK_BYTES = 16 << 20  # of texts; more only where that would make over MAX_TASKS tasks
MAX_TASKS = 50_000
COLLAPSE_ROWS = 400_000
BLOCK_ROWS = 20_000
HOT = 100_000
SEEDS = 8
VERSION = 40  # a place is a version of the doc_id's text above so many bits, and an offset

_M = np.uint64(0xD6E8FEB86659FD93)


def _base(seed: int) -> int:
    return (0x9E3779B97F4A7C15 + seed * 0x5851F42D4C957F2E) & ((1 << 64) - 1) | 1


def _power(base: int, n: int) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _M
    h ^= h >> np.uint64(29)
    return h


def gram_hashes(b: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the GRAM bytes from each place on, by doubling a polynomial hash."""
    base = _base(seed)
    have, h = 1, b.astype(np.uint64) + np.uint64(1)
    powers = {1: h}
    while have * 2 <= GRAM:
        h = h[:-have] * _power(base, have) + h[have:]
        have *= 2
        if GRAM & have:
            powers[have] = h
    rest = GRAM - have
    for size in sorted((s for s in powers if s & rest), reverse=True):
        part = powers[size][have:]
        h = h[: len(part)] * _power(base, size) + part[: len(h)]
        have += size
    return _mixed(h)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def anchors(h: np.ndarray) -> np.ndarray:
    """Places whose hash is the smallest of some window of LENGTH bytes."""
    w = LENGTH - GRAM + 1
    least = _sliding(h, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), w, np.maximum) == h)


def neighbourhoods(h: np.ndarray, at: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of bytes [at - LEFT, at + LENGTH) of a text of n bytes, cut at its ends: grams
    that cover them, and how much was cut."""
    first, last = np.maximum(at - LEFT, 0), np.minimum(at + LENGTH, n) - GRAM
    c = ((at - first) * 256 + (last - at)).astype(np.uint64) + np.uint64(seed << 16)
    for place in (first, np.maximum(at - GRAM, first), at, np.minimum(at + GRAM, last), last):
        c = _mixed(c * np.uint64(_base(3)) + h[place])
    return c


def anchors_of(b: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's hash, neighbourhood's hash, place) of every anchor of a text; a long text is
    read in segments that overlap, and every window of LENGTH bytes lies in one."""
    n, found = len(b), []
    for start in range(0, max(1, n - LENGTH + 1), SEGMENT):
        end = min(n, start + SEGMENT + LENGTH - 1)
        low, high = max(0, start - LEFT), min(n, end + LENGTH)  # neighbourhoods reach beyond
        h = gram_hashes(b[low:high], seed)
        at = anchors(h[start - low : end - low - GRAM + 1]) + (start - low)
        found.append((h[at], neighbourhoods(h, at, high - low, seed), at + low))
    h, c, at = (np.concatenate(x) for x in zip(*found)) if len(found) > 1 else found[0]
    if len(found) > 1:
        at, once = np.unique(at, return_index=True)
        h, c = h[once], c[once]
    return h, c, at


ROWS = "bucket int, marks boolean, data binary"


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as byte planes, which shuffle compression shrinks."""
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)


def _unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    planes = np.frombuffer(data, np.uint8).reshape(sum(sizes), -1)
    ends = np.cumsum(sizes)
    return [np.ascontiguousarray(planes[e - s : e].T).view(k).ravel() for k, s, e in zip(kinds, sizes, ends)]


def _short(x: np.ndarray) -> np.ndarray:
    return x.view(np.uint8).reshape(-1, 8)[:, :6].copy().view("V6").ravel()


def _long(x: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(x), 8), np.uint8)
    wide[:, :6] = x.view(np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def _raw(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text of a column, a null as none."""
    for x in column.cast(pa.binary()):
        b = x.as_buffer()
        yield np.frombuffer(b, np.uint8) if b is not None else np.zeros(0, np.uint8)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(at, SLICE_ROWS)


def _runs(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of equal doc that overlap or touch, merged: doc, start and size."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])  # all ends follow their starts in one order
    first = np.flatnonzero(new)
    return doc[first], start[first], (np.maximum.reduceat(end, first) if len(first) else end) - start[first]


def _same_bytes(whole: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> bool:
    """Whether the neighbourhoods of rows i and j hold equal bytes; `left` and `right` say how
    far a neighbourhood reaches from its place in `whole`."""
    if (left[i] != left[j]).any() or (right[i] != right[j]).any():
        return False
    reach = np.arange(-LEFT, LENGTH)
    for k in range(0, len(i), 20_000):
        a, b = i[k : k + 20_000], j[k : k + 20_000]
        inside = (reach >= -left[a, None]) & (reach < right[a, None])
        x, y = (whole.take(at[r, None] + reach, mode="clip") for r in (a, b))
        if ((x != y) & inside).any():
            return False
    return True


KINDS = ("V6", "V6", np.int64, np.int64, np.uint8)  # anchor, neighbourhood, doc_id, place, whether the anchor has others elsewhere
WIDE = (np.uint64, np.uint64, *KINDS[2:])
SHIPPED = np.uint64((1 << 48) - 1)  # bits of both hashes that travel at first: equal bytes are proved later
LARGE = 1 << 40  # bytes of text from which on all 64 bits travel from the first attempt on, as in later attempts at any size


def _find_anchors(buckets: int, seed: int, bits: int, wide: bool):
    kept = np.uint64((1 << bits) - 1) & (~np.uint64(0) if wide else SHIPPED)
    shift = np.uint64(64 - (buckets.bit_length() - 1)) if buckets > 1 else None

    def bucket_of(x: np.ndarray) -> np.ndarray:
        x = _mixed(x * np.uint64(_base(5)))  # anchors' hashes are the least of a window, so the low ones are crowded
        return (x >> shift).astype(np.int64) if shift is not None else np.zeros(len(x), np.int64)

    def out(units: list, found: list, texts: list) -> Iterator[pa.RecordBatch]:
        counts, sizes = np.array([len(f[0]) for f in found]), np.array([len(t) for t in texts])
        h, c, at = (np.concatenate([f[k] for f in found]) for k in range(3))
        doc, high = (np.repeat(np.array([u[k] for u in units], np.int64), counts) for k in (0, 1))
        size, base = np.repeat(sizes, counts), np.repeat(np.cumsum(sizes) - sizes, counts)
        order = np.lexsort((at, high, doc, c, h))
        h, c, at, doc, high, size, base = (x[order] for x in (h, c, at, doc, high, size, base))
        place = (high << VERSION) + at
        new_h, new = np.ones(len(h), bool), np.ones(len(h), bool)
        new_h[1:] = h[1:] != h[:-1]
        new[1:] = new_h[1:] | (c[1:] != c[:-1])
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        again = np.flatnonzero(doc != least)  # equal neighbourhood in a smaller document of this batch
        rows = []
        if len(again):
            same = _same_bytes(np.concatenate(texts), base + at, np.minimum(at, LEFT), np.minimum(size - at, LENGTH), again, again - 1)
            own, start, end = doc[again], place[again] - np.minimum(at, LEFT)[again], place[again] + np.minimum(size - at, LENGTH)[again]
            merged = _runs(own, start, end) if same else (own[:1], start[:1], np.zeros(1, np.int64))  # a run of 0 bytes: void
            rows.append((int(doc[0] % buckets), True, _pack(merged[0], merged[1], merged[2].astype(np.int64))))
        once = np.ones(len(h), bool)
        once[1:] = new[1:] | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
        once[again] = False
        kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_h))
        local_hot = kinds >= LOCAL_HOT
        stay = np.flatnonzero(once)
        hot = local_hot[np.cumsum(new_h) - 1][stay]
        marks = h[np.flatnonzero(new_h)][local_hot]  # one row that says: this anchor has others elsewhere
        none = np.zeros(len(marks), np.uint64)
        bucket = np.concatenate((np.where(hot, bucket_of(_mixed(h[stay] ^ c[stay])), bucket_of(h[stay])), bucket_of(marks)))
        columns = [np.concatenate(x) for x in ((h[stay], marks), (c[stay], none), (doc[stay], none.view(np.int64)), (place[stay], none.view(np.int64)), (hot.astype(np.uint8), np.full(len(marks), 2, np.uint8)))]
        order = np.argsort(bucket, kind="stable")
        bucket, columns = bucket[order], [x[order] for x in columns]
        cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        if not wide:
            columns[:2] = map(_short, columns[:2])
        rows += [(int(bucket[a]), False, _pack(*[x[a:b] for x in columns])) for a, b in zip(cuts[:-1], cuts[1:])]
        for i in range(0, len(rows), 64):
            b, m, d = zip(*rows[i : i + 64])
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(m), pa.array(d, pa.binary())], names=["bucket", "marks", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, found, texts, size = [], [], [], 0
        for batch in sliced(batches):
            for doc, version, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _raw(batch.column(2))):
                if doc is None or len(b) < LENGTH:
                    continue
                units.append((doc, version))
                h, c, at = anchors_of(b, seed)
                found.append((h, c & kept, at))
                texts.append(b)
                size += len(b)
                if size >= BATCH_BYTES:
                    yield from out(units, found, texts)
                    units, found, texts, size = [], [], [], 0
        if found:
            yield from out(units, found, texts)

    return run


#: a run of repeated bytes (size set), a claim to equal another place (pdoc set), or an edge (anchor set); without doc_id: the attempt is void
FOUND = "doc_id bigint, place bigint, size bigint, pdoc bigint, pplace bigint, anchor bigint"


FOUND_SCHEMA = pa.schema([(k, pa.int64()) for k in ("doc_id", "place", "size", "pdoc", "pplace", "anchor")])


def _found(doc: np.ndarray, place: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    null = pa.nulls(len(doc), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(place), *[pa.array(more[k]) if k in more else null for k in FOUND_SCHEMA.names[2:]]], schema=FOUND_SCHEMA)


class Bucket:
    """The rows of a bucket.  Once there are many, those with an equal neighbourhood give way to
    the smallest doc_id's, so what is held follows the different neighbourhoods."""

    def __init__(self, wide: bool):
        self.parts: list[list[np.ndarray]] = []
        self.wide = wide
        self.rows = self.limit = 0

    def add(self, data: bytes) -> Iterator[pa.RecordBatch]:
        h, c, *rest = _unpack(data, *(WIDE if self.wide else KINDS))
        self.parts.append([h, c, *rest] if self.wide else [_long(h), _long(c), *rest])
        self.rows += len(self.parts[-1][0])
        if self.rows > max(COLLAPSE_ROWS, self.limit):
            yield from self.collapse()
            self.limit = 2 * self.rows

    def collapse(self) -> Iterator[pa.RecordBatch]:
        h, c, doc, place, flag = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((place, doc, c, flag, h))
        h, c, doc, place, flag = (x[order] for x in (h, c, doc, place, flag))
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1]) | (flag[1:] != flag[:-1])
        once = new.copy()
        once[1:] |= (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
        h, c, doc, place, flag, new = (x[once] for x in (h, c, doc, place, flag, new))
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        again = np.flatnonzero(doc != least)
        if len(again):
            yield _found(doc[again], place[again], pdoc=doc[again - 1], pplace=place[again - 1])
        stay = doc == least
        self.parts = [[x[stay] for x in (h, c, doc, place, flag)]]
        self.rows = int(stay.sum())

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self.collapse()
        h, c, doc, place, flag = self.parts[0]
        new_h = np.ones(len(h), bool)
        new_h[1:] = h[1:] != h[:-1]
        new = new_h.copy()
        new[1:] |= (c[1:] != c[:-1]) | (flag[1:] != flag[:-1])
        anchor = np.cumsum(new_h) - 1
        kinds = np.bincount(anchor, new) + 2 * np.bincount(anchor, flag > 0)  # of neighbourhoods of each anchor
        edge = np.flatnonzero((kinds[anchor] > 1) & (flag < 2))
        if len(edge):
            yield _found(doc[edge], place[edge], anchor=h[edge].view(np.int64))


def _sort_buckets(wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, Bucket(wide)
        for b in batches:
            for bucket, marks, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                data = data.as_buffer()
                if marks:
                    doc, place, size = _unpack(data, np.int64, np.int64, np.int64)
                    yield _found(doc, place, size=size) if size.all() else pa.RecordBatch.from_pylist([{}], FOUND_SCHEMA)
                    continue
                if bucket != now and held.parts:
                    yield from held.close()
                    held = Bucket(wide)
                now = bucket
                yield from held.add(data)
        if held.parts:
            yield from held.close()

    return run


def _join_claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Claims sorted by doc_id and place -> runs: a row asks for `size` bytes of pdoc at pplace."""
    for b in batches:
        doc, place, pdoc, pplace = (np.asarray(b.column(i)) for i in range(4))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pdoc[1:] != pdoc[:-1]) | (np.diff(place) != np.diff(pplace)) | (np.diff(place) > WIDTH)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(doc)) - 1
        left = np.minimum(LEFT, np.minimum(place, pplace)[first] & ((1 << VERSION) - 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (pdoc[first], pplace[first] - left, place[last] - place[first] + left + LENGTH, doc[first], place[first] - left)],
            names=["pdoc", "pplace", "size", "doc_id", "place"])


PIECES = "anchor bigint, doc_id bigint, version int, place bigint, size bigint, near binary"


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes asked of each text: (text, [(from, size, anchor, doc_id, place)])."""
    low = (1 << VERSION) - 1
    for b in sliced(batches):
        asked = b.column(1)
        ends = np.asarray(asked.offsets)
        flat = asked.values
        at, size = (np.asarray(flat.field(k)) for k in (0, 1))
        for i, raw in enumerate(_raw(b.column(0))):
            text = raw.tobytes()
            for k in range(ends[i], ends[i + 1], 20_000):
                rows = slice(k, min(k + 20_000, ends[i + 1]))
                place = flat.field(4)[rows].to_numpy()
                near = [text[a : a + n] for a, n in zip(at[rows].tolist(), size[rows].tolist())]
                yield pa.RecordBatch.from_arrays([flat.field(2)[rows], flat.field(3)[rows], pa.array((place >> VERSION).astype(np.int32)), pa.array(place & low), flat.field(1)[rows], pa.array(near, pa.binary())],
                                                 names=["anchor", "doc_id", "version", "place", "size", "near"])


def _keys(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 13 bytes of each row as two numbers that order alike."""
    wide = np.zeros((len(rows), 16), np.uint8)
    wide[:, :PERIOD] = rows
    k = wide.view(">u8").astype(np.uint64)
    return k[:, 0], k[:, 1]


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of the tuples of keys, first key first."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), np.int64)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def cover_ranks(text: np.ndarray) -> dict[int, np.ndarray]:
    """text: [n, SLOT].  For each column of the difference cover, the rank of the suffix there
    by its next 39 bytes, which may run into zeros after the slot."""
    n = len(text)
    wide = np.concatenate((text, np.zeros((n, 3 * PERIOD), np.uint8)), axis=1)
    columns = [c for c in range(SLOT + 2 * PERIOD) if c % PERIOD in COVER]
    place = {c: i for i, c in enumerate(columns)}
    keys = [_keys(wide[:, c : c + PERIOD]) for c in columns]
    by_13 = _ranks(np.concatenate([a for a, _ in keys]), np.concatenate([b for _, b in keys])).reshape(len(columns), n)
    upto = [c for c in columns if c < SLOT]
    by_26 = _ranks(np.concatenate([by_13[place[c]] for c in upto]), np.concatenate([by_13[place[c + PERIOD]] for c in upto])).reshape(len(upto), n)
    by_39 = _ranks(by_26.ravel(), np.concatenate([by_13[place[c + 2 * PERIOD]] for c in upto])).reshape(len(upto), n)
    return {c: by_39[i] for i, c in enumerate(upto)}


def repeats(anchor: np.ndarray, low: np.ndarray, high: np.ndarray, doc: np.ndarray, cut: np.ndarray, near: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, offset) of every string of LENGTH bytes around an anchor that also stands around
    the same anchor in a smaller document.  A row's bytes begin `cut` columns into its slot, and
    its offsets are `low` to `high`."""
    n = len(near)
    text = np.zeros((n, SLOT), np.uint8)
    ends = cut + np.fromiter(map(len, near), np.int64, n)
    flat = np.frombuffer(b"".join(near), np.uint8)
    column = np.arange(SLOT)
    text[(column >= cut[:, None]) & (column < ends[:, None])] = flat
    ranks = cover_ranks(text)
    group = _ranks(anchor.view(np.uint64))
    found_rows, found_at = [], []
    for s in range(LEFT + 1):  # one suffix bucket: the suffixes that start s bytes into a slot
        rows = np.flatnonzero((cut <= s) & (ends >= s + LENGTH) & (low <= s) & (s <= high))
        if len(rows) < 2:
            continue
        meet = next(s + d for d in range(PERIOD) if (s + d) % PERIOD in COVER)
        first, final = _keys(text[rows, s : s + PERIOD]), _keys(text[rows, s + LENGTH - PERIOD : s + LENGTH])
        # bytes from meet + 39 on are beyond the string only if it ends earlier: compare no more
        inside = ranks[meet][rows] if meet + 3 * PERIOD <= s + LENGTH else _shorter(text, rows, meet, s + LENGTH - PERIOD)
        keys = (group[rows], *first, inside, *final)
        order = np.lexsort((doc[rows], *keys[::-1]))
        new = np.zeros(len(rows), bool)
        new[0] = True
        for k in keys:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
        own = doc[rows][order]
        again = own != own[np.flatnonzero(new)][np.cumsum(new) - 1]
        found_rows.append(rows[order][again])
        found_at.append(np.full(int(again.sum()), s))
    if not found_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_rows), np.concatenate(found_at)


def _shorter(text: np.ndarray, rows: np.ndarray, a: int, b: int) -> np.ndarray:
    """Ranks of the bytes [a, b), at most 26, where the cover rank would look past the string."""
    wide = np.zeros((len(rows), 2 * PERIOD), np.uint8)
    wide[:, : b - a] = text[rows, a:b]
    return _ranks(*_keys(wide[:, :PERIOD]), *_keys(wide[:, PERIOD:]))


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor (anchor, low, high, doc_id, version, at, near) -> runs of repeats."""
    held: list[pa.RecordBatch] = []

    def solve(b: pa.RecordBatch) -> pa.RecordBatch:
        anchor, low, high, doc, version, at = (np.asarray(b.column(i)).astype(np.int64) for i in range(6))
        rows, s = repeats(anchor, low, high, doc, LEFT - np.minimum(at, LEFT), b.column(6).to_pylist())
        begin = (version[rows] << VERSION) + at[rows] - LEFT + s
        own, first, size = _runs(doc[rows], begin, begin + LENGTH)
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(first), pa.array(size)], names=["doc_id", "place", "size"])

    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) < BLOCK_ROWS:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        anchor = np.asarray(whole.column(0))
        other = np.flatnonzero(anchor != anchor[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        held = [whole.slice(cut)]
        if cut:
            yield solve(whole.slice(0, cut))
        elif whole.column(1)[0].as_py() == whole.column(2)[0].as_py():
            # one string, so the smallest doc_id's row stands for all that came before
            yield solve(whole)
            doc = np.asarray(whole.column(3))
            held = [whole.slice(int(doc.argmin()), 1)]
    if held and sum(x.num_rows for x in held):
        yield solve(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _halved(level: DataFrame) -> DataFrame:
    """Each row twice, for the lower and the upper half of its offsets: an anchor's strings at
    some offsets share the bytes from the last one on to the end of the first one."""
    low, high = F.col("low"), F.col("high")
    middle = F.floor((low + high) / 2).cast("int")
    parts = level.withColumn("part", F.explode(F.array(F.struct(low.alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), high.alias("b")))))
    cut = F.lit(LEFT) - F.least("at", F.lit(LEFT))
    parts = parts.select("anchor", F.col("part.a").alias("low"), F.col("part.b").alias("high"), "doc_id", "version", "at", "near", cut.cast("int").alias("cut"))
    whole = parts.where(f"cut <= high and cut + octet_length(near) >= low + {LENGTH}")  # a row without these bytes has none of the strings
    shared = F.expr(f"substring(near, high - cut + 1, low + {LENGTH} - high)")
    return whole.select(F.xxhash64("anchor", "low", shared).alias("anchor"), "low", "high", "doc_id", "version", "at", "near")


def _split(edges: DataFrame, hot: int) -> DataFrame:
    """`edges` with anchors of over `hot` rows halved until they have fewer, or one string each."""
    level, done = edges, []
    while True:
        big = materialize(level.where("low < high").groupBy("anchor").count().where(F.col("count") > hot).select("anchor"), "hot-anchors")
        if big.isEmpty():
            break
        big = broadcast_if_small(big, 100_000)
        done.append(level.join(big, "anchor", "left_anti"))
        level = materialize(_halved(level.join(big, "anchor", "left_semi")), "halves", "zstd")
    for other in done:
        level = level.unionAll(other)
    return level


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        rows = []
        marks = batch.column(2)
        ends, flat, valid = np.asarray(marks.offsets), marks.values, np.asarray(marks.is_valid())
        starts, sizes, nears = np.asarray(flat.field(0)), np.asarray(flat.field(1)), flat.field(2)
        for i, (doc, raw) in enumerate(zip(batch.column(0).to_pylist(), _raw(batch.column(1)))):
            n, kept, gone, spans, void = len(raw), raw, 0, 0, False
            if valid[i] and ends[i] < ends[i + 1]:
                own = slice(ends[i], ends[i + 1])
                start, size = starts[own], sizes[own]
                for a, k, near in zip(start.tolist(), size.tolist(), nears[own].to_pylist()):
                    void |= near is not None and raw[a : a + k].tobytes() != near
                order = np.argsort(start, kind="stable")
                start, end = start[order], np.maximum.accumulate(np.minimum(start + size, n)[order])
                first = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
                start, end = start[first], end[np.append(first[1:], len(end)) - 1]
                gone, spans = int((end - start).sum()), len(start)
                kept = np.concatenate([raw[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), n])])
            rows.append((doc, n, gone, spans, kept.tobytes(), void))
        cols = list(zip(*rows)) or [()] * 6
        types = [pa.int64()] * 4 + [pa.binary(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "void"])


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _dropping_shuffles(spark):
    """Within, Spark deletes an execution's shuffle files when the execution ends: each step's
    result is a written table by then."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def _versions(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, version, text) for all rows of `d`, and one for each (doc_id, version): the
    different texts of a repeated doc_id are numbered."""
    h = F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")
    ids = d.select("doc_id", h).groupBy("doc_id").agg(F.count("*").alias("n"), (F.min("h") < F.max("h")).alias("differ"))
    twice = materialize(ids.where("n > 1").select("doc_id", "differ"), "repeated-ids")
    n, differ = twice.agg(F.count("*"), F.coalesce(F.max("differ"), F.lit(False))).first()
    d = d.select("doc_id", "text", h)
    if differ:
        texts = d.join(broadcast_if_small(twice.where("differ").select("doc_id"), 100_000), "doc_id", "left_semi").select("doc_id", "h").distinct()
        numbers = texts.withColumn("version", F.row_number().over(Window.partitionBy("doc_id").orderBy("h")) - 1)
        d = d.join(broadcast_if_small(materialize(numbers, "versions"), 100_000), ["doc_id", "h"], "left")
    else:
        d = d.withColumn("version", F.lit(0))
    d = d.select("doc_id", F.coalesce("version", F.lit(0)).cast("int").alias("version"), "text")
    return d, d.dropDuplicates(["doc_id", "version"]) if n else d


def _attempt(d: DataFrame, texts: DataFrame, size: int, hot: int, seed: int, bits: int, wide: bool) -> DataFrame | None:
    """The result, or None if two different neighbourhoods were found to have one hash."""
    tasks = max(1, math.ceil(size / max(TASK_BYTES, size / MAX_TASKS)))
    buckets = 1 << max(3, math.ceil(math.log2(max(1.0, size * 2 / (LEFT + 2) / BUCKET_ANCHORS))))
    low = (1 << VERSION) - 1
    version, offset = lambda c: F.shiftright(c, VERSION).cast("int"), lambda c: F.col(c).bitwiseAND(F.lit(low))

    sent = texts.mapInArrow(_find_anchors(buckets, seed, bits, wide), ROWS)
    found = materialize(sent.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_sort_buckets(wide), FOUND), "repeats")
    if not found.where("doc_id is null").isEmpty():
        return None

    claims = found.where("pdoc is not null").select("doc_id", "place", "pdoc", "pplace").repartition(tasks, "doc_id").sortWithinPartitions("doc_id", "place")
    claims = claims.mapInArrow(_join_claims, "pdoc bigint, pplace bigint, size bigint, doc_id bigint, place bigint")
    asked = claims.select(F.col("pdoc").alias("of"), version("pplace").alias("version"), offset("pplace").alias("at"), "size", F.lit(None).cast("bigint").alias("anchor"), "doc_id", "place")
    begin = F.greatest(offset("place") - LEFT, F.lit(0))
    asked = asked.unionAll(found.where("anchor is not null").select("doc_id", version("place"), begin, offset("place") + LENGTH - begin, "anchor", "doc_id", "place"))
    asked = asked.repartition(tasks, "of", "version").groupBy("of", "version").agg(F.collect_list(F.struct("at", "size", "anchor", "doc_id", "place")).alias("asked"))
    held = texts.select(F.col("doc_id").alias("of"), "version", "text").repartition(tasks, "of", "version").join(asked, ["of", "version"])
    pieces = materialize(held.select("text", "asked").mapInArrow(_cut_out, PIECES), "pieces", "zstd")

    claimed = materialize(pieces.where("anchor is null").select("doc_id", "version", "place", "size", "near"), "claims", "zstd")
    edges = pieces.where("anchor is not null").select("anchor", F.lit(0).alias("low"), F.lit(LEFT).alias("high"), "doc_id", "version", F.col("place").alias("at"), "near")
    ordered = _split(edges, hot).repartition(tasks, "anchor").sortWithinPartitions("anchor")
    strings = materialize(ordered.mapInArrow(_resolve, "doc_id bigint, place bigint, size bigint"), "strings")
    discard(pieces)

    none = F.lit(None).cast("binary").alias("near")
    marks = found.where("size is not null").select("doc_id", "place", "size").unionAll(strings).select("doc_id", version("place").alias("version"), offset("place").alias("start"), "size", none)
    marks = marks.unionAll(claimed)
    marks = marks.repartition(tasks, "doc_id", "version").groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "size", "near")).alias("marks"))
    joined = d.repartition(tasks, "doc_id", "version").join(marks, ["doc_id", "version"], "left")
    out = materialize(joined.select("doc_id", "text", "marks").mapInArrow(_remove, f"{RESULT}, void boolean"), "removed", "zstd")
    discard(found, strings, claimed)
    return out.drop("void") if out.where("void").isEmpty() else None


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", hot: int = HOT, hash_bits: int = 64) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay) for each row.
    `hash_bits` is how much of a neighbourhood's hash the first attempt uses."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("kept")
    zero = F.lit(0).cast("bigint")
    unnamed = d.where("doc_id is null").select("doc_id", F.octet_length(whole).cast("bigint").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), whole)
    with _dropping_shuffles(docs.sparkSession):
        named, texts = _versions(d.where("doc_id is not null"))
        for seed in range(SEEDS):
            done = _attempt(named, texts, size, hot, seed, 64 if seed else hash_bits, seed > 0 or size >= LARGE)
            if done is not None:
                return done.unionAll(unnamed)
    raise RuntimeError(f"{SEEDS} hashes in a row were equal for different bytes")
