"""A Bloom filter of many keys, small enough to be where the rows are."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES, PROBES = 256, 8
MAX_BITS = 1 << 21  # of a slice; all are 64 MB then, and hold 20 million keys with one mistake in 10,000


def _place(h: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Where the k-th probe of each hash stands in its slice."""
    with np.errstate(over="ignore"):
        x = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k) * (h * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1))
    return ((x >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)


def member(keys: DataFrame, n: int, max_bits: int = MAX_BITS) -> Callable[[Column], Column]:
    """Whether a 64-bit hash may be among `keys` (h), about `n` rows: always true of those that are.  A slice
    of the filter is made from the keys with its leading byte; the driver puts the slices together, 64 MB at most."""
    bits = 1024
    while bits < min(max_bits, 24 * n // SLICES):
        bits *= 2

    def fill(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.zeros(bits, bool)
        for batch in batches:
            h = batch.column("h").to_numpy().view(np.uint64)
            for k in range(PROBES):
                one[_place(h, k, bits)] = True
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(one).tobytes()], pa.binary())], names=["s", "bits"])

    made = keys.select(F.shiftrightunsigned("h", 56).cast("int").alias("s"), "h").groupBy("s").applyInArrow(fill, "s int, bits binary")
    whole = np.zeros((SLICES, bits // 8), np.uint8)
    for s, b in made.toLocalIterator():
        whole[s] = np.frombuffer(b, np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(whole.reshape(-1))

    @F.arrow_udf("boolean")
    def passes(h: pa.Array) -> pa.Array:
        table, h = shared.value, h.to_numpy(zero_copy_only=False).view(np.uint64)
        start = (h >> np.uint64(56)).astype(np.int64) * (bits // 8)
        left = np.arange(len(h))
        for k in range(PROBES):
            at = _place(h[left], k, bits)
            left = left[(table[start[left] + (at >> 3)] >> (7 - (at & 7)) & 1).astype(bool)]
        found = np.zeros(len(h), bool)
        found[left] = True
        return pa.array(found)

    return passes
