"""Two Bloom filters built by many tasks: values seen once, and values seen at least twice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 1 << 20  # positions in one separately merged part of the filters
BITS_PER_VALUE = 16


def filter_bits(values: int, max_bits: int) -> int:
    """A power of two with room for so many values.

    ``max_bits`` bounds what is broadcast. Beyond it the filters fill up and more values are suspected,
    which costs shuffle; as suspects are confirmed exactly, results stay the same.
    """
    bits = SEGMENT
    while bits < min(values * BITS_PER_VALUE, max_bits):
        bits *= 2
    return bits


def positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of each 64-bit hash."""
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & mask


def _messages(once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    """Sorted positions, cut by segment."""
    cuts = np.arange(0, int(once[-1]) // SEGMENT + 2) * SEGMENT if len(once) else np.zeros(1, np.int64)
    a, b = np.searchsorted(once, cuts), np.searchsorted(twice, cuts)
    rows = [(i, once[a[i] : a[i + 1]], twice[b[i] : b[i + 1]]) for i in range(len(cuts) - 1) if a[i + 1] > a[i]]
    local = lambda x, i: (x - i * SEGMENT).astype("<u4").tobytes()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _, _ in rows], pa.int32()),
            pa.array([local(x, i) for i, x, _ in rows], pa.binary()),
            pa.array([local(y, i) for i, _, y in rows], pa.binary()),
        ],
        ["segment", "once", "twice"],
    )


def _summed(bits: int):
    def run(batches):
        for batch in batches:
            column = batch.column(0)
            hashes = np.asarray(column.flatten() if pa.types.is_list(column.type) else column).view(np.uint64)
            distinct, counts = np.unique(hashes, return_counts=True)
            p, q = positions(distinct, bits)
            spread, weight = np.concatenate([p, q]), np.concatenate([counts, counts])
            own = p == q  # one value sets such a position once only
            weight[len(p) :][own] = 0
            once, at = np.unique(spread, return_inverse=True)
            total = np.bincount(at, weight, len(once))
            yield _messages(once.astype(np.int64), once[total > 1].astype(np.int64))

    return run


def _merged(batches):
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for segment, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment not in seen:
                seen[segment] = np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
            first, again = seen[segment]
            p = np.frombuffer(once, "<u4")
            again[p[first[p]]] = True
            again[np.frombuffer(twice, "<u4")] = True
            first[p] = True
    for segment, (_, again) in seen.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int32()), pa.array([np.packbits(again).tobytes()], pa.binary())], ["segment", "twice"]
        )


def twice_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Packed bits of the filter of values seen twice, over the only column of ``hashes`` (bigint, or arrays of it).

    Tasks send the positions they set, once and twice, by segment; a segment's tasks merge them one message after
    another: a position set by two messages becomes twice seen. Both filters lie spread over the tasks; only the second
    comes to the driver, ``bits`` / 8 bytes.
    """
    messages = hashes.mapInArrow(_summed(bits), "segment int, once binary, twice binary")
    parts = min(bits // SEGMENT, 1024)
    merged = messages.repartition(parts, "segment").mapInArrow(_merged, "segment int, twice binary")
    packed = np.zeros(bits // 8, np.uint8)
    for row in merged.filter(F.col("twice").isNotNull()).toLocalIterator():
        packed[row.segment * SEGMENT // 8 : (row.segment + 1) * SEGMENT // 8] = np.frombuffer(row.twice, np.uint8)
    return packed


def suspected(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may have been seen twice; never misses one that was."""
    found = np.ones(len(hashes), bool)
    for p in positions(hashes, len(packed) * 8):
        found &= (packed[(p >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (p & np.uint64(7)).astype(np.uint8))) & np.uint8(1) > 0
    return found
