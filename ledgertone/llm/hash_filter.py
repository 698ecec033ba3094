"""Bloom filters of bounded size over 64-bit hashes, tested where texts are read anyway."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BYTES = 64 << 20
SEGMENTS, PLACES, BITS_PER_HASH = 256, 6, 10
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _bits(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """Bit numbers within a segment, for each of the places of a hash; its last byte names the segment."""
    h = hashes.view(np.uint64)
    a, step = (h * _MIX[0]) >> np.uint64(16), ((h ^ (h >> np.uint64(29))) * _MIX[1]) >> np.uint64(20) | np.uint64(1)
    return [(a + np.uint64(i) * step) % np.uint64(size * 8) for i in range(PLACES)]


def hash_filter(hashes: DataFrame, column: str, most_bytes: int = FILTER_BYTES) -> np.ndarray:
    """A row of bytes for each segment, ``BITS_PER_HASH`` bits a hash, ``most_bytes`` in all at most.

    ``hashes`` is read twice, so it should be staged. A segment is filled by its own hashes in one task.
    """
    count = hashes.count()
    size = max(8, min(count * BITS_PER_HASH // 8, most_bytes) // SEGMENTS)

    def fill(table: pa.Table) -> pa.Table:
        bits = np.zeros(size * 8, bool)
        for place in _bits(table.column("h").to_numpy(), size):
            bits[place] = True
        return pa.table({"segment": table.column("segment").slice(0, 1), "bytes": [np.packbits(bits).tobytes()]})

    keyed = hashes.select(F.col(column).alias("h"), F.pmod(column, F.lit(SEGMENTS)).alias("segment"))
    out = np.zeros((SEGMENTS, size), np.uint8)
    for row in keyed.groupBy("segment").applyInArrow(fill, "segment long, bytes binary").toLocalIterator():
        out[row["segment"]] = np.frombuffer(row["bytes"], np.uint8)
    return out


def may_hold(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash, whether it may have been put into the filter."""
    segment = hashes.view(np.uint64) % np.uint64(SEGMENTS)
    may = np.ones(len(hashes), bool)
    for place in _bits(hashes, filled.shape[1]):
        byte = filled[segment, place >> np.uint64(3)]
        may &= (byte >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return may
