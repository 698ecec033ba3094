"""A Bloom filter of many keys, for scans of a table that must not be moved.

The filter is cut into segments, and a key's first hash names its segment, so every segment is filled by one group of
keys and no task holds more than its share. The filter's size is bounded; it is broadcast to the scan.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

FILTER_BYTES = 64 << 20
SEGMENTS, HASHES, BITS_PER_KEY = 1024, 6, 10


def _hashes(key: str) -> list[Column]:
    return [
        F.pmod(F.xxhash64(key), F.lit(SEGMENTS)).alias("segment"), F.xxhash64(F.lit(1), key).alias("a"),
        F.xxhash64(F.lit(2), key).alias("b"),
    ]


def _places(a: np.ndarray, b: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bit numbers within a segment, for each of the hash functions."""
    a, step = a.view(np.uint64), b.view(np.uint64) | np.uint64(1)
    return [(a + np.uint64(i) * step) % np.uint64(bits) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, key: str, count: int, most_bytes: int = FILTER_BYTES) -> np.ndarray:
    """One row of bytes per segment, together ``BITS_PER_KEY`` bits for each of ``count`` keys, at most ``most_bytes``."""
    size = max(8, min(count * BITS_PER_KEY // 8, most_bytes) // SEGMENTS)

    def fill(table: pa.Table) -> pa.Table:
        bits = np.zeros(size * 8, bool)
        a, b = (table.column(c).to_numpy().astype(np.int64) for c in ("a", "b"))
        for place in _places(a, b, size * 8):
            bits[place] = True
        return pa.table({"segment": table.column("segment").slice(0, 1), "bytes": [np.packbits(bits).tobytes()]})

    filled = keys.select(*_hashes(key)).groupBy("segment").applyInArrow(fill, "segment long, bytes binary")
    out = np.zeros((SEGMENTS, size), np.uint8)
    for row in filled.collect():
        out[row["segment"]] = np.frombuffer(row["bytes"], np.uint8)
    return out


def bloom_passed(rows: DataFrame, key: str, filled: np.ndarray) -> DataFrame:
    """The rows, without their other columns, whose key may be in the filter; tested where they are read."""
    shared = rows.sparkSession.sparkContext.broadcast(filled)
    schema = rows.select(key).schema

    def test(batches):
        fields, bits = to_arrow_schema(schema), shared.value
        for batch in batches:
            segment = batch.column("segment").to_numpy()
            may = np.ones(len(batch), bool)
            for place in _places(batch.column("a").to_numpy(), batch.column("b").to_numpy(), bits.shape[1] * 8):
                may &= (bits[segment, place >> np.uint64(3)] >> (7 - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1
            kept = batch.column(key).filter(pa.array(may))
            if len(kept):
                yield pa.RecordBatch.from_arrays([kept.cast(fields.field(0).type)], schema=fields)

    keyed = rows.where(F.col(key).isNotNull()).select(key, *_hashes(key))
    return keyed.mapInArrow(test, schema)
