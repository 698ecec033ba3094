"""Arrow plumbing shared by the text operators: slices of bounded size, and rows built from Python columns."""

import ctypes
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType, _parse_datatype_string

SLICE_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20
_SLICE_ROWS = 20_000
_TABLES: dict[Hashable, object] = {}
_ASKED: set[Hashable] = set()


def kept_table(key: Hashable, make: Callable[[], object]) -> object:
    """A table that costs time to fill, one for each Python worker: tasks that follow one another in a worker share it.
    The first task of ``map_slices`` that does not ask for it drops it."""
    _ASKED.add(key)
    if key not in _TABLES:
        _TABLES[key] = make()
    return _TABLES[key]


def started(start: Callable) -> Callable:
    """The function that ``start`` returns; tables that it did not ask for go."""
    _ASKED.clear()
    work = start()
    for key in _TABLES.keys() - _ASKED:
        del _TABLES[key]
    return work


def return_memory() -> None:
    """What was freed goes back to the system. Workers outlive their tasks, and an executor has more of them than
    cores as soon as a stage has several steps in Python; the idle ones would hold what their largest task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def handing_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` that returns its memory at the end of the partition."""

    def wrapped(batches):
        yield from run(batches)
        return_memory()

    return wrapped


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch after about ``limit`` bytes of text; a longer text is a slice of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    start = 0
    while start < len(size):
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + limit, side="right"))
        stop = min(max(stop, start + 1), start + _SLICE_ROWS)
        yield batch.slice(start, stop - start)
        start = stop


def parsed(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else _parse_datatype_string(schema)


def map_slices(
    rows: DataFrame, schema: str | StructType, start: Callable[[], Callable[[pa.RecordBatch], list | None]],
    text: str = "text", limit: int = SLICE_BYTES, finish: Callable | None = None,
) -> DataFrame:
    """Runs a function over slices of each partition, as Arrow batches.

    ``start()`` is called once in each task and returns the function, so tables that it needs live as long as
    the task. The function gets a slice and returns the result's columns in the order of ``schema``, or None
    for no rows yet. ``finish(function)`` may yield more lists of columns at the end of the partition.
    """
    target = parsed(schema)

    def run(batches):
        fields = to_arrow_schema(target)
        work = started(start)

        def made(columns):
            arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                      for c, f in zip(columns, fields, strict=True)]
            return pa.RecordBatch.from_arrays(
                [a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, fields)], schema=fields
            )

        for batch in batches:
            for piece in slices(batch, text, limit):
                columns = work(piece)
                if columns is not None and len(columns[0]):
                    yield made(columns)
        for columns in finish(work) if finish else ():
            if len(columns[0]):
                yield made(columns)

    return rows.mapInArrow(handing_back(run), target)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that most operators read, under fixed names; other columns never reach the operator."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def id_type(docs: DataFrame, id_col: str = "doc_id") -> str:
    return docs.schema[id_col].dataType.simpleString()


def in_blocks(rows: DataFrame, text: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """The rows with a column ``block`` in front: runs of rows of one partition with at most ``limit`` bytes of text
    (a longer text is a block of its own). Write the result before using it: another run may cut elsewhere."""
    target = StructType([StructField("block", LongType(), False), *rows.schema.fields])

    def deal(batches):
        fields = to_arrow_schema(target)
        block, room = TaskContext.get().partitionId() << 32, limit
        for batch in batches:
            for piece in slices(batch, text, limit // 16):
                size = pc.sum(pc.binary_length(piece.column(text))).as_py() or 0
                if room < size:
                    block, room = block + 1, limit
                room -= size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(piece), block)), *piece.columns], schema=fields
                )

    return rows.mapInArrow(handing_back(deal), target)


def whole_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns but the text as one struct ``row``, beside the id and the text under fixed names, so that no names can
    clash and the text moves once."""
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() != text_col.lower()]
    return docs.select(
        F.struct(*others).alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def with_new_text(done: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """The columns of ``row`` as they were, and among them the text, which is ``new_text``."""
    return done.select(*[
        F.col("new_text").alias(c) if c.lower() == text_col.lower() else F.col("row")[c].alias(c) for c in columns
    ])


def row_schema(rows: DataFrame, *fields: StructField) -> StructType:
    return StructType([rows.schema["row"], *fields])


def block_runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[int, list[list]]]:
    """(block, columns as lists) for each run of rows of one block; a block that a scan has split comes twice."""
    block, held = None, [[] for _ in columns]
    for batch in batches:
        owners = batch.column("block").to_pylist()
        values = [batch.column(c).to_pylist() for c in columns]
        for i, owner in enumerate(owners):
            if owner != block and held[0]:
                yield block, held
                held = [[] for _ in columns]
            block = owner
            for mine, column in zip(held, values):
                mine.append(column[i])
    if held[0]:
        yield block, held


def packed(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit keys as differences, bytes of equal significance together, compressed."""
    return packed_plain(np.diff(keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked_plain(data), dtype=np.uint64)


def packed_plain(values: np.ndarray) -> bytes:
    """64-bit values, bytes of equal significance together, compressed."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked_plain(data: bytes, dtype=np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def merged_blocks(table: pa.Table, keys: str = "keys", counts: str = "counts") -> dict[int, tuple]:
    """Keys (sorted, distinct) and counts of each block in a table of packed columns; a block's rows are added up."""
    out: dict[int, tuple] = {}
    columns = (table.column(c).to_pylist() for c in ("block", keys, counts))
    for block, own, n in zip(*columns):
        own, n = unpacked(own), unpacked_plain(n, np.int64)
        if block in out:
            own, codes = np.unique(np.concatenate([out[block][0], own]), return_inverse=True)
            n = np.bincount(codes, np.concatenate([out[block][1], n]), len(own)).astype(np.int64)
        out[block] = own, n
    return out


def summed(blocks: dict[int, tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All distinct keys of several blocks, their sums, and where each block's keys lie, block after block."""
    every, codes = np.unique(np.concatenate([k for k, _ in blocks.values()]), return_inverse=True)
    totals = np.bincount(codes, np.concatenate([n for _, n in blocks.values()]), len(every)).astype(np.int64)
    return every, totals, codes
