"""Exact duplicates by a tree of merges over sorted digest runs.

Each partition makes a sorted run of the digests of its texts, one entry for each distinct text. In rounds, runs whose
numbers agree but for their last digit (base ``fan_in``) meet and are merged; equal entries become one that keeps the
winning identifier and the number of members. After the last round one run is left for each range of the digest space,
and only ranges, never the whole, meet in a task. A text that a third of all rows share is one entry in each run.

An entry is a SHA-256, a second, independent 128-bit digest and the length in bytes. Entries merge only if all three
agree; equal SHA-256 with anything else different stays apart. Texts compare equal up to the case of A to Z.

Results for unusual rows: a null text counts as an empty one. Repeated rows are members like any other; of rows that
share the winning id, exactly one stays. A null id loses against any other; ``keep_id`` is null if all ids are. An
empty table gives an empty result. Other columns are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertone.llm.batches import id_and_text, id_type, map_slices
from ledgertone.session import scratch_path

FAN_IN = 8
RANGE_ROWS = 1_000_000
ENTRY = ("sha", "check", "n_bytes")


def normalised(text: str | None) -> bytes:
    """A to Z in lower case and nothing else changed: bytes.lower() touches ASCII letters only."""
    return text.encode().lower() if text else b""


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document; ``row`` tells rows apart that share an id."""

    def start():
        part = TaskContext.get().partitionId()
        seen = 0

        def run(piece):
            nonlocal seen
            data = [normalised(t) for t in piece.column("text").to_pylist()]
            rows = np.arange(seen, seen + len(data), dtype=np.int64) + (part << 36)
            seen += len(data)
            return [
                piece.column("doc_id"), rows, np.full(len(data), part), [hashlib.sha256(d).digest() for d in data],
                [xxhash.xxh3_128_digest(d) for d in data], [len(d) for d in data],
            ]

        return run

    schema = f"doc_id {id_type(docs, id_col)}, row long, run long, sha binary, check binary, n_bytes long"
    return map_slices(id_and_text(docs, id_col, text_col), schema, start)


def merge_runs(table: pa.Table, largest: bool = True) -> pa.Table:
    """Sorted runs in, one sorted run out; equal entries become one, with the winning (id, row) and all members.

    NumPy's stable sort merges runs that are already in order. The first eight bytes order the entries; where they
    agree, whole entries are compared.
    """
    sha = table.column("sha").to_pylist()
    head = np.frombuffer(b"".join(s[:8] for s in sha), ">u8").astype(np.uint64)
    order = np.argsort(head, kind="stable")
    check, size = table.column("check").to_pylist(), table.column("n_bytes").to_pylist()
    ids, rows = table.column("keep_id").to_pylist(), table.column("keep_row").to_pylist()
    members = table.column("members").to_pylist()
    out: list[int] = []
    winner: dict[int, int] = {}
    total: dict[int, int] = {}
    block: dict[tuple, int] = {}
    last = None

    def better(a: int, b: int) -> bool:
        if ids[a] is None or ids[b] is None:
            return (ids[a] is not None, -rows[a]) > (ids[b] is not None, -rows[b])
        if ids[a] != ids[b]:
            return (ids[a] > ids[b]) == largest
        return rows[a] < rows[b]

    for i in order.tolist():
        if head[i] != last:
            out += sorted(block.values(), key=lambda j: (sha[j], check[j], size[j]))
            block, last = {}, head[i]
        j = block.setdefault((sha[i], check[i], size[i]), i)
        total[j] = total.get(j, 0) + members[i]
        if j == i or better(i, winner[j]):
            winner[j] = i
    out += sorted(block.values(), key=lambda j: (sha[j], check[j], size[j]))
    merged = table.take(pa.array(out, pa.int64()))
    won = [winner[j] for j in out]
    for name, values in (
        ("keep_id", [ids[w] for w in won]), ("keep_row", [rows[w] for w in won]), ("members", [total[j] for j in out])
    ):
        at = merged.schema.get_field_index(name)
        merged = merged.set_column(at, merged.schema.field(at), pa.array(values, merged.schema.field(at).type))
    return merged


def exact_groups(entries: DataFrame, ranges: int, largest: bool = True, fan_in: int = FAN_IN) -> DataFrame:
    """Entries (``digests``) to one row for each distinct text: keep_id, keep_row and members."""
    space = F.conv(F.substring(F.hex("sha"), 1, 8), 16, 10).cast("long")
    runs = entries.select(
        (space * ranges / F.lit(1 << 32)).cast("long").alias("span"), "run", *ENTRY,
        F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("members"),
    )
    schema = runs.schema

    def local_runs(batches):
        for batch in batches:
            yield from merge_runs(pa.Table.from_batches([batch]), largest).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        return merge_runs(table, largest)

    last = entries.agg(F.max("run")).first()[0] or 0
    runs = runs.mapInArrow(local_runs, schema)
    while True:
        last //= fan_in
        runs = runs.withColumn("run", F.expr(f"run div {fan_in}"))
        runs = runs.groupBy("span", "run").applyInArrow(merge, schema)
        if not last:
            return runs


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document: the id that its group keeps, the group's size, and whether this row stays.

    ``keep`` is "smallest" or "largest". Digests are written once to shared storage; texts are never shuffled.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "digests")
    found = digests(docs, id_col, text_col)
    found.write.parquet(path)
    entries = spark.read.schema(found.schema).parquet(path)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries.count() // RANGE_ROWS))
    groups = exact_groups(entries, ranges, keep == "largest", fan_in)
    return entries.join(groups.drop("span", "run"), list(ENTRY)).select(
        "doc_id", "keep_id", F.col("members").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
