"""A partitioned log in shared storage as a streaming source, without a broker.

A log is a folder of numbered segments, ``partition=P/<first offset>-<records>.jsonl``: the name tells which offsets a
segment holds, so listing alone finds where each partition begins and ends. A segment appears under its name when it is
complete. The source reads every partition of the log in tasks of its own, from offsets that Spark keeps in its
checkpoint; it starts at the newest record unless told otherwise, and bounds a batch on request.

Unusual cases: a record that retention has removed before it was read is an error, not a gap; an empty log has no
offsets yet, and partitions that appear later are read from their beginning; segments of one partition must follow each
other without gaps.
"""

import json
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

LOG_RECORD = "position string, log_partition int, log_offset bigint, arrived_at timestamp, data string"
_SEGMENT = re.compile(r"partition=(\d+)/(\d{20})-(\d+)\.jsonl$")
SEGMENT_RECORDS = 10_000
# partition -> [(first offset, records, path)] in order
Segments = dict[int, list[tuple[int, int, str]]]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path there (local, S3, GCS, HDFS, as Arrow knows them)."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def segments(path: str) -> Segments:
    files, root = opened(path)
    found: Segments = {}
    for info in files.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True)):
        m = _SEGMENT.search(info.path)
        if m:
            found.setdefault(int(m[1]), []).append((int(m[2]), int(m[3]), info.path))
    return {p: sorted(s) for p, s in sorted(found.items())}


def log_ends(path: str) -> dict[int, int]:
    """The offset after the last record of each partition."""
    return {p: s[-1][0] + s[-1][1] for p, s in segments(path).items()}


def _write_segment(path: str, partition: int, first: int, records: list[tuple]) -> None:
    """Whole under its name or not at all; written again after a lost task, it replaces itself."""
    files, root = opened(path)
    folder = f"{root}/partition={partition}"
    files.create_dir(folder, recursive=True)
    name = f"{folder}/{first:020d}-{len(records)}.jsonl"
    lines = (json.dumps({"data": d, "arrived_at": a.isoformat()}, ensure_ascii=False) for a, d in records)
    with files.open_output_stream(f"{folder}/.{first:020d}.writing") as out:
        out.write("".join(f"{line}\n" for line in lines).encode("utf-8", "surrogatepass"))
    files.move(f"{folder}/.{first:020d}.writing", name)


def append_to_log(rows: DataFrame, path: str, order: Sequence[str], segment_records: int = SEGMENT_RECORDS) -> None:
    """Appends (log_partition, arrived_at, data) to a log, each partition in the given order, which must be total.

    One writer at a time: offsets go on from where the log ended when the job began.
    """
    ends = log_ends(path)

    def write(batches):
        partition, first, held = None, 0, []

        def flush():
            nonlocal first
            if held:
                _write_segment(path, partition, first, held)
                first += len(held)
                held.clear()

        for batch in batches:
            for p, arrived, data in zip(*(batch.column(c).to_pylist() for c in ("log_partition", "arrived_at", "data"))):
                if p != partition:
                    flush()
                    partition, first = p, ends.get(p, 0)
                held.append((arrived, data))
                if len(held) == segment_records:
                    flush()
        flush()
        return iter(())

    keyed = rows.repartition("log_partition").sortWithinPartitions("log_partition", *order)
    keyed.select("log_partition", "arrived_at", "data").mapInArrow(write, "done int").write.format("noop").mode(
        "overwrite").save()


class LogRange(InputPartition):
    """Records ``start`` to ``end`` of one partition, all in one segment."""

    def __init__(self, partition: int, start: int, end: int, first: int, path: str):
        self.partition, self.start, self.end, self.first, self.path = partition, start, end, first, path


class LogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.latest = options.get("startingOffsets", "latest") == "latest"
        self.most = int(options.get("maxRecordsPerTrigger", "0"))
        self.consumer = options.get("consumer")
        self.first: dict[int, int] | None = None
        self.told: dict[int, int] | None = None

    def _first(self) -> dict[int, int]:
        """Where a new checkpoint starts; asked for once, as the log grows."""
        if self.first is None:
            self.first = {p: s[-1][0] + s[-1][1] if self.latest else s[0][0] for p, s in segments(self.path).items()}
        return self.first

    def initialOffset(self) -> dict:
        return _told(self._first())

    def latestOffset(self) -> dict:
        """The log's ends; with a limit at most so many records beyond what was told last, shared by partitions. Spark
        asks for this before it asks where to start."""
        first, found = self._first(), segments(self.path)
        ends = {p: s[-1][0] + s[-1][1] for p, s in found.items()}
        if self.most:
            before = self.told or self._committed() or first
            ends = self._limited(ends, {p: before.get(p, found[p][0][0]) for p in found})
        self.told = ends
        return _told(ends)

    def _limited(self, ends: dict[int, int], before: dict[int, int]) -> dict[int, int]:
        """Partitions with less to read than their share leave the rest to the others."""
        room, out = self.most, {}
        waiting = sorted(ends, key=lambda p: ends[p] - before[p])
        for place, p in enumerate(waiting):
            taken = min(ends[p] - before[p], -(-room // (len(waiting) - place)))
            out[p] = before[p] + taken
            room -= taken
        return out

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        found, before, after = segments(self.path), _known(start), _known(end)
        ranges = []
        for p, stop in after.items():
            if stop < before.get(p, 0):
                raise ValueError(f"partition {p} has been read up to {before[p]}; the consumer's note is from another run")
            own = found.get(p, [])
            at = before.get(p, own[0][0] if own else 0)
            while at < stop:
                place = bisect_right(own, (at, float("inf"))) - 1
                if place < 0 or own[place][0] + own[place][1] <= at:
                    raise FileNotFoundError(f"record {at} of partition {p} is no longer in the log {self.path}")
                first, count, path = own[place]
                ranges.append(LogRange(p, at, min(stop, first + count), first, path))
                at = ranges[-1].end
        return ranges

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.path)
        with files.open_input_stream(partition.path) as source:
            lines = source.read().decode("utf-8", "surrogatepass").split("\n")
        rows = [json.loads(x) for x in lines[partition.start - partition.first:partition.end - partition.first]]
        offsets = range(partition.start, partition.end)
        yield pa.RecordBatch.from_arrays([
            pa.array([f"{partition.partition}-{o}" for o in offsets]),
            pa.array([partition.partition] * len(rows), pa.int32()), pa.array(offsets, pa.int64()),
            pa.array([_moment(r["arrived_at"]) for r in rows], pa.timestamp("us", "UTC")),
            pa.array([r["data"] for r in rows], pa.string()),
        ], names=["position", "log_partition", "log_offset", "arrived_at", "data"])

    def commit(self, end: dict) -> None:
        """Notes how far a named consumer has come, so that a limit also holds for the first batch after a restart."""
        if self.consumer:
            files, root = opened(self.path)
            files.create_dir(f"{root}/_consumers", recursive=True)
            with files.open_output_stream(f"{root}/_consumers/{self.consumer}.json") as out:
                out.write(json.dumps(end).encode())

    def _committed(self) -> dict[int, int] | None:
        if not self.consumer:
            return None
        files, root = opened(self.path)
        try:
            with files.open_input_stream(f"{root}/_consumers/{self.consumer}.json") as source:
                return _known(json.loads(source.read()))
        except FileNotFoundError:
            return None


def _told(offsets: dict[int, int]) -> dict[str, int]:
    return {str(p): o for p, o in sorted(offsets.items())}


def _known(offsets: dict) -> dict[int, int]:
    return {int(p): int(o) for p, o in offsets.items()}


def _moment(told: str) -> datetime:
    moment = datetime.fromisoformat(told)
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


class RequestLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "request_log"

    def schema(self) -> str:
        return LOG_RECORD

    def streamReader(self, schema: StructType) -> LogReader:
        return LogReader(self.options)


def stream_requests_log(
    spark: SparkSession, path: str, starting: str = "latest", max_records: int = 0, consumer: str | None = None
) -> DataFrame:
    """Records of a segment log: position, log partition and offset, arrival, data.

    ``starting`` is ``latest`` or ``earliest`` and counts for a new checkpoint only. ``max_records`` bounds a batch (0: no
    bound). A limited source does not go with the trigger that takes what is available once, as that asks for the end
    only once. A limit needs the name of a ``consumer``, under which the log notes how far it has come, for restarts.
    """
    if max_records and not consumer:
        raise ValueError("a limit needs the name of a consumer")
    spark.dataSource.register(RequestLog)
    reader = spark.readStream.format("request_log").option("path", path).option("startingOffsets", starting)
    if consumer:
        reader = reader.option("consumer", consumer)
    return reader.option("maxRecordsPerTrigger", str(max_records)).load()
