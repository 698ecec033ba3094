"""Large CSV files with quoted line breaks, read by ranges.

A range of a file cannot tell by itself whether its first line begins a record or lies within quotes. So a first pass,
over lines that hold a quote only, works out for every range how it would end under both hypotheses. Composed range by
range these settle how each one begins; a second pass then cuts every range into records from its first true beginning.
Records that reach over a range's end are put together from their pieces. Fields are parsed by Spark.

Results for unusual input: an empty file has no records; empty lines outside quotes are none; a quote inside an unquoted
field is an ordinary character; an unclosed quote takes the rest of its file, as for Spark's own reader, but for a line
break at its end. Lines end with \\n or \\r\\n, as the first line shows. A file whose ranges are cut otherwise in the
second pass than in the first is an error, not a guess.
"""

import csv
import io
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertone.session import computed_once, small_side, stage

_WITHIN = re.compile(r'(?:[^"]++|"")*+')
_HEADER_BYTES, _OPENERS = 1 << 16, 16
_TURNS = "source_path string, block long, size long, from_closed boolean, from_open boolean"
_RECORDS = "source_path string, block long, at long, part string, record string"


def ends_open(line: str, opened: bool = False) -> bool:
    """Whether a line ends within quotes; ``opened`` says whether it begins within them."""
    at = 0
    if not opened:
        at = 0 if line.startswith('"') else line.find(',"') + 1
        if not at and not line.startswith('"'):
            return False
        at += 1
    while True:
        at = _WITHIN.match(line, at).end()
        if at == len(line):
            return True
        at = line.find(',"', at + 1) + 2
        if at == 1:
            return False


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("size"), "value",
    )


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array]]:
    """((path, start, size), lines) for each run of rows of one range."""
    for batch in batches:
        blocks, paths = batch.column("block"), batch.column("source_path")
        at = 0
        while at < len(batch):
            same = pc.and_(pc.equal(blocks, blocks[at]), pc.equal(paths, paths[at])).slice(at)
            other = pc.index(same, False).as_py()
            size = len(same) if other < 0 else other
            yield (paths[at].as_py(), blocks[at].as_py(), batch.column("size")[at].as_py()), batch.column(
                "value").slice(at, size)
            at += size


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(key, ends):
        return pa.RecordBatch.from_pydict(dict(zip(
            ("source_path", "block", "size", "from_closed", "from_open"), ([v] for v in (*key, *ends)))))

    key, ends = None, (False, True)
    for found, lines in _by_range(batches):
        if found != key:
            if key is not None:
                yield row(key, ends)
            key, ends = found, (False, True)
        for line in lines.to_pylist():
            closed = ends_open(line, ends[0])
            ends = (closed, closed if ends[0] == ends[1] else ends_open(line, ends[1]))
    if key is not None:
        yield row(key, ends)


def range_states(lines: DataFrame) -> dict[str, list[tuple[int, int, bool]]]:
    """Of files in which some range begins within quotes: (start, size, ends within quotes) of the ranges with quotes.

    One entry for each range of such a file, as the scheduler holds one for each range of every file.
    """
    turns = lines.where(F.contains("value", F.lit('"'))).mapInArrow(_turns, _TURNS)
    ranges = turns.groupBy("source_path").agg(
        F.array_sort(F.collect_list(F.struct("block", "size", "from_closed", "from_open"))).alias("ranges")
    ).where(F.exists("ranges", lambda r: r["from_closed"]))
    states = {}
    for path, found in ((r["source_path"], r["ranges"]) for r in ranges.toLocalIterator()):
        states[path], opened = [], False
        for r in found:
            opened = r["from_open"] if opened else r["from_closed"]
            states[path].append((r["block"], r["size"], opened))
    return states


def _begins_open(ranges: list[tuple[int, int, bool]], block: int, size: int) -> bool:
    """How a range begins; ranges with quotes must be those of the first pass."""
    place = bisect_right(ranges, (block, -1, False))
    for start, length, _ in ranges[max(0, place - 1):place + 1]:
        if (start, length) != (block, size) and start < block + size and block < start + length:
            raise ValueError("the file's ranges changed between two passes; fix spark.sql.files.minPartitionNum")
    return place > 0 and ranges[place - 1][2]


def _cutter(states: dict):
    """Lines to records. ``part`` is empty for a whole record; pieces of one that reaches over a range's end are
    'first', 'inner' (its whole range lies within the record) or 'last'."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, opened, at, begun = None, [], False, 0, False
        out: list[tuple] = []

        def rows():
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                names=["source_path", "block", "at", "part", "record"],
            )
            out.clear()
            return made

        def close(part):
            nonlocal at, begun
            out.append((key[0], key[1], at, part, "\n".join(held)))
            held.clear()
            at, begun = at + 1, True

        for found, lines in _by_range(batches):
            if found != key:
                if held:
                    close("first" if begun else "inner")
                key, at = found, 0
                opened = _begins_open(states.get(found[0], []), found[1], found[2])
                begun = not opened
            quoted = pc.match_substring(lines, '"')
            if not opened and not pc.any(quoted).as_py():
                out += [(key[0], key[1], at + i, "", line) for i, line in enumerate(lines.to_pylist())]
                at += len(lines)
            else:
                for line, has_quote in zip(lines.to_pylist(), quoted.to_pylist()):
                    held.append(line)
                    opened = ends_open(line, opened) if has_quote else opened
                    if not opened:
                        close("" if begun else "last")
            if out:
                yield rows()
        if held:
            close("first" if begun else "inner")
        if out:
            yield rows()

    return cut


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(source_path, block, at, record): the records of the files as text, numbered within the range they begin in."""
    lines = _lines(spark, paths)
    found = stage(lines.mapInArrow(_cutter(range_states(lines)), _RECORDS), "records")
    pieces = found.where("part <> ''")
    order = W.partitionBy("source_path").orderBy("block", "at")
    pieces = pieces.withColumn("number", F.sum((F.col("part") == "first").cast("long")).over(order))
    whole = pieces.groupBy("source_path", "number").agg(
        F.min(F.struct("block", "at")).alias("begins"),
        F.array_join(F.sort_array(F.collect_list(F.struct("block", "at", "record")))["record"], "\n").alias("record"),
    ).select("source_path", "begins.block", "begins.at", "record")
    return found.where("part = ''").select(*whole.columns).unionByName(whole)


def scan_csv_ranges(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Header CSV files of one shape, each read by as many tasks as it has ranges; ``source_path`` added.

    The text is scanned twice, once for quotes only, and the records are written once in between.
    """
    records, is_header = csv_records(spark, paths), F.expr("block = 0 AND at = 0")
    # A file whose first line ends with \r\n has line breaks of that kind, which read as \n.
    returns = records.where(is_header).select(
        F.col("source_path").alias("path"), F.col("record").rlike(r"\A[^\n]*\r(\n|\z)").alias("returns")
    )
    records = records.where(~is_header).join(small_side(returns), F.col("source_path") == F.col("path"))
    plain = F.regexp_replace(F.regexp_replace("record", r"\r\z", ""), "\r\n", "\n")
    records = records.withColumn("record", F.when(F.col("returns"), plain).otherwise(F.col("record"))).where("record <> ''")
    names = ", ".join("`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString() for f in schema.fields)
    options = {"escape": '"', "multiLine": "true"}
    parsed = computed_once(records.select("source_path", "record"), row=F.from_csv("record", names, options))
    return parsed.select("row.*", "source_path")


def csv_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Column names of each CSV file, from the beginning of the file only; unreadable and empty ones are absent.

    Reads one buffer of each file, more only where the header is longer. Files open from the driver, several at a time,
    on whatever file system their paths name; the reader needs their list there in any case.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(path: str) -> tuple[str, ...]:
        target = jvm.org.apache.hadoop.fs.Path(path)
        try:
            stream = target.getFileSystem(conf).open(target)
        except Py4JJavaError:
            return ()
        try:
            codec = codecs.getCodec(target)
            source = codec.createInputStream(stream) if codec is not None else stream
            record, opened, rest = [], False, b""
            while True:
                data = bytes(source.readNBytes(_HEADER_BYTES))
                lines = (rest + data).split(b"\n")
                rest = lines.pop() if data else b""
                for line in lines:
                    record.append(line.decode("utf-8", "replace"))
                    opened = ends_open(record[-1].removeprefix("\ufeff"), opened)
                    if not opened:
                        break
                if not data or (record and not opened):
                    break
        except Py4JJavaError:
            return ()
        finally:
            stream.close()
        told = "\n".join(record).removeprefix("\ufeff").removesuffix("\r")
        return tuple(next(csv.reader(io.StringIO(told, newline=""), doublequote=True), ()))

    with ThreadPoolExecutor(_OPENERS) as pool:
        return {path: names for path, names in zip(paths, pool.map(header, paths)) if names}
