"""CSV read by ranges against Spark's own reader, and headers from the beginning of files."""

import gzip
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgertone.sources import csv_ranges as C
from ledgertone.sources import readers as S


def plain_ends_open(line, opened):
    """The states of a CSV parser, a character at a time."""
    state = "within" if opened else "begin"
    for c in line:
        if state == "within":
            state = "quote" if c == '"' else "within"
        elif state == "quote" and c == '"':
            state = "within"
        elif c == ",":
            state = "begin"
        elif state == "begin" and c == '"':
            state = "within"
        else:
            state = "plain"
    return state == "within"


@settings(max_examples=500, deadline=None)
@given(st.text('"",a\r ', max_size=25), st.booleans())
def test_ends_open_against_plain(line, opened):
    assert C.ends_open(line, opened) == plain_ends_open(line, opened)


def field(draw):
    parts = ["a", "b\u00e9", " ", "\n", "\r\n", ",", '""', "x", "", '"" ""']
    text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 30)))
    if draw.random() < 0.5:
        return f'"{text}"'
    text = text.translate({ord(c): None for c in '\n\r,"'})
    return f'in"side{text}' if draw.random() < 0.2 else text


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "100"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def written(path, ending, tail="", rows=800, seed=1):
    draw = random.Random(seed)
    lines = [f"{i},{field(draw)},{field(draw)}" for i in range(rows)]
    path.write_bytes((ending.join(["id,text,label", *lines]) + ending + tail).encode())
    return str(path)


@pytest.mark.parametrize("ending,tail", [
    ("\n", ""), ("\r\n", ""), ("\n", '"' + "y\n" * 3000 + '",a,b\n7,8'), ("\n", '1,"never closed\n2,3,4'),
    ("\n", "\n\n\n5,6,7"),
], ids=["lines", "returns", "record over many ranges", "unclosed", "empty lines"])
def test_ranges_hold_the_rows_of_the_whole_file(spark, tmp_path, small_ranges, ending, tail):
    path = written(tmp_path / "one.csv", ending, tail)
    schema = S._strings(("id", "text", "label"))
    by_ranges = S.scan_csv_ranges(spark, [path], schema)
    whole = S._scan_whole_files(spark, path, schema)
    assert C._lines(spark, [path]).rdd.getNumPartitions() > 10
    assert sorted(map(str, by_ranges.collect())) == sorted(map(str, whole.collect()))


def test_landing_reads_large_files_by_ranges_and_small_ones_whole(spark, tmp_path, small_ranges):
    large = written(tmp_path / "large.csv", "\n")
    (tmp_path / "small.csv").write_text("id,text,label\n1,\"a\nb\",c\n")
    (tmp_path / "other.CSV").write_text("id,text,note\n" + "2,x,y\n" * 1000)
    rows = S.scan_landing_csv(spark, str(tmp_path))
    assert sorted(rows.columns) == ["id", "label", "note", "source_path", "text"]
    counts = {r["source_path"].rsplit("/", 1)[1]: r["count"] for r in rows.groupBy("source_path").count().collect()}
    whole = S._scan_whole_files(spark, large, S._strings(("id", "text", "label"))).count()
    assert counts == {"large.csv": whole, "small.csv": 1, "other.CSV": 1000}
    assert rows.where("id = '1' AND text = 'a\nb'").count() >= 1
    with pytest.raises(ValueError, match="header"):
        S.scan_landing_csv(spark, large, S._strings(("a", "b", "c")))


def test_ranges_that_moved_are_an_error():
    ranges = [(0, 100, True), (300, 100, False)]
    assert [C._begins_open(ranges, b, 100) for b in (0, 100, 200, 300, 400)] == [False, True, True, True, False]
    assert C._begins_open([], 100, 50) is False and C._begins_open(ranges, 100, 200) is True
    for block, size in ((0, 50), (50, 100), (250, 100), (300, 50), (350, 100)):
        with pytest.raises(ValueError, match="ranges changed"):
            C._begins_open(ranges, block, size)


def test_headers_come_from_the_beginning_of_files(spark, tmp_path):
    files = {
        "plain.csv": b"a,b\n" + b"1,2\n" * 200_000, "mark.csv": "\ufeffa,b\r\n1,2".encode(), "empty.csv": b"",
        "break.csv": b'"a\nb","c ""d"""\n1,2\n', "long.csv": ",".join(f"c{i}" for i in range(20_000)).encode(),
        "packed.csv.gz": gzip.compress(b"x,y\n1,2\n"),
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    paths = [str(tmp_path / n) for n in [*files, "absent.csv"]]
    found = {p.rsplit("/", 1)[1]: names for p, names in C.csv_headers(spark, paths).items()}
    assert found.pop("long.csv") == tuple(f"c{i}" for i in range(20_000))
    assert found == {"plain.csv": ("a", "b"), "mark.csv": ("a", "b"), "break.csv": ("a\nb", 'c "d"'),
                     "packed.csv.gz": ("x", "y")}
