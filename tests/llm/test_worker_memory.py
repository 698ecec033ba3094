"""What a Python worker takes and keeps, as an executor has more of them than cores."""

from pathlib import Path

import pyarrow as pa

from ledgertone.llm import batches, packing, quality_rules
from ledgertone.llm.batches import handing_back, started, whole_rows


def resident_mb():
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6


def test_memory_goes_back_at_the_end_of_a_partition():
    pinned, held = [], []

    def run(given):
        words = [bytes(1000) for _ in range(150_000)]
        pinned.append(bytes(1000))  # lies above them, so the heap cannot shrink by itself
        yield from given
        del words
        held.append(resident_mb())

    assert list(handing_back(run)([1, 2])) == [1, 2]
    assert held[0] - resident_mb() > 75


def test_tables_go_with_the_first_task_that_does_not_ask_for_them(monkeypatch):
    monkeypatch.setattr(packing, "WordIds", lambda file: [file])
    table = started(lambda: packing.word_ids("a file"))
    assert started(lambda: packing.word_ids("a file")) is table
    assert started(lambda: "other work") == "other work"
    assert not batches._TABLES


def test_the_text_is_not_in_the_row_too(frame):
    rows = whole_rows(frame([(1, "a text")]))
    assert rows.columns == ["row", "doc_id", "text"]
    assert "text" not in rows.schema["row"].dataType.names and "doc_id" in rows.schema["row"].dataType.names


def test_quality_rules_take_a_megabyte_at_a_time(frame, monkeypatch):
    limits = []
    plain = quality_rules.map_slices

    def spied(*given, **named):
        limits.append(named["limit"])
        return plain(*given, **named)

    monkeypatch.setattr(quality_rules, "map_slices", spied)
    docs = frame([(1, " ".join(f"word{i}" for i in range(30))), (2, "too few words")])
    assert quality_rules.quality_rules(docs).count() == 2
    assert [r.doc_id for r in quality_rules.cleaned(docs).collect()] == [1]
    assert limits == [1 << 20] * 2


def test_slices_are_cut_by_text():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 300_000] * 10})
    assert [len(p) for p in batches.slices(batch, "text", quality_rules.SLICE_BYTES)] == [3, 3, 3, 1]
