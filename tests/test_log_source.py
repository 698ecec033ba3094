"""The segment log as a streaming source: newest first, restarts, limits, retention."""

import pathlib

import pytest
from pyspark.errors import StreamingQueryException

from ledgertone.sources import readers as S
from ledgertone.streaming import log_source as L


def records(spark, first, last, partitions=2):
    return spark.range(first, last).selectExpr(
        f"CAST(id % {partitions} AS INT) AS log_partition", "id", "timestamp'2024-06-01 10:00:00' AS arrived_at",
        "concat('r', id, ' \n é') AS data",
    )


def run(spark, log, out, checkpoint, **options):
    rows = L.stream_requests_log(spark, str(log), **options)
    job = rows.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(
        availableNow=True).start()
    job.awaitTermination()
    return sorted((r.log_partition, r.log_offset, r.data) for r in spark.read.schema(rows.schema).parquet(str(out)).collect())


def want(first, last):
    return sorted((i % 2, i // 2, f"r{i} \n é") for i in range(first, last))


def test_latest_leaves_out_what_was_there_and_a_restart_goes_on(spark, tmp_path):
    log, out, checkpoint = tmp_path / "log", tmp_path / "out", tmp_path / "checkpoint"
    L.append_to_log(records(spark, 0, 100), str(log), ["id"], segment_records=7)
    assert L.log_ends(str(log)) == {0: 50, 1: 50}
    assert run(spark, log, out, checkpoint) == []
    L.append_to_log(records(spark, 100, 160), str(log), ["id"], segment_records=7)
    assert run(spark, log, out, checkpoint) == want(100, 160)
    assert run(spark, log, out, checkpoint) == want(100, 160)  # nothing twice
    L.append_to_log(records(spark, 160, 200), str(log), ["id"])
    assert run(spark, log, out, checkpoint, starting="earliest") == want(100, 200)  # the checkpoint counts
    assert run(spark, log, tmp_path / "other", tmp_path / "fresh", starting="earliest") == want(0, 200)
    assert all(r.position for r in spark.read.parquet(str(out)).collect())


def test_batches_are_bounded_also_after_a_restart(spark, tmp_path):
    log, out, checkpoint = tmp_path / "log", tmp_path / "out", tmp_path / "checkpoint"
    L.append_to_log(records(spark, 0, 100), str(log), ["id"], segment_records=9)
    sizes = []

    def sink(batch, number):
        sizes.append(batch.count())
        batch.write.mode("append").parquet(str(out))

    def started():
        rows = L.stream_requests_log(spark, str(log), "earliest", max_records=30, consumer="scoring")
        return rows.writeStream.foreachBatch(sink).option("checkpointLocation", str(checkpoint)).start()

    job = started()
    job.processAllAvailable()
    job.stop()
    assert sum(sizes) == 100 and max(sizes) == 30
    L.append_to_log(records(spark, 100, 200), str(log), ["id"], segment_records=9)
    job = started()
    job.processAllAvailable()
    job.stop()
    assert sum(sizes) == 200 and max(sizes) == 30
    rows = spark.read.parquet(str(out)).collect()
    assert sorted((r.log_partition, r.log_offset, r.data) for r in rows) == want(0, 200)


def test_limit_is_shared_by_partitions(tmp_path):
    reader = L.LogReader({"path": str(tmp_path), "maxRecordsPerTrigger": "10"})
    assert reader._limited({0: 100, 1: 2, 2: 50}, {0: 0, 1: 0, 2: 49}) == {0: 7, 1: 2, 2: 50}
    assert reader._limited({0: 3}, {0: 0}) == {0: 3} and reader._limited({}, {}) == {}
    assert reader.latestOffset() == {} == reader.initialOffset()


def test_new_partitions_and_removed_records(spark, tmp_path):
    log, out, checkpoint = tmp_path / "log", tmp_path / "out", tmp_path / "checkpoint"
    L.append_to_log(records(spark, 0, 20, 1), str(log), ["id"], segment_records=5)
    assert run(spark, log, out, checkpoint) == []
    L.append_to_log(records(spark, 20, 40, 4).where("log_partition = 3"), str(log), ["id"])
    assert [r[:2] for r in run(spark, log, out, checkpoint)] == [(3, i) for i in range(5)]
    L.append_to_log(records(spark, 40, 60, 1), str(log), ["id"], segment_records=5)
    lost = next(pathlib.Path(log).glob("partition=0/*20-*"))
    kept = lost.read_bytes()
    lost.unlink()
    with pytest.raises(StreamingQueryException, match="no longer in the log"):
        run(spark, log, out, checkpoint)
    lost.write_bytes(kept)
    assert len(run(spark, log, out, checkpoint)) == 25


def test_a_segment_that_is_being_written_is_not_seen(tmp_path):
    folder = tmp_path / "partition=0"
    folder.mkdir()
    (folder / f".{0:020d}.writing").write_text("half")
    (folder / f"{0:020d}-2.jsonl").write_text("")
    assert L.segments(f"file:{tmp_path}") == {0: [(0, 2, str(folder / f"{0:020d}-2.jsonl"))]}


def test_same_columns_as_the_broker_reader(spark, tmp_path):
    fields = {f.name: f.dataType.simpleString() for f in L.stream_requests_log(spark, str(tmp_path)).schema.fields}
    assert fields == {"position": "string", "log_partition": "int", "log_offset": "bigint", "arrived_at": "timestamp",
                      "data": "string"}
    with pytest.raises(ValueError, match="consumer"):
        L.stream_requests_log(spark, str(tmp_path), max_records=5)
    assert S.kafka_options("s", "t")["startingOffsets"] == "latest"
