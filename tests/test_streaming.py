import base64
import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ledgertone.operators.scoring import score_texts

from ledgertone.plans import inputs as I
from ledgertone.plans.catalog.streaming import PROCESSED, flat, hash_probabilities
from ledgertone.sources import readers as S
from ledgertone.streaming import requests as R
from ledgertone.streaming import results as K
from ledgertone.streaming.redelivery import drop_redelivered


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not see the test folder


def encoded(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return base64.b64encode(text.encode()).decode()


CASES = [
    ({"request_id": "req-1", "text": " Shares rose. ", "submitted_at": "2026-05-21T12:00:00Z"}, "req-1", None),
    ({"text": "Shares rose."}, "invalid-record-1", R.NO_REQUEST_ID),
    ({"request_id": "req-2", "text": "  "}, "req-2", R.NO_TEXT),
    ({"request_id": None, "text": "x"}, "invalid-record-3", R.NO_REQUEST_ID),
    ({"request_id": 5, "text": 1.5}, "5", None),
    ("{not json", "invalid-record-5", R.INVALID_JSON),
    ("[1,2]", "invalid-record-6", R.NOT_AN_OBJECT),
    ('"text"', "invalid-record-7", R.NOT_AN_OBJECT),
    ("null", "invalid-record-8", R.NOT_AN_OBJECT),
    ('{"request_id":"a","text":"b"} more', "invalid-record-9", R.INVALID_JSON),
    ('{"request_id":"a","text":"b"}]', "invalid-record-10", R.INVALID_JSON),
    ('{"request_id":"a","text":"b"}}', "invalid-record-11", R.INVALID_JSON),
    ('{"request_id":"a"},{"text":"b"}', "invalid-record-12", R.INVALID_JSON),
    ("", "invalid-record-13", R.MISSING_DATA),
]


def predicted(validated):
    ok = F.struct(
        F.lit("positive").alias("label"), F.lit(0.97).alias("score"),
        F.create_map(F.lit("positive"), F.lit(0.97)).alias("probabilities"),
    )
    return validated.withColumn("prediction", F.when(F.col("error_message").isNull(), ok))


def test_every_record_gets_one_answer(spark):
    records = [(i, encoded(v) if v != "" else "") for i, (v, _, _) in enumerate(CASES)]
    records += [(len(CASES), None), (len(CASES) + 1, "***"), (len(CASES) + 2, base64.b64encode(b"\xff\xfe").decode())]
    df = spark.createDataFrame(records, "position bigint, data string")
    got = {r.position: r for r in K.score_requests(df, predicted, F.lit("2026-05-22T00:00:04Z")).collect()}
    assert len(got) == len(records)
    for i, (_, request_id, message) in enumerate(CASES):
        row = got[i]
        assert row.request_id == request_id
        assert (row.status, row.error and row.error.message) == ("error" if message else "success", message)
        assert (row.prediction is None) == (message is not None)
    assert got[0].text == "Shares rose." and got[0].date == "2026-05-21" and got[1].date == "2026-05-22"
    assert got[0].prediction.label == "positive" and got[1].error.type == "InferenceError"
    tail = [got[len(CASES) + i].error.message for i in range(3)]
    assert tail == [R.MISSING_DATA, R.INVALID_JSON, R.INVALID_JSON]


def test_failed_scorer_becomes_an_error_row(spark):
    df = spark.createDataFrame([(0, encoded({"request_id": "r", "text": "t"}))], "position bigint, data string")

    def broken(validated):
        return validated.withColumns(
            {"prediction": F.lit(None).cast("struct<label:string,score:double,probabilities:map<string,double>>"),
             "score_error": F.lit("request timed out.")}
        )

    row = K.score_requests(df, broken).first()
    assert (row.status, row.error.message) == ("error", "request timed out.")


def test_stream_equals_batch_and_retry_changes_nothing(spark, sf_dir, tmp_path):
    records = I.stream_records(spark, sf_dir)
    landed, stored = str(tmp_path / "in"), str(tmp_path / "out")
    records.write.json(landed)
    want = sorted(map(str, flat(K.score_requests(records, hash_probabilities, F.lit(PROCESSED))).collect()))
    # The second run has lost its checkpoint, so the same batch arrives again under the same number.
    for run in range(2):
        K.stream_result_sink(
            S.stream_requests(spark, landed, 1000), hash_probabilities, stored, str(tmp_path / f"c{run}"),
            available_now=True, processed_at=F.lit(PROCESSED), run="r",
        ).awaitTermination()
        assert sorted(map(str, flat(K.read_results(spark, stored)).collect())) == want
        assert spark.read.parquet(stored).count() == len(want)


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, "position bigint, data string").coalesce(1).write.json(f"{folder}/{name}")


def request(i, day=None):
    body = {"request_id": f"r{i}", "text": f"text {i}"}
    return (i, encoded(body | {"submitted_at": f"{day}T01:00:00Z"} if day else body))


def stream(spark, landed, stored, checkpoint, **options):
    records = S.stream_requests(spark, f"{landed}/*")
    K.stream_result_sink(records, predicted, stored, checkpoint, available_now=True, **options).awaitTermination()


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    landed, stored = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, landed, "a", [request(i, "2026-05-21") for i in range(5)])
    stream(spark, landed, stored, str(tmp_path / "c1"))
    other = str(tmp_path / "in2")
    land(spark, other, "b", [request(i, "2026-05-21") for i in (10, 11)])
    stream(spark, other, stored, str(tmp_path / "c2"))
    assert sorted(r.request_id for r in K.read_results(spark, stored).collect()) == ["r0", "r1", "r10", "r11", "r2", "r3", "r4"]
    assert K.read_results(spark, stored, ["2026-05-20"]).count() == 0


def test_a_retry_after_midnight_doubles_nothing(spark, tmp_path):
    """The date of a record without submission time is that of its arrival; the folder of a batch is replaced whole."""
    stored = str(tmp_path / "out")
    rows = [(1, request(1)[1]), (2, request(2)[1])]
    plain = spark.createDataFrame(rows, "position bigint, data string")
    arrived = plain.withColumn("arrived_at", F.to_timestamp(F.lit("2026-05-21 23:59:59")))
    for df, dates in ((arrived, {"2026-05-21"}), (plain, {"2026-05-22"})):
        for at in ("2026-05-21T23:59:59Z", "2026-05-22T00:00:01Z"):
            K.write_results(K.score_requests(df, predicted, F.lit(at)), 0, stored, "r")
        found = K.read_results(spark, stored).collect()
        assert len(found) == 2 and {r.date for r in found} == dates


def test_positions_are_numbers(spark, tmp_path):
    stored = str(tmp_path / "out")
    rows = [(9, encoded({"request_id": "r", "text": "older"})), (10, encoded({"request_id": "r", "text": "newer"}))]
    df = spark.createDataFrame(rows, "log_offset bigint, data string").withColumns({
        "position": F.concat(F.lit("0-"), "log_offset"), "log_partition": F.lit(0),
        "arrived_at": F.to_timestamp(F.lit("2026-05-21 10:00:00")),
    })
    K.write_results(K.score_requests(df, predicted), 0, stored)
    assert [r.text for r in K.read_results(spark, stored).collect()] == ["newer"]
    later = df.where("log_offset = 9").withColumns({
        "log_partition": F.lit(1), "arrived_at": F.to_timestamp(F.lit("2026-05-21 11:00:00")),
        "position": F.lit("1-9"),
    })
    K.write_results(K.score_requests(later, predicted), 1, stored)
    assert [r.text for r in K.read_results(spark, stored).collect()] == ["older"]  # the log's time decides


def test_compaction_keeps_the_newest(spark, tmp_path):
    stored = str(tmp_path / "out")
    for batch in range(4):
        df = spark.createDataFrame([request(i, f"2026-05-2{i % 3}") for i in range(batch, batch + 6)], "position bigint, data string")
        K.write_results(K.score_requests(df, predicted), batch, stored)
    columns = ("request_id", "text", "date", "status")
    want = sorted(map(str, K.read_results(spark, stored).select(*columns).collect()))
    assert K.compact_results(spark, stored) > 3
    assert sorted(map(str, K.read_results(spark, stored).select(*columns).collect())) == want
    assert K.remove_replaced(spark, stored, 0) > 3 and K.remove_replaced(spark, stored, 0) == 0
    assert spark.read.parquet(stored).count() == len(want)
    K.write_results(K.score_requests(df, predicted), 9, stored)
    assert sorted(map(str, K.read_results(spark, stored).select(*columns).collect())) == want


def test_readers_and_compactions_at_once(spark, tmp_path):
    stored, columns = str(tmp_path / "out"), ("request_id", "text", "date", "status")

    def told(results):
        return sorted(map(str, results.select(*columns).collect()))

    for batch in range(3):
        df = spark.createDataFrame([request(i, f"2026-05-2{i % 3}") for i in range(batch, batch + 6)], "position bigint, data string")
        K.write_results(K.score_requests(df, predicted), batch, stored)
    listed = K.read_results(spark, stored)
    want = told(listed)
    assert K.compact_results(spark, stored, ["2026-05-20"]) == 3
    assert K.compact_results(spark, stored) == 7  # what was compacted goes again, with the rest
    assert told(listed) == want == told(K.read_results(spark, stored))  # also one who had listed the files before
    assert K.remove_replaced(spark, stored) == 0 and told(listed) == want  # too young
    one_date = K.read_results(spark, stored, ["2026-05-21"])
    assert {r.date for r in one_date.collect()} == {"2026-05-21"}

    names = K._live_folders(spark, stored, None, K._manifests(spark, stored))
    assert names and all(n.startswith("run=compacted-") for n in names)
    with pytest.raises(RuntimeError, match="another compaction"):
        K._publish(spark, stored, 1, [], names)
    half = K._read_folders(spark, stored, names).drop("run", "batch")
    half.write.partitionBy("date").parquet(f"{stored}/run=compacted-unpublished/batch=-1")
    assert told(K.read_results(spark, stored)) == want  # no manifest names it
    assert K.remove_replaced(spark, stored, 0) == 10 and told(K.read_results(spark, stored)) == want
    assert K.compact_results(spark, str(tmp_path / "nothing")) == 0 == K.read_results(spark, str(tmp_path / "nothing")).count()


class Touchy:
    def predict(self, texts):
        import pandas as pd

        if any("bad" in t for t in texts):
            raise ValueError("cannot score this")
        return pd.DataFrame({"prediction": ["positive" for _ in texts], "score": [0.5 for _ in texts]})


class Missing:
    def __init__(self):
        raise OSError("no model file")


def test_a_failing_text_becomes_an_error_row(spark):
    texts = ["good", "bad one", "good too", "a bad one", "fine"]
    rows = [(i, encoded({"request_id": f"r{i}", "text": t})) for i, t in enumerate(texts)] + [(9, encoded("{"))]
    df = spark.createDataFrame(rows, "position bigint, data string").coalesce(1)
    got = {r.position: r for r in K.score_requests(df, K.scorer_predictions(Touchy)).collect()}
    assert {i: r.status for i, r in got.items()} == {0: "success", 1: "error", 2: "success", 3: "error", 4: "success", 9: "error"}
    assert got[1].error.message == "cannot score this" and got[9].error.message == R.INVALID_JSON
    lost = {r.position: r.error.message for r in K.score_requests(df, K.scorer_predictions(Missing)).collect()}
    assert lost == {**{i: "no model file" for i in range(5)}, 9: R.INVALID_JSON}
    with pytest.raises(Exception, match="cannot score this"):
        score_texts(spark.createDataFrame([("bad",)], "text_clean string"), Touchy).collect()


def test_redelivery_replaces_the_result(spark, tmp_path):
    stored = str(tmp_path / "out")
    for batch, text in enumerate(["first", "second"]):
        rows = [
            (1, encoded({"request_id": "r", "text": "older", "submitted_at": "2026-05-21T01:00:00Z"})),
            (2, encoded({"request_id": "r", "text": text, "submitted_at": "2026-05-21T01:00:00Z"})),
            (3, encoded({"request_id": "r", "text": text, "submitted_at": "2026-05-22T01:00:00Z"})),
        ]
        df = spark.createDataFrame(rows, "position bigint, data string")
        K.write_results(K.score_requests(df, predicted), batch, stored)
    got = {str(r.date): r.text for r in K.read_results(spark, stored).collect()}
    assert got == {"2026-05-21": "second", "2026-05-22": "second"}


def test_remembered_requests_are_not_scored_again(spark, tmp_path):
    landed, stored, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))

    def body(text, day="2026-05-21", name="r"):
        return encoded({"request_id": name, "text": text, "submitted_at": f"{day}T01:00:00Z"})

    deliveries = [
        ([(1, body("a")), (2, body("b")), (3, body("a", "2026-05-22")), (4, body("a", name="s")), (5, "")], 4),
        ([(6, body("b")), (7, body("a", "2026-05-22"))], 0),  # as passed on before, after a restart
        ([(8, body("a")), (9, body("c")), (10, body("b")), (12, ""), (11, body("d", name="s"))], 2),
        ([(13, body("c"))], 1),
    ]
    for i, (rows, more) in enumerate(deliveries):
        land(spark, landed, str(i), rows)
        before = spark.read.parquet(stored).count() if i else 0
        stream(spark, landed, stored, checkpoint, remember="1 day")
        assert spark.read.parquet(stored).count() - before == more
    got = {(r.request_id, str(r.date)): r.text for r in K.read_results(spark, stored).collect() if r.status == "success"}
    assert got == {("r", "2026-05-21"): "c", ("r", "2026-05-22"): "a", ("s", "2026-05-21"): "d"}


def test_forgotten_requests_pass_again(spark, tmp_path):
    landed, stored, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    for i, asked in enumerate([1, 2, 1]):  # the second batch forgets what the first has told
        land(spark, landed, str(i), [request(asked, "2026-05-21")])
        stream(spark, landed, stored, checkpoint, remember="1 millisecond")
    assert spark.read.parquet(stored).count() == 3
    assert sorted(r.request_id for r in K.read_results(spark, stored).collect()) == ["r1", "r2"]


def test_remembered_requests_call_python_by_bucket(spark, tmp_path):
    """Many requests share the calls into Python; those that share a bucket are still told apart, also by date."""
    plan = drop_redelivered(
        spark.readStream.schema("position bigint, request_id string, text string, submitted_at string, "
                                "error_message string").json(str(tmp_path)), "1 day", buckets=2)
    assert plan.schema["position"].dataType.simpleString() == "bigint"
    before = spark.conf.get(K._EMPTY_BATCHES)
    spark.conf.set(K._EMPTY_BATCHES, "false")
    landed, checkpoint, n = str(tmp_path / "in"), str(tmp_path / "c"), 40_000
    big = 1 << 60

    def land_rows(first, text):
        spark.range(n).selectExpr(
            f"IF(id % 7 = 0, NULL, {big} + {first} + id) AS position", "CAST(id % 30000 AS string) AS request_id",
            f"{text} AS text", "concat('2026-05-2', id % 2, 'T01:00:00Z') AS submitted_at",
            "CAST(NULL AS string) AS error_message",
        ).write.mode("append").json(landed)

    def passed():
        got = []
        records = spark.readStream.schema(plan.schema).json(landed)
        job = drop_redelivered(records, "1 day").writeStream.foreachBatch(
            lambda batch, _: got.extend(batch.collect())).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start()
        try:
            assert job.awaitTermination(120)
        finally:
            job.stop()
        return got

    land_rows(0, "concat('t', id % 30000)")
    first = passed()
    assert len(first) == len({(r.request_id, r.submitted_at) for r in first}) == 30_000
    assert all(r.position is None or r.position >= big and int(r.request_id) == (r.position - big) % 30_000 for r in first)
    assert {r.position for r in first if int(r.request_id) == 1} == {big + 30_001}
    land_rows(n, "IF(id % 30000 < 5, 'changed', concat('t', id % 30000))")
    try:
        assert sorted((int(r.request_id), r.text) for r in passed()) == [(i, "changed") for i in range(5)]
    finally:
        spark.conf.set(K._EMPTY_BATCHES, before)


def test_requests_round_trip(spark):
    texts = spark.createDataFrame([("  hello  ",), ("   ",), ("é",)], "text string")
    made = R.build_requests(texts).collect()
    assert len(made) == 2
    for row in made:
        body = json.loads(row.value)
        assert body["request_id"] == row.key and len(row.key) == 36 and body["submitted_at"].endswith("Z")


def test_log_source_options():
    options = S.kafka_options("host:9092", "requests", 500)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "500"
    assert "failOnDataLoss" not in options  # lost records must not vanish silently


def test_jdbc_options():
    from ledgertone.sinks.tables import jdbc_write_options

    read = S.jdbc_read_options(
        "jdbc:postgresql://h/db", "t", "u", "p", partition_column="id", lower=1, upper=1000, partitions=16
    )
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == (
        "id", "1", "1000", "16")
    assert "partitionColumn" not in S.jdbc_read_options("url", "t", "u", "p")
    assert jdbc_write_options("url", "t", "u", "p", connections=4)["numPartitions"] == "4"


if __name__ == "__main__":
    pytest.main([__file__])
