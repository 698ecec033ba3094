"""Request stream (R, K11): bounded twins, and the streaming job itself."""

from pyspark.sql import functions as F

from ledgertone.functions.labels import canonical_prediction
from ledgertone.functions.text import hash_bucket
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.features import BucketScorer
from ledgertone.plans.catalog.registry import query
from ledgertone.schemas import LABELS
from ledgertone.session import computed_once, scratch_path
from ledgertone.sources import readers as S
from ledgertone.streaming import requests as R
from ledgertone.streaming import results as K

PROCESSED = "2024-06-01T00:00:00Z"
_B = [f"CAST({Q.bucket(f'sha256(concat({chr(39)}{n}|{chr(39)}, text))')} AS DOUBLE)" for n in LABELS]
_RESULTS = f"""results AS (SELECT position, request_id, CASE WHEN error_message IS NULL THEN 'success' ELSE 'error'
    END AS status, text, CASE WHEN error_message IS NULL THEN CASE WHEN neg >= neu AND neg >= pos THEN 'negative'
    WHEN neu >= pos THEN 'neutral' ELSE 'positive' END END AS label,
  CASE WHEN error_message IS NULL THEN greatest(neg, neu, pos) / 100 END AS score,
  CASE WHEN error_message IS NOT NULL THEN 'InferenceError' END AS error_type, error_message, submitted_at,
  '{PROCESSED}' AS processed_at,
  split_part(CASE WHEN submitted_at = '' THEN '{PROCESSED}' ELSE submitted_at END, 'T', 1) AS date
  FROM (SELECT *, {_B[0]} AS neg, {_B[1]} AS neu, {_B[2]} AS pos FROM requests))"""
_PUBLIC = "request_id, status, text, label, score, error_type, error_message, submitted_at, processed_at, date"


def hash_probabilities(validated):
    """Stands in for a model: class scores by a hash of class and text, inside the JVM."""
    scores = [
        (hash_bucket(F.sha2(F.concat(F.lit(f"{name}|"), "text"), 256)).cast("double") / 100) for name in LABELS
    ]
    pairs = [part for name, score in zip(LABELS, scores) for part in (F.lit(name), score)]
    scored = computed_once(validated, _scores=F.when(F.col("error_message").isNull(), F.create_map(*pairs)))
    prediction = F.when(F.col("_scores").isNotNull(), canonical_prediction(F.col("_scores")))
    return scored.withColumn("prediction", prediction).drop("_scores")


def flat(results):
    return results.select(
        "request_id", "status", "text", "prediction.label", "prediction.score",
        F.col("error.type").alias("error_type"), F.col("error.message").alias("error_message"), "submitted_at",
        "processed_at", F.col("date").cast("string").alias("date"),
    )


@query(
    "decode_request",
    f"""WITH {Q.STREAM} SELECT position, CASE WHEN position % 50 IN (2, 3, 4) THEN error_message END AS decode_error
    FROM requests""",
)
def decode_request(spark, sf_dir):
    return R.decode_request(I.stream_records(spark, sf_dir)).select("position", "decode_error")


@query(
    "validate_request",
    f"WITH {Q.STREAM} SELECT position, request_id, text, submitted_at, error_message FROM requests",
)
def validate_request(spark, sf_dir):
    rows = R.validate_request(R.decode_request(I.stream_records(spark, sf_dir)))
    return rows.select("position", "request_id", "text", "submitted_at", "error_message")


@query(
    "fallback_ids",
    f"WITH {Q.STREAM} SELECT position, request_id FROM requests WHERE request_id LIKE 'invalid-record-%'",
)
def fallback_ids(spark, sf_dir):
    rows = R.validate_request(R.decode_request(I.stream_records(spark, sf_dir)))
    return rows.where(F.col("request_id").startswith("invalid-record-")).select("position", "request_id")


@query("build_result", f"WITH {Q.STREAM}, {_RESULTS} SELECT {_PUBLIC} FROM results")
def build_result(spark, sf_dir):
    return flat(K.score_requests(I.stream_records(spark, sf_dir), hash_probabilities, F.lit(PROCESSED)))


_SCORED_TEXT = f"CAST({Q.bucket('sha256(text)')} AS INTEGER)"


class TouchyScorer(BucketScorer):
    """Fails on a mini-batch that holds a text it does not like."""

    def predict(self, texts):
        for text in texts:
            if text.endswith("7"):
                raise ValueError(f"cannot score: {text}")
        return super().predict(texts)


@query(
    "score_request",
    f"""WITH {Q.STREAM}, told AS (SELECT *, CASE WHEN error_message IS NOT NULL THEN error_message
      WHEN text LIKE '%7' THEN concat('cannot score: ', text) END AS message, {_SCORED_TEXT} AS b FROM requests)
    SELECT request_id, CASE WHEN message IS NULL THEN 'success' ELSE 'error' END AS status,
    CASE WHEN message IS NULL THEN CASE WHEN b < 33 THEN 'negative' WHEN b < 66 THEN 'neutral'
      ELSE 'positive' END END AS label,
    CASE WHEN message IS NULL THEN (50 + b % 50) / CAST(100 AS DOUBLE) END AS score,
    CASE WHEN message IS NOT NULL THEN 'InferenceError' END AS error_type, message AS error_message
    FROM told""",
)
def score_request(spark, sf_dir):
    """Scored by a plugged-in Python model, valid records only; texts it fails on become error rows."""
    results = K.score_requests(I.stream_records(spark, sf_dir), K.scorer_predictions(TouchyScorer))
    return flat(results).select("request_id", "status", "label", "score", "error_type", "error_message")


@query(
    "request_producer",
    """SELECT concat('req-', doc_id) AS key, concat('{"request_id":"req-', doc_id, '","text":',
    to_json(trim(text, chr(10) || chr(13) || chr(9) || ' ')), ',"submitted_at":"2024-06-01T00:00:00Z"}') AS value
    FROM documents WHERE trim(text, chr(10) || chr(13) || chr(9) || ' ') <> ''""",
)
def request_producer(spark, sf_dir):
    documents = I.table(spark, sf_dir, "documents")
    own = F.concat(F.lit("req-"), F.col("doc_id").cast("string"))
    return R.build_requests(documents, "text", own, F.lit(PROCESSED))


def _run_stream(spark, sf_dir, batches, remember=None):
    """Land each batch of records, run the job until nothing is left, keep one checkpoint throughout."""
    landed, stored, checkpoint = (scratch_path(spark, n) for n in ("requests", "results", "checkpoint"))
    records = I.stream_records(spark, sf_dir)
    for rows in batches:
        rows(records).write.mode("append").json(landed)
        job = K.stream_result_sink(
            S.stream_requests(spark, landed), hash_probabilities, stored, checkpoint, available_now=True,
            processed_at=F.lit(PROCESSED), remember=remember,
        )
        job.awaitTermination()
    return K.read_results(spark, stored)


@query("stream_result_sink", f"WITH {Q.STREAM}, {_RESULTS} SELECT {_PUBLIC} FROM results")
def stream_result_sink(spark, sf_dir):
    return flat(_run_stream(spark, sf_dir, [lambda r: r]))


@query(
    "keyed_upsert",
    f"WITH {Q.STREAM}, {_RESULTS} SELECT {_PUBLIC} FROM results",
)
def keyed_upsert(spark, sf_dir):
    """Every second request is delivered twice, in two batches; each keeps one result."""
    return flat(_run_stream(spark, sf_dir, [lambda r: r, lambda r: r.where(F.col("position") % 2 == 0)]))


@query(
    "keyed_upsert_remembered",
    f"WITH {Q.STREAM}, {_RESULTS} SELECT {_PUBLIC} FROM results",
)
def keyed_upsert_remembered(spark, sf_dir):
    """Every second request is delivered again, after a restart of the job, which knows it and does not score it."""
    batches = [lambda r: r, lambda r: r.where(F.col("position") % 2 == 0)]
    return flat(_run_stream(spark, sf_dir, batches, remember="1 day"))
