"""Streaming scoring job and its result store.

Results are kept as a log of Parquet files in ``run=/batch=/date=`` folders. A run is a streaming query with its
checkpoint; its batches are numbered. A retried batch replaces its own folder, whatever dates it had, and a new
checkpoint is a new run that replaces nothing. A re-delivered request replaces its earlier result when reading, where
the record that arrived last wins.

``compact_results`` leaves one row per request and few files. It removes nothing: numbered manifests under ``_commits`` tell
which folders compacted ones replace, and readers leave those out. A manifest appears whole or not at all, and only one
writer gets its number. A reader that has listed the store before still finds its files, until ``remove_replaced`` takes
away what was replaced long enough ago.
"""

import json
import time
import uuid
from collections.abc import Callable, Sequence
from threading import Event
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgertone.operators.dedup import keep_first
from ledgertone.operators.scoring import Scorer, score_texts
from ledgertone.schemas import STREAM_RESULT
from ledgertone.session import remove_path
from ledgertone.streaming.redelivery import drop_redelivered
from ledgertone.streaming.requests import build_result, decode_request, validate_request

Score = Callable[[DataFrame], DataFrame]
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def scorer_predictions(load: Callable[[], Scorer], text: str = "text") -> Score:
    """A streaming scoring step from a batch scorer. Invalid records are not scored; a text that the scorer fails on,
    or every text if it cannot be loaded, gets a ``score_error``."""

    def score(validated: DataFrame) -> DataFrame:
        valid = validated.withColumn("_text", F.when(F.col("error_message").isNull(), F.col(text)))
        scored = score_texts(valid, load, text="_text", errors="score_error")
        prediction = F.struct(
            F.col("prediction").alias("label"), F.col("score"),
            F.lit(None).cast("map<string,double>").alias("probabilities"),
        )
        return scored.withColumn(
            "prediction", F.when(F.col("prediction").isNotNull(), prediction)
        ).drop("_text", "score")

    return score


def score_requests(records: DataFrame, score: Score, processed_at=None, remember: str | None = None) -> DataFrame:
    """Record to result, one to one; works on batch and streaming frames. A stream may ``remember`` requests for some
    time, and leaves out those that arrive again unchanged before they are scored."""
    validated = validate_request(decode_request(records))
    return build_result(score(drop_redelivered(validated, remember) if remember else validated), processed_at)


def _newest_first(*more: str) -> list:
    """The log's time, then the batch, then the place in the log, by number."""
    return [F.col(c).desc_nulls_last() for c in ("arrived_at", *more, "log_partition", "log_offset")]


def _stored(results: DataFrame) -> DataFrame:
    """Result rows with all columns of the store; a numeric position is the place in a log of one partition."""
    given = {
        "position": F.col("position").cast("string"), "arrived_at": F.lit(None).cast("timestamp"),
        "log_partition": F.lit(0), "log_offset": F.col("position").try_cast("bigint"),
    }
    missing = {c: v for c, v in given.items() if c == "position" or c not in results.columns}
    return results.withColumns(missing)


def write_results(results: DataFrame, batch_id: int, path: str, run: str = "single") -> None:
    """One micro-batch: last result per (date, request), into this batch's own folder, in files of a good size."""
    last = keep_first(_stored(results), ["date", "request_id"], _newest_first())
    columns = [f.name for f in STREAM_RESULT if f.name not in ("run", "batch")]
    last.select(*columns).hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(
        f"{path}/run={run}/batch={batch_id}"
    )


def stream_result_sink(
    records: DataFrame, score: Score, path: str, checkpoint: str, available_now: bool = False,
    interval: str = "10 seconds", processed_at=None, run: str | None = None, remember: str | None = None,
) -> StreamingQuery:
    """Starts the job. Its run is named by the id that the checkpoint gives the query, unless the caller names it. With
    ``remember``, requests that arrive again unchanged within that time are not scored again."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    named, known = {"run": run}, Event()

    def write(batch: DataFrame, number: int) -> None:
        known.wait()
        write_results(batch, number, path, named["run"])

    job = (
        score_requests(records, score, processed_at, remember).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger)
    )
    if remember:
        # Time-outs are looked at with the next records. Batches without records for them alone would follow each other
        # without end, and a job for what is available would never stop. The query keeps the setting it starts with.
        conf = records.sparkSession.conf
        before = conf.get(_EMPTY_BATCHES)
        conf.set(_EMPTY_BATCHES, "false")
        try:
            query = job.start()
        finally:
            conf.set(_EMPTY_BATCHES, before)
    else:
        query = job.start()
    named["run"] = run or str(query.id)
    known.set()
    return query


def _files(spark: SparkSession, path: str):
    """The file system of the store, its path there, and a maker of paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = make(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files, files.makeQualified(root), make


def _manifests(spark: SparkSession, path: str) -> list[dict]:
    """The store's manifests in order: folders added and replaced, by name below the store, and when."""
    files, root, make = _files(spark, path)
    listed = files.globStatus(make(root, "_commits/*.json")) or []
    if not len(listed):
        return []
    rows = spark.read.text([s.getPath().toString() for s in listed], wholetext=True)
    return sorted((json.loads(r["value"]) for r in rows.toLocalIterator()), key=lambda m: m["number"])


def _publish(spark: SparkSession, path: str, number: int, added: list[str], replaced: list[str]) -> None:
    """Writes a manifest beside its place and moves it there; a number that is taken is an error."""
    files, root, make = _files(spark, path)
    folder, target = make(root, "_commits"), make(root, f"_commits/{number:020d}.json")
    files.mkdirs(folder)
    draft = make(root, f"_commits/.{uuid.uuid4().hex}.draft")
    out = files.create(draft, False)
    out.write(json.dumps(
        {"number": number, "at": time.time(), "added": added, "replaced": replaced}).encode())
    out.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise RuntimeError(f"another compaction took place; manifest {number} is taken")


def _live_folders(spark: SparkSession, path: str, dates: Sequence[str] | None, manifests: list[dict]) -> list[str]:
    """Date folders that hold the store's present content; compacted ones count once their manifest is there."""
    files, root, make = _files(spark, path)
    replaced = {name for m in manifests for name in m["replaced"]}
    added = {name for m in manifests for name in m["added"]}
    listed = files.globStatus(make(root, "run=*/batch=*/date=*")) or []
    names = sorted(s.getPath().toString().removeprefix(root.toString() + "/") for s in listed)
    wanted = None if dates is None else {str(d) for d in dates}
    return [
        n for n in names
        if n not in replaced and (n in added or not n.startswith("run=compacted-"))
        and (wanted is None or unquote(n.rsplit("date=", 1)[1]) in wanted)
    ]


def _read_folders(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], STREAM_RESULT)
    _, root, _ = _files(spark, path)
    places = [f"{root.toString()}/{n}" for n in folders]
    return spark.read.schema(STREAM_RESULT).option("basePath", root.toString()).parquet(*places)


def _newest(stored: DataFrame) -> DataFrame:
    return keep_first(stored, ["date", "request_id"], [*_newest_first("batch"), "run"])


def read_results(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame:
    """Newest result per (date, request) as of now; given dates are read alone."""
    return _newest(_read_folders(spark, path, _live_folders(spark, path, dates, _manifests(spark, path))))


def compact_results(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> int:
    """Replaces the files of the given dates (default: all) by one row per request; returns the folders replaced.

    Run it for dates that no running query still writes. The compacted rows are complete before the manifest names them,
    and from then on readers see them alone. Of two compactions at once one fails and leaves nothing behind.
    """
    manifests = _manifests(spark, path)
    folders = _live_folders(spark, path, dates, manifests)
    if not folders:
        return 0
    kept = _newest(_read_folders(spark, path, folders))
    files, root, make = _files(spark, path)
    run = f"run=compacted-{uuid.uuid4().hex}"
    # The batch number stays with the rows' order: all that is compacted counts as the oldest batch.
    kept.drop("run", "batch").hint("rebalance", "date").write.partitionBy("date").parquet(f"{root.toString()}/{run}/batch=-1")
    added = [f"{run}/batch=-1/{s.getPath().getName()}" for s in files.globStatus(make(root, f"{run}/batch=-1/date=*"))]
    try:
        _publish(spark, path, manifests[-1]["number"] + 1 if manifests else 0, added, folders)
    except RuntimeError:
        remove_path(spark, f"{root.toString()}/{run}")
        raise
    return len(folders)


def remove_replaced(spark: SparkSession, path: str, older_than_seconds: float = 3600.0) -> int:
    """Removes folders that a manifest replaced longer ago than any reader takes; returns how many there were."""
    files, root, make = _files(spark, path)
    removed = 0
    for manifest in _manifests(spark, path):
        if time.time() - manifest["at"] >= older_than_seconds:
            for name in manifest["replaced"]:
                removed += bool(files.delete(make(root, name), True))
    return removed
