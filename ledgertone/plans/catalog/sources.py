"""Sources (S): the input is written once in the source's format, then read the way the source is read."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertone.functions.text import safe_key
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.registry import query
from ledgertone.plans.catalog.reports import model_features
from ledgertone.plans.catalog.scalars import SOURCES_SQL
from ledgertone.session import scratch_path
from ledgertone.sinks import tables as W
from ledgertone.sources import readers as S
from ledgertone.streaming import log_source as L

CSV_EXACT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@query(
    "scan_canonical",
    f"""WITH {Q.VALID} SELECT record_seq, dataset_label, text, label_normalized,
    lower(regexp_replace(dataset_label, '[^a-zA-Z0-9_]+', '_', 'g')) AS source_key FROM valid""",
)
def scan_canonical(spark, sf_dir):
    from ledgertone.sources.specs import canonical_valid

    root = scratch_path(spark, "canonical")
    rows = canonical_valid(I.canonical_records(spark, sf_dir))
    rows.withColumn("dataset", safe_key(F.col("dataset_label"))).write.partitionBy("dataset").parquet(root)
    scan = S.scan_canonical(spark, root)
    return scan.select(
        "record_seq", "dataset_label", "text", "label_normalized",
        F.regexp_extract("source_path", "/dataset=([^/]+)/", 1).alias("source_key"),
    )


@query("scan_glob", f"WITH {SOURCES_SQL} SELECT * FROM sources")
def scan_glob(spark, sf_dir):
    root = scratch_path(spark, "raw")
    for number, frame in enumerate(I.standardized_sources(spark, sf_dir)):
        frame.write.parquet(f"{root}/source_{number}/canonical")
    return S.scan_glob(spark, root)


@query(
    "scan_landing_csv",
    f"""WITH {Q.RAW} SELECT CAST(record_seq AS VARCHAR) AS record_seq, text, label, dataset_label AS source_dataset,
    true AS has_path FROM raw_records""",
)
def scan_landing_csv(spark, sf_dir):
    path = scratch_path(spark, "landing")
    raw = I.raw_records(spark, sf_dir)
    raw.select("record_seq", "text", "label", F.col("dataset_label").alias("source_dataset")).write.options(
        **CSV_EXACT
    ).csv(path)
    scan = S.scan_landing_csv(spark, path)
    return scan.withColumn("has_path", F.col("source_path").endswith(".csv")).drop("source_path")


@query(
    "scan_csv_ranges",
    f"""WITH {Q.RAW} SELECT CAST(record_seq AS VARCHAR) AS record_seq, text || chr(10) || 'said "' || label || '"' AS text,
    label, true AS has_path FROM raw_records""",
)
def scan_csv_ranges(spark, sf_dir):
    """Every text holds a quoted line break and quotes; files are read by ranges whatever their size."""
    path = scratch_path(spark, "landing")
    raw = I.raw_records(spark, sf_dir)
    text = F.concat("text", F.lit('\nsaid "'), "label", F.lit('"'))
    raw.select("record_seq", text.alias("text"), "label").write.options(**CSV_EXACT).csv(path)
    files = S.list_files(spark, path, [".csv"])
    names = T.StructType([T.StructField(n, T.StringType()) for n in ("record_seq", "text", "label")])
    scan = S.scan_csv_ranges(spark, files, names)
    return scan.withColumn("has_path", F.col("source_path").endswith(".csv")).drop("source_path")


@query(
    "union_csv_files",
    f"""WITH {Q.RAW} SELECT CAST(record_seq AS VARCHAR) AS record_seq,
    CASE record_seq % 4 WHEN 0 THEN text END AS input, CASE record_seq % 4 WHEN 0 THEN label END AS output,
    CASE WHEN record_seq % 4 IN (1, 3) THEN text END AS sentence, CASE record_seq % 4 WHEN 1 THEN label END AS label,
    CASE record_seq % 4 WHEN 1 THEN language END AS language, CASE record_seq % 4 WHEN 2 THEN text END AS text,
    CASE record_seq % 4 WHEN 2 THEN label END AS polarity, CASE record_seq % 4 WHEN 3 THEN label END AS sentiment
    FROM raw_records""",
)
def union_csv_files(spark, sf_dir):
    """Four shapes of files under one folder; column names that differ in case only are one column."""
    root = scratch_path(spark, "csv")
    sources = I.source_shapes(spark, sf_dir)
    for number, (frame, _) in enumerate(sources):
        frame.drop("given_split").write.options(**CSV_EXACT).csv(f"{root}/shape_{number}")
    # A file without text and label columns is left out.
    sources[0][0].select("record_seq", "given_split").write.options(**CSV_EXACT).csv(f"{root}/other")
    combined = S.union_csv_files(
        spark, S.list_files(spark, root, [".csv"]), (*S.CSV_TEXT_COLUMNS, "input"), (*S.CSV_LABEL_COLUMNS, "output")
    )
    return combined.select(
        "record_seq", "input", "output", F.col("sentence").alias("sentence"), "label", "language", "text", "polarity",
        F.col("sentiment").alias("sentiment"),
    )


@query(
    "scan_snapshot",
    f"""WITH {Q.FEATURES} SELECT dataset_id, dataset_label, source_platform, split, text, label_normalized, label_id,
    char_count, word_count, duplicate_within_dataset, duplicate_global, '2024-01-31' AS snapshot_date FROM features""",
)
def scan_snapshot(spark, sf_dir):
    base = scratch_path(spark, "model_features")
    rows = model_features(spark, sf_dir).drop("record_seq")
    W.overwrite_snapshot_partition(rows, base)
    older = spark.read.schema(rows.schema).parquet(base).withColumn("snapshot_date", F.lit("2024-01-30"))
    W.overwrite_snapshot_partition(older, base)
    return S.scan_snapshot(spark, base, "2024-01-31")


@query(
    "stream_requests",
    f"WITH {Q.STREAM} SELECT position, payload FROM stream_records",
)
def stream_requests(spark, sf_dir):
    landed = scratch_path(spark, "requests")
    target = scratch_path(spark, "received")
    I.stream_records(spark, sf_dir).write.json(landed)
    received = S.stream_requests(spark, landed).select(
        "position", F.unbase64("data").cast("string").alias("payload")
    )
    job = received.writeStream.format("parquet").option("path", target).option(
        "checkpointLocation", scratch_path(spark, "checkpoint")
    ).trigger(availableNow=True).start()
    job.awaitTermination()
    return spark.read.schema(received.schema).parquet(target)


@query(
    "stream_requests_log",
    f"""WITH {Q.STREAM} SELECT position % 2 AS log_partition,
    row_number() OVER (PARTITION BY position % 2 ORDER BY position) - 1 AS log_offset, payload FROM stream_records""",
)
def stream_requests_log(spark, sf_dir):
    """A log of two partitions, read from its first record."""
    log, target = scratch_path(spark, "log"), scratch_path(spark, "received")
    records = I.stream_records(spark, sf_dir).withColumn("log_partition", (F.col("position") % 2).cast("int"))
    L.append_to_log(records, log, ["position"])
    received = L.stream_requests_log(spark, log, "earliest").select(
        "log_partition", "log_offset", F.unbase64("data").cast("string").alias("payload")
    )
    job = received.writeStream.format("parquet").option("path", target).option(
        "checkpointLocation", scratch_path(spark, "checkpoint")
    ).trigger(availableNow=True).start()
    job.awaitTermination()
    return spark.read.schema(received.schema).parquet(target)
