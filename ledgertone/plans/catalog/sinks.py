"""Sinks (K): write, write again where that matters, and read back what is stored."""

from pyspark.sql import functions as F

from ledgertone.operators import reports as R
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.medallion import bronze, gold
from ledgertone.plans.catalog.registry import query, scratch_database
from ledgertone.plans.catalog.reports import features, model_features
from ledgertone.schemas import CANONICAL, CONTROL_TABLES
from ledgertone.session import scratch_path
from ledgertone.sinks import tables as W
from ledgertone.sources.specs import canonical_columns, canonical_valid


@query("append_new_rows", f"WITH {Q.BRONZE} SELECT * FROM bronze")
def append_new_rows(spark, sf_dir):
    """A first batch, then everything, then everything again: the table holds each row once."""
    name = f"{scratch_database(spark)}.bronze"
    rows = bronze(spark, sf_dir)
    W.append_new_rows(rows.where(F.col("source_dataset") < "src5"), name)
    W.append_new_rows(rows, name)
    again = W.append_new_rows(rows, name)
    if not again.isEmpty():
        raise AssertionError("a repeated batch appended rows")
    return spark.table(name)


_GOLD = "source_record_hash, text_clean, label_normalized, split, feature_text_length, source_dataset, source_path"


@query("overwrite_table", f"WITH {Q.GOLD} SELECT {_GOLD} FROM gold")
def overwrite_table(spark, sf_dir):
    name = f"{scratch_database(spark)}.gold"
    rows = gold(spark, sf_dir)
    W.overwrite_table(rows.select("source_record_hash", F.lit(1).alias("older_layout")), name)
    W.overwrite_table(rows, name)
    return spark.table(name)


@query(
    "overwrite_snapshot_partition",
    f"""WITH {Q.FEATURES} SELECT text, dataset_label, word_count, d AS snapshot_date FROM features,
    (VALUES ('2024-01-30'), ('2024-01-31')) v(d) WHERE d = '2024-01-30' OR split = 'train'""",
)
def overwrite_snapshot_partition(spark, sf_dir):
    """Rewriting one date replaces that date only."""
    base = scratch_path(spark, "snapshots")
    rows = features(spark, sf_dir).select("text", "dataset_label", "word_count", "split")
    for date in ("2024-01-30", "2024-01-31"):
        W.overwrite_snapshot_partition(rows.withColumn("snapshot_date", F.lit(date)), base)
    renewed = rows.where(F.col("split") == "train").withColumn("snapshot_date", F.lit("2024-01-31"))
    W.overwrite_snapshot_partition(renewed, base)
    stored = spark.read.schema(renewed.schema).parquet(base)
    return stored.select("text", "dataset_label", "word_count", "snapshot_date")


@query(
    "write_reports_csv",
    f"""WITH {Q.FEATURES} SELECT dataset_label, split, count(*) AS rows, '2024-01-31' AS snapshot_date FROM features
    GROUP BY dataset_label, split""",
)
def write_reports_csv(spark, sf_dir):
    report = R.split_distribution(features(spark, sf_dir))
    paths = W.write_reports_csv({"split_distribution": report}, scratch_path(spark, "features"), "2024-01-31")
    schema = report.withColumn("snapshot_date", F.lit("")).schema
    return spark.read.schema(schema).option("header", True).csv(paths["split_distribution"])


@query(
    "write_raw_snapshot",
    f"""WITH {Q.RAW} SELECT CAST(record_seq AS VARCHAR) AS record_seq, text, label AS text_2, language FROM raw_records""",
)
def write_raw_snapshot(spark, sf_dir):
    path = scratch_path(spark, "raw_snapshot")
    raw = I.raw_records(spark, sf_dir)
    delivered = raw.select(
        F.col("record_seq").alias("Record-Seq"), F.col("text").alias("Text"), F.col("label").alias("(text)"),
        F.col("language").alias("language "),
    )
    W.write_raw_snapshot(delivered, path)
    return spark.read.parquet(path)


@query(
    "write_split_previews",
    f"WITH {Q.VALID} SELECT dataset_id, dataset_label, source_platform, split, text, label_normalized FROM valid",
)
def write_split_previews(spark, sf_dir):
    path = scratch_path(spark, "split_previews")
    rows = canonical_columns(canonical_valid(I.canonical_records(spark, sf_dir)))
    W.write_split_previews(rows, path)
    stored = [f for f in CANONICAL.fields if f.name != "split"] + [CANONICAL["split"]]
    schema = type(CANONICAL)(stored)
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query(
    "evolve_and_append",
    f"""WITH {Q.PREDICTIONS} SELECT record_seq, prediction, CASE WHEN model_key <> 'm1' THEN model_key END AS model_key,
    CASE WHEN model_key <> 'm1' THEN CAST(score AS DOUBLE) END AS score FROM predictions""",
)
def evolve_and_append(spark, sf_dir):
    """A table without score and model_key gains both with the second batch."""
    name = f"{scratch_database(spark)}.predictions"
    rows = I.predictions(spark, sf_dir)
    W.evolve_and_append(rows.where(F.col("model_key") == "m1").select("record_seq", "prediction"), name)
    second = rows.where(F.col("model_key") != "m1").select("score", "model_key", "prediction", "record_seq")
    W.evolve_and_append(second, name)
    return spark.table(name)


@query(
    "write_manifest",
    f"""WITH {Q.VALID} SELECT 'batch-1' AS download_batch_id, dataset_label AS dataset_key,
    'canonical_parquet_saved' AS status, coalesce(split, 'unspecified') AS split_name, count(*) AS rows_written
    FROM valid GROUP BY dataset_label, coalesce(split, 'unspecified')""",
)
def write_manifest(spark, sf_dir):
    database = scratch_database(spark)
    W.registry_tables(spark, database)
    rows = canonical_valid(I.canonical_records(spark, sf_dir))
    counts = R.split_manifest(rows).select(
        F.lit("batch-1").alias("download_batch_id"), F.col("dataset_label").alias("dataset_key"),
        F.lit("canonical_parquet_saved").alias("status"),
        F.coalesce("split", F.lit("unspecified")).alias("split_name"), F.col("rows").alias("rows_written"),
        F.current_timestamp().alias("event_ts"),
    )
    name = f"{database}.source_dataset_manifest"
    W.write_manifest(counts, name, scratch_path(spark, "manifest"))
    return spark.table(name).select("download_batch_id", "dataset_key", "status", "split_name", "rows_written")


@query(
    "append_run_log",
    f"""WITH {Q.GOLD} SELECT 'gold_1' AS run_id, 'gold' AS step, 'SUCCESS' AS status, 'gold written' AS message,
    count(*) AS rows_written FROM gold""",
)
def append_run_log(spark, sf_dir):
    """The row count comes from the write itself, not from another count."""
    database = scratch_database(spark)
    W.registry_tables(spark, database)
    rows = W.overwrite_table(gold(spark, sf_dir), f"{database}.gold")
    W.append_run_log(spark, f"{database}.pipeline_run_log", "gold_1", "gold", "SUCCESS", "gold written", rows)
    columns = CONTROL_TABLES["pipeline_run_log"].fieldNames()[:-1]
    return spark.table(f"{database}.pipeline_run_log").select(*columns)
