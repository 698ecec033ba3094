"""Checks, conflicts and leaks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertone.operators import medallion as M
from ledgertone.operators import quality as K
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.medallion import bronze, gold, silver_base, v1
from ledgertone.plans.catalog.registry import query
from ledgertone.session import cut_lineage, scratch_path

_DETAILS = "text_hash, text_raw, text_clean, label_normalized, split, dataset_id, dataset_label, source_platform"
_CONFLICTS = "SELECT text_hash FROM v1 GROUP BY text_hash HAVING count(DISTINCT label_normalized) > 1"
_LEAKS = "SELECT text_hash FROM v1 GROUP BY text_hash HAVING count(DISTINCT split) > 1"


def _check(layer, name, status, value, rule):
    return (
        f"SELECT '{layer}' AS layer, '{name}' AS check_name, {status} AS status, "
        f"CAST({value} AS DOUBLE) AS observed_value, '{rule}' AS expected_rule FROM m"
    )


def _positive(v):
    return f"CASE WHEN {v} > 0 THEN 'SUCCESS' ELSE 'FAILED' END"


def _zero(v):
    return f"CASE WHEN {v} = 0 THEN 'SUCCESS' ELSE 'FAILED' END"


_CLASSES = "CASE WHEN classes = 3 THEN 'SUCCESS' ELSE 'WARNING' END"


@query(
    "label_conflicts",
    f"""WITH {Q.SILVER_V1} SELECT text_hash, count(DISTINCT label_normalized) AS distinct_labels,
    string_agg(DISTINCT label_normalized, ', ' ORDER BY label_normalized) AS labels_detected, count(*) AS rows_count
    FROM v1 GROUP BY text_hash HAVING count(DISTINCT label_normalized) > 1""",
)
def label_conflicts(spark, sf_dir):
    return K.label_conflicts(v1(spark, sf_dir))


@query(
    "cross_split_duplicates",
    f"""WITH {Q.SILVER_V1} SELECT text_hash, count(DISTINCT split) AS distinct_splits,
    string_agg(DISTINCT split, ', ' ORDER BY split) AS splits_detected, count(*) AS rows_count
    FROM v1 GROUP BY text_hash HAVING count(DISTINCT split) > 1""",
)
def cross_split_duplicates(spark, sf_dir):
    return K.cross_split_duplicates(v1(spark, sf_dir))


@query(
    "label_conflict_details",
    f"WITH {Q.SILVER_V1} SELECT {_DETAILS} FROM v1 WHERE text_hash IN ({_CONFLICTS})",
)
def label_conflict_details(spark, sf_dir):
    return K.label_conflict_details(cut_lineage(v1(spark, sf_dir)))


@query(
    "cross_split_details",
    f"WITH {Q.SILVER_V1} SELECT {_DETAILS} FROM v1 WHERE text_hash IN ({_LEAKS})",
)
def cross_split_details(spark, sf_dir):
    return K.cross_split_details(cut_lineage(v1(spark, sf_dir)))


@query(
    "drop_label_conflicts",
    f"WITH {Q.SILVER_V1} SELECT * FROM v1 WHERE text_hash NOT IN ({_CONFLICTS})",
)
def drop_label_conflicts(spark, sf_dir):
    return K.drop_label_conflicts(cut_lineage(v1(spark, sf_dir)))


@query(
    "dq_silver",
    f"""WITH {Q.SILVER}, m AS (SELECT (SELECT count(*) FROM base) AS bronze_rows,
      (SELECT count(*) FROM silver) AS silver_rows, (SELECT count(DISTINCT label_normalized) FROM silver) AS classes)
    {_check('silver', 'bronze_has_rows', _positive('bronze_rows'), 'bronze_rows', '> 0')} UNION ALL
    {_check('silver', 'silver_has_rows', _positive('silver_rows'), 'silver_rows', '> 0')} UNION ALL
    {_check('silver', 'valid_label_count', _CLASSES, 'classes', '3 expected classes')} UNION ALL
    {_check('silver', 'quarantine_rows', "'SUCCESS'", 'bronze_rows - silver_rows', 'informative')}""",
)
def dq_silver(spark, sf_dir):
    return K.dq_silver(silver_base(spark, sf_dir))


@query(
    "dq_gold",
    f"""WITH {Q.GOLD}, m AS (SELECT count(*) AS total, count(*) FILTER (split = 'train') AS train_rows,
      count(*) FILTER (split = 'test') AS test_rows, count(DISTINCT label_normalized) AS classes FROM gold)
    {_check('gold', 'gold_has_rows', _positive('total'), 'total', '> 0')} UNION ALL
    {_check('gold', 'train_has_rows', _positive('train_rows'), 'train_rows', '> 0')} UNION ALL
    {_check('gold', 'test_has_rows', _positive('test_rows'), 'test_rows', '> 0')} UNION ALL
    {_check('gold', 'class_count', _CLASSES, 'classes', '3 expected classes')}""",
)
def dq_gold(spark, sf_dir):
    return K.dq_gold(gold(spark, sf_dir))


def _dq_v1(source, layer, free):
    overlap = "'SUCCESS'" if free else None
    rule = "informative" if free else "= 0"
    return f"""m AS (SELECT count(*) AS total,
      count(*) FILTER (text_clean IS NULL OR length(text_clean) = 0) AS blank,
      count(*) FILTER (NOT coalesce(label_normalized IN ('negative', 'neutral', 'positive'), false)) AS labels,
      count(*) FILTER (NOT coalesce(split IN ('train', 'validation', 'test'), false)) AS splits,
      (SELECT count(*) FROM (SELECT text_hash FROM {source} GROUP BY 1 HAVING count(DISTINCT label_normalized) > 1))
        AS conflicts,
      (SELECT count(*) FROM (SELECT text_hash FROM {source} GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS leaks
    FROM {source})
    {_check(layer, 'total_rows', _positive('total'), 'total', '> 0')} UNION ALL
    {_check(layer, 'null_texts', _zero('blank'), 'blank', '= 0')} UNION ALL
    {_check(layer, 'invalid_labels', _zero('labels'), 'labels', '= 0')} UNION ALL
    {_check(layer, 'invalid_splits', _zero('splits'), 'splits', '= 0')} UNION ALL
    {_check(layer, 'label_conflicts', overlap or _zero('conflicts'), 'conflicts', rule)} UNION ALL
    {_check(layer, 'cross_split_duplicates', overlap or _zero('leaks'), 'leaks', rule)}"""


@query(
    "dq_v1",
    f"""WITH {Q.CANONICAL}, hashed AS (SELECT sha256(text) AS text_hash, text AS text_clean, label_normalized, split
    FROM canonical), {_dq_v1('hashed', 'silver', True)}""",
)
def dq_v1(spark, sf_dir):
    rows = I.canonical_records(spark, sf_dir)
    return K.dq_v1(rows.withColumn("text_hash", F.sha2("text", 256)).withColumnRenamed("text", "text_clean"))


@query(
    "dq_v1_gold",
    f"""WITH {Q.GOLD}, hashed AS (SELECT sha256(text_clean) AS text_hash, * FROM gold),
    {_dq_v1('hashed', 'gold', False)}""",
)
def dq_v1_gold(spark, sf_dir):
    rows = gold(spark, sf_dir).withColumn("text_hash", F.sha2("text_clean", 256))
    return K.dq_v1(rows, "gold", conflicts_allowed=False)


@query(
    "file_load_audit",
    f"""WITH {Q.BRONZE} SELECT source_dataset AS source_name, 'batch-1' AS ingestion_batch_id,
    count(*) AS rows_loaded, true AS with_size, true AS with_time FROM bronze GROUP BY source_dataset""",
)
def file_load_audit(spark, sf_dir):
    """The rows are landed as files, so that the audit has sizes and times to report."""
    root = scratch_path(spark, "landed")
    rows = bronze(spark, sf_dir).drop("source_path")
    rows.repartition("source_dataset").write.partitionBy("source_dataset").parquet(root)
    schema = T.StructType([f for f in rows.schema if f.name != "source_dataset"] + [rows.schema["source_dataset"]])
    landed = spark.read.schema(schema).parquet(root).withColumn("source_path", F.col("_metadata.file_path"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    audit = K.file_load_audit(landed, "batch-1", files.select("path", "length", "modificationTime"))
    return audit.groupBy("source_name", "ingestion_batch_id").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.min(F.col("file_size") > 0).alias("with_size"),
        F.bool_and(F.col("modification_time").isNotNull()).alias("with_time"),
    )
