"""Data-quality checks, conflicts and leaks."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertone.functions.labels import in_domain
from ledgertone.operators.medallion import text_profile
from ledgertone.schemas import CONFLICT_COLUMNS, LABELS, SPLITS


class QualityError(RuntimeError):
    """A check that must stop the pipeline failed."""


def classes_seen(label: str = "label_normalized") -> Column:
    """Number of domain labels present, without a distinct aggregation."""
    seen = F.lit(0)
    for name in LABELS:
        seen = seen + F.coalesce(F.max((F.col(label) == name).cast("int")), F.lit(0))
    return seen


def _long_form(measured: DataFrame, layer: str, checks: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """One row per check out of one aggregated row."""
    rows = [
        F.struct(
            F.lit(layer).alias("layer"), F.lit(name).alias("check_name"), status.alias("status"),
            F.col(name).cast("double").alias("observed_value"), F.lit(rule).alias("expected_rule"),
        )
        for name, status, rule in checks
    ]
    return measured.select(F.inline(F.array(*rows)))


def _positive(name: str) -> Column:
    return F.when(F.col(name) > 0, "SUCCESS").otherwise("FAILED")


def _zero(name: str) -> Column:
    return F.when(F.col(name) == 0, "SUCCESS").otherwise("FAILED")


def _all_classes(name: str) -> Column:
    return F.when(F.col(name) == len(LABELS), "SUCCESS").otherwise("WARNING")


CLASS_RULE = f"{len(LABELS)} expected classes"


def dq_silver(base: DataFrame) -> DataFrame:
    """Bronze, silver and quarantine counts from one scan of the cleaned bronze rows (unique hashes)."""
    ok = F.coalesce((F.length("text_clean") >= 5) & F.col("label_normalized").isin(*LABELS), F.lit(False))
    valid = base.withColumn("_valid_label", F.when(ok, F.col("label_normalized"))).agg(
        F.count("*").alias("bronze_has_rows"),
        F.count_if(ok).alias("silver_has_rows"),
        classes_seen("_valid_label").alias("valid_label_count"),
        F.count_if(~ok).alias("quarantine_rows"),
    )
    return silver_checks(valid)


def silver_checks(measured: DataFrame) -> DataFrame:
    """The silver checks from one row of measurements, however they were taken."""
    return _long_form(measured, "silver", [
        ("bronze_has_rows", _positive("bronze_has_rows"), "> 0"),
        ("silver_has_rows", _positive("silver_has_rows"), "> 0"),
        ("valid_label_count", _all_classes("valid_label_count"), CLASS_RULE),
        ("quarantine_rows", F.lit("SUCCESS"), "informative"),
    ])


def dq_gold(gold: DataFrame) -> DataFrame:
    measured = gold.agg(
        F.count("*").alias("gold_has_rows"),
        F.count_if(F.col("split") == "train").alias("train_has_rows"),
        F.count_if(F.col("split") == "test").alias("test_has_rows"),
        classes_seen().alias("class_count"),
    )
    return _long_form(measured, "gold", [
        ("gold_has_rows", _positive("gold_has_rows"), "> 0"),
        ("train_has_rows", _positive("train_has_rows"), "> 0"),
        ("test_has_rows", _positive("test_has_rows"), "> 0"),
        ("class_count", _all_classes("class_count"), CLASS_RULE),
    ])


def dq_v1(rows: DataFrame, layer: str = "silver", conflicts_allowed: bool = True) -> DataFrame:
    """Totals, null texts, bad labels and splits, conflicting and leaking texts, in one pass.

    Everything is first summed per text, where each text's conflict and leak are known, then over all
    texts. After gold, conflicts and leaks must be zero.
    """
    per_text = rows.groupBy("text_hash").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("text_clean").isNull() | (F.length("text_clean") == 0)).alias("blank"),
        F.count_if(~in_domain(F.col("label_normalized"))).alias("bad_label"),
        F.count_if(~in_domain(F.col("split"), SPLITS)).alias("bad_split"),
        (F.min("label_normalized") != F.max("label_normalized")).alias("conflict"),
        (F.min("split") != F.max("split")).alias("leak"),
    )
    measured = per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("blank"), F.lit(0)).alias("null_texts"),
        F.coalesce(F.sum("bad_label"), F.lit(0)).alias("invalid_labels"),
        F.coalesce(F.sum("bad_split"), F.lit(0)).alias("invalid_splits"),
        F.count_if("conflict").alias("label_conflicts"),
        F.count_if("leak").alias("cross_split_duplicates"),
    )
    overlap = (lambda name: F.lit("SUCCESS")) if conflicts_allowed else _zero
    rule = "informative" if conflicts_allowed else "= 0"
    return _long_form(measured, layer, [
        ("total_rows", _positive("total_rows"), "> 0"),
        ("null_texts", _zero("null_texts"), "= 0"),
        ("invalid_labels", _zero("invalid_labels"), "= 0"),
        ("invalid_splits", _zero("invalid_splits"), "= 0"),
        ("label_conflicts", overlap("label_conflicts"), rule),
        ("cross_split_duplicates", overlap("cross_split_duplicates"), rule),
    ])


def enforce(checks: DataFrame) -> list:
    """Stop on any failed check. The frame holds a handful of rows."""
    rows = checks.collect()
    failed = [f"{r['layer']}.{r['check_name']}={r['observed_value']}" for r in rows if r["status"] == "FAILED"]
    if failed:
        raise QualityError("quality checks failed: " + ", ".join(failed))
    return rows


def label_conflicts(silver: DataFrame) -> DataFrame:
    profile = text_profile(silver).where(F.col("distinct_labels") > 1)
    return profile.select("text_hash", "distinct_labels", "labels_detected", "rows_count")


def cross_split_duplicates(silver: DataFrame) -> DataFrame:
    profile = text_profile(silver).where(F.col("distinct_splits") > 1)
    return profile.select("text_hash", "distinct_splits", "splits_detected", "rows_count")


# V1 silver holds at most one row per (text, label, split): nine per text, so these joins cannot skew.
def label_conflict_details(silver: DataFrame) -> DataFrame:
    return silver.join(label_conflicts(silver), "text_hash", "left_semi").select(*CONFLICT_COLUMNS)


def cross_split_details(silver: DataFrame) -> DataFrame:
    return silver.join(cross_split_duplicates(silver), "text_hash", "left_semi").select(*CONFLICT_COLUMNS)


def drop_label_conflicts(silver: DataFrame) -> DataFrame:
    return silver.join(label_conflicts(silver), "text_hash", "left_anti")


def file_load_audit(rows: DataFrame, batch_id: str, files: DataFrame | None = None) -> DataFrame:
    """Rows loaded per source file; ``files`` (path, length, modificationTime) adds size and time."""
    audit = rows.groupBy("source_path", F.col("source_dataset").alias("source_name")).agg(
        F.count("*").alias("rows_loaded")
    )
    if files is None:
        audit = audit.withColumns(
            {"file_size": F.lit(None).cast("bigint"), "modification_time": F.lit(None).cast("timestamp")}
        )
    else:
        facts = files.select(
            F.col("path").alias("source_path"), F.col("length").alias("file_size"),
            F.col("modificationTime").alias("modification_time"),
        )
        audit = audit.join(facts, "source_path", "left")
    return audit.withColumns({"ingestion_batch_id": F.lit(batch_id), "ingestion_ts": F.current_timestamp()})
