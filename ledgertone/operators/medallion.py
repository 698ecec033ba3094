"""Bronze, silver, gold, curated and training projections."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertone.functions.labels import (
    bits_to_names, domain_bit, in_domain, label_id, normalize_label, source_split, split_from_bucket,
)
from ledgertone.functions.text import (
    clean_silver, clean_v1, hash_bucket, record_hash, seeded_hash, strip_ws, text_hash,
)
from ledgertone.operators.dedup import keep_first
from ledgertone.schemas import BRONZE, CURATED, GOLD, LABELS, SILVER, SPLITS
from ledgertone.session import computed_once
from ledgertone.sources.columns import require_columns, resolve_column

HASH_COLUMNS = (
    "raw_text", "raw_label", "source_platform", "source_dataset_id", "source_dataset", "source_split",
)
STAGED_COLUMNS = (
    "source_record_hash", "raw_text", "raw_label", "source_split", "source_dataset", "source_dataset_id",
    "source_platform", "source_download_batch_id", "source_path",
)
# Column candidates of the two bronze inputs.
TEXT_CANDIDATES = ("text", "sentence", "content", "news", "headline", "Text")
CANONICAL_LABELS = ("label_normalized", "label", "sentiment", "target", "Label")
LANDING_LABELS = ("label", "label_normalized", "sentiment", "target", "Label")
SPLIT_CANDIDATES = ("split", "source_split", "Split")


def bronze_stage(df: DataFrame, landing: bool = False) -> DataFrame:
    """Either input shape to the bronze columns. Needs ``source_path``.

    Canonical input may bring its own record hash; landing files never do.
    """
    fallback = "landing_file" if landing else "canonical_parquet"
    dataset_names = ("source_dataset", "dataset", "source")
    dataset = resolve_column(df, dataset_names if landing else ("dataset_label", *dataset_names), fallback)
    if landing:
        platform, batch, given = F.lit("manual_landing"), F.lit(None).cast("string"), F.lit(None).cast("string")
    else:
        platform = F.coalesce(resolve_column(df, ["source_platform"], "unknown"), F.lit("unknown"))
        batch = resolve_column(df, ["download_batch_id", "source_download_batch_id"])
        given = resolve_column(df, ["source_record_hash"])
    staged = df.select(
        given.alias("_given"),
        F.trim(resolve_column(df, TEXT_CANDIDATES)).alias("raw_text"),
        F.trim(F.lower(resolve_column(df, LANDING_LABELS if landing else CANONICAL_LABELS))).alias("raw_label"),
        F.coalesce(resolve_column(df, SPLIT_CANDIDATES), F.lit("unknown")).alias("source_split"),
        F.coalesce(dataset, F.lit(fallback)).alias("source_dataset"),
        resolve_column(df, ["dataset_id", "source_dataset_id"]).alias("source_dataset_id"),
        platform.alias("source_platform"),
        batch.alias("source_download_batch_id"),
        F.col("source_path"),
    )
    staged = staged.withColumn("source_dataset_id", F.coalesce("source_dataset_id", "source_dataset"))
    return staged.select(
        F.coalesce("_given", record_hash(*HASH_COLUMNS)).alias("source_record_hash"), *STAGED_COLUMNS[1:]
    )


def bronze_filter(staged: DataFrame) -> DataFrame:
    require_columns(staged, STAGED_COLUMNS)
    return staged.where(
        F.col("raw_text").isNotNull() & (F.length(F.trim("raw_text")) > 0) & F.col("raw_label").isNotNull()
        & F.col("source_record_hash").isNotNull()
    )


def dedup_by_hash(df: DataFrame, order: tuple[str, ...] = ("source_path",)) -> DataFrame:
    """One row per record hash. Rows of equal hash differ at most in path and batch, which order them."""
    rest = [c for c in df.columns if c not in order and c != "source_record_hash"]
    return keep_first(df, ["source_record_hash"], [*order, *rest])


def technical_columns(df: DataFrame, batch_id: str) -> DataFrame:
    """Random id, batch and load time; added after deduplication, since uuid() draws anew per evaluation."""
    return df.withColumns(
        {
            "bronze_record_id": F.uuid(),
            "ingestion_batch_id": F.lit(batch_id),
            "ingestion_ts": F.current_timestamp(),
        }
    ).select(*BRONZE.fieldNames())


def silver_base(bronze: DataFrame) -> DataFrame:
    base = computed_once(bronze, text_clean=clean_silver(F.col("raw_text"))).withColumns(
        {
            "label_normalized": normalize_label(F.col("raw_label"), "silver", unknown="null"),
            "source_split_clean": F.lower(F.trim("source_split")),
        }
    )
    own = F.sha2(F.concat_ws("||", "text_clean", F.coalesce("label_normalized", F.lit("unknown"))), 256)
    return base.withColumn("source_record_hash", F.coalesce("source_record_hash", own))


def _silver_ok() -> Column:
    return (F.length("text_clean") >= 5) & F.col("label_normalized").isin(*LABELS)


def silver_flag(base: DataFrame) -> DataFrame:
    """Adds ``is_valid``: whether a row belongs into silver or into quarantine."""
    return base.withColumn("is_valid", F.coalesce(_silver_ok(), F.lit(False)))


def silver_valid(base: DataFrame) -> DataFrame:
    """Valid rows of bronze, whose record hashes are unique; deduplicate other input first."""
    return base.where(_silver_ok()).select(*[c for c in SILVER.fieldNames() if c in base.columns])


def silver_quarantine(base: DataFrame) -> DataFrame:
    """Exactly the rows silver_valid leaves out, with the reason."""
    text, label = F.col("text_clean"), F.col("label_normalized")
    reason = (
        F.when(text.isNull() | (F.length(text) == 0), "empty text")
        .when((F.length(text) < 5) & ~in_domain(label), "short text and invalid label")
        .when(F.length(text) < 5, "short text")
        .otherwise("invalid label")
    )
    return base.where(~F.coalesce(_silver_ok(), F.lit(False))).withColumn("quarantine_reason", reason)


def silver_v1(df: DataFrame, order: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """First-version silver: any text, label and split in domain, one row per (text, label, split)."""
    rows = df.select(
        *keep, "dataset_id", "dataset_label", "source_platform", F.lower(F.trim("split")).alias("split"),
        F.trim("text").alias("text_raw"), F.lower(F.trim("label_normalized")).alias("label_normalized"),
    )
    rows = computed_once(rows, text_clean=clean_v1(F.col("text_raw")))
    rows = rows.withColumn("text_hash", text_hash(F.col("text_clean")))
    rows = rows.where(
        (F.length("text_clean") > 0) & F.col("label_normalized").isin(*LABELS) & F.col("split").isin(*SPLITS)
    )
    return keep_first(rows, ["text_hash", "label_normalized", "split"], list(order))


def split_or_hash(split_clean: Column, key: str | Column, seed: int = 42) -> Column:
    """The source's own split where it names one, else 70/15/15 by hash."""
    bucket = hash_bucket(seeded_hash(seed, key))
    return F.coalesce(source_split(split_clean), split_from_bucket(bucket))


def split_priority(split: Column) -> Column:
    """Test first, so that a leaked text stays out of training."""
    return F.when(split == "test", 1).when(split == "validation", 2).when(split == "train", 3).otherwise(4)


def gold(silver: DataFrame, leak_free: bool = True) -> DataFrame:
    """Training table. Leak-free: texts with several labels go, the others keep one row.

    Texts are compared by hash. First each (text, label) keeps its best row, with a map-side limit, so a hot text
    ships a row per label and task; then the few rows per text that are left show conflict and survivor. The corpus
    is shuffled once.
    """
    rows = silver.withColumn("split", split_or_hash(F.col("source_split_clean"), "source_record_hash"))
    if leak_free:
        order = ["_priority", "source_dataset", "label_normalized", "source_record_hash"]
        rows = rows.withColumns(
            {"_text": F.sha2("text_clean", 256), "_priority": split_priority(F.col("split"))}
        )
        rows = keep_first(rows, ["_text", "label_normalized"], order)
        of_text = W.partitionBy("_text")
        rows = rows.withColumns(
            {"_labels": F.count("*").over(of_text), "_place": F.row_number().over(of_text.orderBy(*order))}
        ).where((F.col("_labels") == 1) & (F.col("_place") == 1))
    return rows.withColumns(
        {"feature_text_length": F.length("text_clean"), "gold_created_ts": F.current_timestamp()}
    ).select(*GOLD.fieldNames())


def text_profile(silver: DataFrame) -> DataFrame:
    """Distinct labels and splits per text, in one pass; bit sets combine map-side."""
    profile = silver.groupBy("text_hash").agg(
        F.bit_or(domain_bit(F.col("label_normalized"), LABELS)).alias("_labels"),
        F.bit_or(domain_bit(F.col("split"), SPLITS)).alias("_splits"),
        F.count("*").alias("rows_count"),
    )
    return profile.select(
        "text_hash",
        F.bit_count("_labels").cast("bigint").alias("distinct_labels"),
        bits_to_names(F.col("_labels"), LABELS).alias("labels_detected"),
        F.bit_count("_splits").cast("bigint").alias("distinct_splits"),
        bits_to_names(F.col("_splits"), SPLITS).alias("splits_detected"),
        "rows_count",
    )


def gold_split_priority(silver: DataFrame) -> DataFrame:
    """One row per text hash, test before validation before train, then dataset and label."""
    order = [split_priority(F.col("split")), "dataset_id", "label_normalized"]
    return keep_first(silver, ["text_hash"], order)


def inference_input(gold_rows: DataFrame) -> DataFrame:
    return keep_first(
        gold_rows.where(F.col("split") == "test").select("source_record_hash", "text_clean"),
        ["source_record_hash"], ["text_clean"],
    )


def eval_set(gold_rows: DataFrame) -> DataFrame:
    """Validation and test rows, or everything when there are none."""
    held_out = gold_rows.where(F.col("split").isin("validation", "test"))
    return gold_rows if held_out.isEmpty() else held_out


def curated_select(df: DataFrame) -> DataFrame:
    rows = df.withColumn("text", F.trim("text")).where(
        (F.col("text") != "") & F.col("label_normalized").isin(*LABELS)
    )
    return rows.withColumn("label_id", label_id(F.col("label_normalized"))).select(*CURATED.fieldNames())


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "text": strip_ws(F.coalesce("text", F.lit(""))),
            "label_normalized": F.coalesce("label_normalized", F.lit("missing")),
            "split": F.coalesce("split", F.lit("unspecified")),
        }
    )


def training_frame(df: DataFrame, check: bool = True) -> DataFrame:
    """Rows fit for training; fails when a split has none."""
    require_columns(df, ["text", "label_normalized", "split"])
    rows = df.withColumns(
        {
            "text": strip_ws(F.coalesce("text", F.lit(""))),
            "label_normalized": F.lower("label_normalized"),
            "split": F.lower("split"),
        }
    ).where((F.col("text") != "") & F.col("label_normalized").isin(*LABELS) & F.col("split").isin(*SPLITS))
    given = F.col("label_id") if "label_id" in df.columns else label_id(F.col("label_normalized"))
    rows = rows.withColumn("label_id", given.cast("bigint"))
    if check:
        seen = rows.agg(*[F.count_if(F.col("split") == s).alias(s) for s in SPLITS]).first()
        empty = [s for s in SPLITS if seen[s] == 0]
        if empty:
            raise ValueError(f"training data has no rows for split: {', '.join(empty)}")
    return rows
