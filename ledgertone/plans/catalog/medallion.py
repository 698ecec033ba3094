"""Bronze, silver, gold, curated (P, J01, U)."""

from pyspark.sql import functions as F

from ledgertone.operators import dedup as D
from ledgertone.operators import medallion as M
from ledgertone.operators import quality as K
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.registry import query
from ledgertone.session import cut_lineage

GOLD_COLUMNS = (
    "source_record_hash", "text_clean", "label_normalized", "split", "feature_text_length", "source_dataset",
    "source_path",
)
_GOLD = ", ".join(GOLD_COLUMNS)


def bronze(spark, sf_dir):
    return M.dedup_by_hash(M.bronze_filter(M.bronze_stage(I.bronze_input(spark, sf_dir))))


def silver_base(spark, sf_dir):
    rows = bronze(spark, sf_dir).withColumns(
        {"ingestion_batch_id": F.lit("batch"), "ingestion_ts": F.current_timestamp()}
    )
    return M.silver_base(rows)


def silver(spark, sf_dir):
    return M.silver_valid(silver_base(spark, sf_dir))


def v1(spark, sf_dir):
    return M.silver_v1(I.canonical_records(spark, sf_dir), ("record_seq",), keep=("record_seq",))


def gold(spark, sf_dir):
    return M.gold(silver(spark, sf_dir)).select(*GOLD_COLUMNS)


@query("bronze_stage", f"WITH {Q.STAGED} SELECT * FROM staged")
def bronze_stage(spark, sf_dir):
    return M.bronze_stage(I.bronze_input(spark, sf_dir))


@query(
    "bronze_filter",
    f"""WITH {Q.STAGED} SELECT * FROM staged WHERE raw_text IS NOT NULL AND length(raw_text) > 0
    AND raw_label IS NOT NULL""",
)
def bronze_filter(spark, sf_dir):
    return M.bronze_filter(M.bronze_stage(I.bronze_input(spark, sf_dir)))


@query("dedup_by_hash", f"WITH {Q.BRONZE} SELECT * FROM bronze")
def dedup_by_hash(spark, sf_dir):
    return bronze(spark, sf_dir)


@query(
    "dedup_composite",
    f"""WITH {Q.VALID} SELECT text, label_normalized, split, min(record_seq) AS record_seq FROM valid
    GROUP BY text, label_normalized, split""",
)
def dedup_composite(spark, sf_dir):
    rows = I.canonical_records(spark, sf_dir).where(
        F.col("text").isNotNull() & F.col("label_normalized").isNotNull()
    )
    kept = D.keep_first(
        rows.select("text", "label_normalized", "split", "record_seq"), ["text", "label_normalized", "split"],
        ["record_seq"],
    )
    return kept


@query(
    "distinct_keys",
    f"WITH {Q.STAGED} SELECT DISTINCT source_record_hash FROM staged",
)
def distinct_keys(spark, sf_dir):
    return D.distinct_keys(M.bronze_stage(I.bronze_input(spark, sf_dir)), "source_record_hash")


@query(
    "new_rows_anti",
    f"""WITH {Q.BRONZE}, old AS (SELECT source_record_hash FROM bronze WHERE source_dataset IN ('src0', 'src1', 'src2'))
    SELECT * FROM bronze WHERE source_record_hash NOT IN (SELECT source_record_hash FROM old)""",
)
def new_rows_anti(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    existing = rows.where(F.col("source_dataset").isin("src0", "src1", "src2"))
    return D.new_rows(rows, existing)


@query(
    "new_rows_filtered",
    f"""WITH {Q.BRONZE}, old AS (SELECT source_record_hash FROM bronze WHERE source_dataset IN ('src0', 'src1', 'src2'))
    SELECT DISTINCT source_record_hash FROM old""",
)
def new_rows_filtered(spark, sf_dir):
    """The known keys of a batch that is not to be broadcast: a Bloom filter goes to the table's scan."""
    rows = bronze(spark, sf_dir)
    existing = rows.where(F.col("source_dataset").isin("src0", "src1", "src2"))
    return D.known_keys(rows, existing, "source_record_hash", max_rows=0)


@query(
    "technical_columns",
    f"""WITH {Q.BRONZE} SELECT source_record_hash, 'batch-1' AS ingestion_batch_id, true AS has_id, true AS has_time
    FROM bronze""",
)
def technical_columns(spark, sf_dir):
    rows = M.technical_columns(bronze(spark, sf_dir), "batch-1")
    return rows.select(
        "source_record_hash", "ingestion_batch_id", (F.length("bronze_record_id") == 36).alias("has_id"),
        F.col("ingestion_ts").isNotNull().alias("has_time"),
    )


@query(
    "silver_valid",
    f"""WITH {Q.SILVER} SELECT source_record_hash, text_clean, label_normalized, source_split_clean, source_dataset,
    source_path FROM silver""",
)
def silver_valid(spark, sf_dir):
    return silver(spark, sf_dir).drop("ingestion_batch_id", "ingestion_ts")


@query(
    "silver_quarantine",
    f"""WITH {Q.SILVER} SELECT source_record_hash, text_clean, label_normalized, source_split_clean,
    CASE WHEN length(text_clean) = 0 THEN 'empty text'
      WHEN length(text_clean) < 5 AND label_normalized IS NULL THEN 'short text and invalid label'
      WHEN length(text_clean) < 5 THEN 'short text' ELSE 'invalid label' END AS quarantine_reason
    FROM base WHERE length(text_clean) < 5 OR label_normalized IS NULL""",
)
def silver_quarantine(spark, sf_dir):
    rows = M.silver_quarantine(silver_base(spark, sf_dir))
    return rows.select(
        "source_record_hash", "text_clean", "label_normalized", "source_split_clean", "quarantine_reason"
    )


@query("silver_v1", f"WITH {Q.SILVER_V1} SELECT * FROM v1")
def silver_v1(spark, sf_dir):
    return v1(spark, sf_dir)


@query("gold_training", f"WITH {Q.GOLD} SELECT {_GOLD} FROM gold")
def gold_training(spark, sf_dir):
    return gold(spark, sf_dir)


@query("gold_with_leaks", f"WITH {Q.SPLIT_ROWS} SELECT {_GOLD} FROM split_rows")
def gold_with_leaks(spark, sf_dir):
    return M.gold(silver(spark, sf_dir), leak_free=False).select(*GOLD_COLUMNS)


@query(
    "gold_split_priority",
    f"""WITH {Q.SILVER_V1}, clean AS (SELECT * FROM v1 WHERE text_hash NOT IN
      (SELECT text_hash FROM v1 GROUP BY text_hash HAVING count(DISTINCT label_normalized) > 1))
    SELECT record_seq, text_hash, label_normalized, split, dataset_id FROM (
      SELECT *, row_number() OVER (PARTITION BY text_hash ORDER BY {Q.PRIORITY}, dataset_id, label_normalized) AS rn
      FROM clean) WHERE rn = 1""",
)
def gold_split_priority(spark, sf_dir):
    # Silver feeds both sides of the conflict join, so it is computed once.
    rows = M.gold_split_priority(K.drop_label_conflicts(cut_lineage(v1(spark, sf_dir))))
    return rows.select("record_seq", "text_hash", "label_normalized", "split", "dataset_id")


@query(
    "inference_input",
    f"WITH {Q.GOLD} SELECT source_record_hash, text_clean FROM gold WHERE split = 'test'",
)
def inference_input(spark, sf_dir):
    return M.inference_input(gold(spark, sf_dir))


@query(
    "eval_set",
    f"WITH {Q.GOLD} SELECT {_GOLD} FROM gold WHERE split IN ('validation', 'test')",
)
def eval_set(spark, sf_dir):
    return M.eval_set(gold(spark, sf_dir))


@query("curated_select", f"WITH {Q.CURATED} SELECT * EXCLUDE (record_seq) FROM curated")
def curated_select(spark, sf_dir):
    return M.curated_select(I.canonical_records(spark, sf_dir))


@query(
    "training_frame",
    f"""WITH {Q.CURATED} SELECT text, label_normalized, split, CAST(label_id AS BIGINT) AS label_id, dataset_label
    FROM curated WHERE split IN ('train', 'validation', 'test')""",
)
def training_frame(spark, sf_dir):
    rows = M.training_frame(M.curated_select(I.canonical_records(spark, sf_dir)))
    return rows.select("text", "label_normalized", "split", "label_id", "dataset_label")
