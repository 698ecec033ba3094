"""Table contracts and value domains."""

from pyspark.sql import types as T

# Label and split domains, in canonical order.
LABELS = ("negative", "neutral", "positive")
LABEL_IDS = {"negative": 0, "neutral": 1, "positive": 2}
SPLITS = ("train", "validation", "test")
PROMOTION_ALIASES = ("Champion", "Challenger_1", "Challenger_2")


TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
    "map<string,double>": T.MapType(T.StringType(), T.DoubleType()),
}


def _table(columns: str) -> T.StructType:
    """Schema from "name type" pairs; unlike the DDL parser this needs no running session."""
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


CANONICAL = _table(
    "dataset_id string, dataset_label string, source_platform string, split string, text string, "
    "label_normalized string"
)
CANONICAL_BATCH = _table(
    "dataset_id string, dataset_label string, source_platform string, split string, text string, "
    "label_normalized string, download_batch_id string, source_record_hash string"
)
BRONZE = _table(
    "bronze_record_id string, source_record_hash string, raw_text string, raw_label string, source_split string, "
    "source_dataset string, source_dataset_id string, source_platform string, source_download_batch_id string, "
    "source_path string, ingestion_batch_id string, ingestion_ts timestamp"
)
SILVER = _table(
    "source_record_hash string, text_clean string, label_normalized string, source_split_clean string, "
    "source_dataset string, source_path string, ingestion_batch_id string, ingestion_ts timestamp"
)
GOLD = _table(
    "source_record_hash string, text_clean string, label_normalized string, split string, feature_text_length int, "
    "source_dataset string, source_path string, gold_created_ts timestamp"
)
CURATED = _table(
    "dataset_id string, dataset_label string, source_platform string, split string, text string, "
    "label_normalized string, label_id int"
)
# snapshot_date stays a string: partition inference would turn it into a date.
MODEL_FEATURES = _table(
    "dataset_id string, dataset_label string, source_platform string, split string, text string, "
    "label_normalized string, label_id int, char_count int, word_count int, duplicate_within_dataset boolean, "
    "duplicate_global boolean, snapshot_date string"
)
CONFLICT_COLUMNS = (
    "text_hash", "text_raw", "text_clean", "label_normalized", "split", "dataset_id", "dataset_label",
    "source_platform",
)

CONTROL_TABLES = {
    "pipeline_run_log": _table(
        "run_id string, step string, status string, message string, rows_written bigint, event_ts timestamp"
    ),
    "source_dataset_manifest": _table(
        "download_batch_id string, dataset_key string, dataset_id string, source_platform string, status string, "
        "split_name string, rows_written bigint, label_counts string, raw_parquet_path string, "
        "canonical_parquet_path string, error_message string, event_ts timestamp"
    ),
    "ingestion_file_audit": _table(
        "source_path string, source_name string, file_size bigint, modification_time timestamp, "
        "ingestion_batch_id string, rows_loaded bigint, ingestion_ts timestamp"
    ),
    "data_quality_results": _table(
        "layer string, check_name string, status string, observed_value double, expected_rule string, "
        "run_id string, event_ts timestamp"
    ),
    "model_candidate_metrics": _table(
        "training_batch_id string, model_key string, model_family string, hf_model_name string, "
        "training_mode string, run_id string, registered_model_name string, model_version string, accuracy double, "
        "macro_f1 double, weighted_f1 double, precision_macro double, recall_macro double, train_rows bigint, "
        "eval_rows bigint, status string, error_message string, event_ts timestamp"
    ),
    "model_promotion_audit": _table(
        "promotion_batch_id string, alias string, model_key string, model_family string, hf_model_name string, "
        "registered_model_name string, model_version string, macro_f1 double, accuracy double, "
        "promoted_ts timestamp"
    ),
    "batch_predictions": _table(
        "prediction_batch_id string, source_record_hash string, text_clean string, prediction string, "
        "score double, model_alias string, registered_model_name string, model_version string, "
        "prediction_ts timestamp"
    ),
}

# Control tables in the order the evidence report shows them, with the column that dates a row.
EVIDENCE_ORDER = {
    "source_dataset_manifest": "event_ts",
    "pipeline_run_log": "event_ts",
    "data_quality_results": "event_ts",
    "model_candidate_metrics": "event_ts",
    "model_promotion_audit": "promoted_ts",
    "batch_predictions": "prediction_ts",
}

STREAM_REQUEST = _table("position bigint, data string, arrived_at timestamp")
PREDICTION = _table("label string, score double, probabilities map<string,double>")
STREAM_ERROR = _table("type string, message string")
STREAM_RESULT = T.StructType([
    *_table(
        "position string, arrived_at timestamp, log_partition int, log_offset bigint, request_id string, "
        "status string, text string"
    ).fields,
    T.StructField("prediction", PREDICTION),
    T.StructField("error", STREAM_ERROR),
    *_table("submitted_at string, processed_at string, run string, batch bigint, date string").fields,
])
