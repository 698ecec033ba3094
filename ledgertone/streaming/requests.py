"""Request decoding, validation and results. The same functions serve batch and streaming frames."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertone.functions.text import strip_ws
from ledgertone.session import computed_once

ERROR_TYPE = "InferenceError"
# Where a record lies in its log: for people, and what orders records.
LOG_COLUMNS = ("position", "arrived_at", "log_partition", "log_offset")
MISSING_DATA = "Record is missing data."
INVALID_JSON = "Record data is not valid JSON."
NOT_AN_OBJECT = "Record JSON must be an object."
# Messages of the validation step.
NO_REQUEST_ID = "request_id is required."
NO_TEXT = "text is required."


def _field(payload: Column, name: str) -> Column:
    """A field as stripped text; numbers in their text form, null and absent as empty."""
    return strip_ws(F.coalesce(F.try_variant_get(payload, f"$.{name}", "string"), F.lit("")))


def decode_request(records: DataFrame, data: str = "data") -> DataFrame:
    """Base64 to JSON object. Adds ``payload`` (variant) and ``decode_error``; never raises.

    JSON text is parsed inside a list and inside an object: a parser that stops after the first value
    accepts trailing text in one of them at most.
    """
    body = F.try_to_binary(F.col(data), F.lit("base64"))
    json = F.try_validate_utf8(body.cast("string"))
    rows = computed_once(
        records,
        _list=F.try_parse_json(F.concat(F.lit("["), json, F.lit("]"))),
        _object=F.try_parse_json(F.concat(F.lit('{"v":'), json, F.lit("}"))),
    )
    value = F.try_variant_get("_object", "$.v", "variant")
    kind = F.schema_of_variant(value)
    is_json = F.col("_list").isNotNull() & kind.isNotNull()
    error = (
        F.when(F.coalesce(F.col(data), F.lit("")) == "", F.lit(MISSING_DATA))
        .when(~is_json, F.lit(INVALID_JSON))
        .when(~kind.startswith("OBJECT"), F.lit(NOT_AN_OBJECT))
    )
    rows = rows.withColumn("decode_error", error)
    return rows.withColumn("payload", F.when(F.col("decode_error").isNull(), value)).drop("_list", "_object")


def validate_request(decoded: DataFrame, position: str = "position") -> DataFrame:
    """Adds request_id, text, submitted_at and ``error_message``; the id is checked before the text.

    A record without an id gets one from its place in the log, which a retry does not change.
    """
    rows = computed_once(
        decoded,
        _id=_field(F.col("payload"), "request_id"),
        text=_field(F.col("payload"), "text"),
        submitted_at=_field(F.col("payload"), "submitted_at"),
    )
    error = (
        F.when(F.col("decode_error").isNotNull(), F.col("decode_error"))
        .when(F.col("_id") == "", F.lit(NO_REQUEST_ID))
        .when(F.col("text") == "", F.lit(NO_TEXT))
    )
    return rows.withColumns({"error_message": error, "request_id": fallback_id("_id", position)}).drop(
        "_id", "payload", "decode_error"
    )


def fallback_id(request_id: str, position: str = "position") -> Column:
    given = F.coalesce(F.col(request_id), F.lit(""))
    return F.when(given != "", given).otherwise(F.concat(F.lit("invalid-record-"), F.col(position).cast("string")))


def result_date(submitted_at: Column, otherwise: Column) -> Column:
    """Date part of the submission time, else of another time, which should not change when a batch is retried."""
    return F.substring_index(F.coalesce(F.nullif(submitted_at, F.lit("")), otherwise), "T", 1)


def utc_text(moment: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def build_result(validated: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Exactly one result row per record: a prediction, or an error with its type and message.

    Expects ``prediction`` (struct label, score, probabilities) and optionally ``score_error``. The date of a record
    without submission time is that of its arrival in the log (``arrived_at``), if the source tells.
    """
    columns = [c for c in LOG_COLUMNS if c in validated.columns]
    validated = computed_once(validated, prediction=F.col("prediction"))
    failed = F.col("error_message")
    if "score_error" in validated.columns:
        failed = F.coalesce(failed, F.col("score_error"))
    missing = F.when(F.col("prediction").isNull(), F.lit("response is missing predictions."))
    failed = F.coalesce(failed, missing)
    stamped = utc_text(F.current_timestamp()) if processed_at is None else processed_at
    rows = validated.withColumns({"_failed": failed, "processed_at": stamped})
    arrival = utc_text(F.col("arrived_at")) if "arrived_at" in columns else F.lit(None).cast("string")
    ok = F.col("_failed").isNull()
    return rows.select(
        *columns,
        "request_id",
        F.when(ok, "success").otherwise("error").alias("status"),
        "text",
        F.when(ok, F.col("prediction")).alias("prediction"),
        F.when(~ok, F.struct(F.lit(ERROR_TYPE).alias("type"), F.col("_failed").alias("message"))).alias("error"),
        "submitted_at",
        "processed_at",
        result_date(F.col("submitted_at"), F.coalesce(arrival, "processed_at")).alias("date"),
    )


def build_requests(
    texts: DataFrame, text: str = "text", request_id: Column | None = None, submitted_at: Column | None = None
) -> DataFrame:
    """Texts to request records keyed by request id; blank texts are refused."""
    trimmed = strip_ws(F.col(text))
    own = F.uuid() if request_id is None else F.coalesce(F.nullif(request_id, F.lit("")), F.uuid())
    rows = texts.where(F.length(trimmed) > 0).select(
        own.alias("request_id"), trimmed.alias("text"),
        (utc_text(F.current_timestamp()) if submitted_at is None else submitted_at).alias("submitted_at"),
    )
    value = F.to_json(F.struct("request_id", "text", "submitted_at"))
    return rows.select(F.col("request_id").alias("key"), value.alias("value"))
