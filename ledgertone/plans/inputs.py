"""Pipeline inputs derived from the driver tables; their size follows the tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertone.functions.labels import normalize_label, source_split, split_from_bucket
from ledgertone.functions.text import hash_bucket, record_hash, seeded_hash, with_clean_text
from ledgertone.schemas import LABELS
from ledgertone.sources.specs import source_spec, standardize

# (model, seed, share kept): predictions agree with the label in that share of the rows.
MODELS = (("m1", 42, 80), ("m2", 43, 70), ("m3", 44, 60))
# (training batch, model, seed, share kept, finished at); the last one never produced predictions.
CANDIDATES = (
    ("b1", "m1", 50, 95, "2024-01-01 00:00:00"),
    ("b2", "m1", 42, 80, "2024-01-02 00:00:00"),
    ("b2", "m2", 43, 70, "2024-01-02 00:00:01"),
    ("b2", "m3", 44, 60, "2024-01-02 00:00:02"),
    ("b2", "m4", 45, 90, "2024-01-02 00:00:03"),
    ("b2", "m5", 46, None, "2024-01-02 00:00:04"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as it lies. A session may name a number of partitions to spread its inputs over, for
    tables of one row group, which no scan setting can split."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    spread = spark.conf.get("spark.ledgertone.inputPartitions", None)
    return df.repartition(int(spread)) if spread else df


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled records with many label spellings, blank and null texts, and copies."""
    documents = table(spark, sf_dir, "documents")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    number = F.col("doc_id")

    def pick(a: str, b: str, c: str) -> Column:
        return F.when(number % 3 == 0, a).when(number % 3 == 1, b).otherwise(c)

    label = (
        # Documents without a label: copies of a text get labels that disagree.
        F.when(
            F.col("toxic").isNull(),
            F.when(number % 5 == 0, "mixed").when(number % 5 == 1, "Negative").when(number % 5 == 2, "POS"),
        )
        .when(F.col("toxic") == 1, pick("Negative", " bearish ", "-1"))
        .when(F.col("quality") == 1, pick("positive", "Bullish", "mildly positive"))
        .otherwise(pick("Neutral", "NEU", "0"))
    )
    split = (
        F.when(number % 10 == 7, "Validation").when(number % 10 == 8, " test ")
        .when(number % 10 == 9, None).otherwise("train")
    )
    return documents.join(labels, "doc_id", "left").select(
        number.alias("record_seq"),
        F.concat(F.lit("org/"), "source").alias("dataset_id"),
        F.col("source").alias("dataset_label"),
        F.when(number % 4 == 3, "kaggle").otherwise("huggingface").alias("source_platform"),
        F.col("lang").alias("language"),
        split.alias("split"),
        F.when(number % 97 == 0, "  ").when(number % 89 != 0, F.col("text")).alias("text"),
        label.alias("label"),
    )


def canonical_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records on the canonical contract, with their key, raw label and record hash."""
    raw = raw_records(spark, sf_dir)
    rows = raw.select(
        "record_seq", "dataset_id", "dataset_label", "source_platform",
        source_split(F.lower(F.trim("split"))).alias("split"),
        "text",
        F.col("label").alias("label_raw"),
        normalize_label(F.col("label"), "signed").alias("label_normalized"),
    )
    return with_clean_text(rows, "letters").withColumn(
        "source_record_hash", record_hash("dataset_label", "split", "text", "label_normalized")
    )


def bronze_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records as a canonical scan delivers them to bronze."""
    return raw_records(spark, sf_dir).withColumn(
        "source_path", F.concat(F.lit("canonical/"), F.col("dataset_label"))
    )


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base64 request records: missing ids, blank texts, broken JSON, non-objects, empty data, valid ones.

    ``arrived_at`` is when the log took the record.
    """
    events = table(spark, sf_dir, "events")
    kind = F.col("event_id") % 50
    request = F.concat(F.lit('{"request_id":"req-'), F.col("event_id").cast("string"), F.lit('","text":"'))
    payload = (
        F.when(kind == 0, F.concat(F.lit('{"text":"'), F.col("event_type"), F.lit('"}')))
        .when(kind == 1, F.concat(request, F.lit('  "}')))
        .when(kind == 2, F.lit("{not json"))
        .when(kind == 3, F.lit("[1,2]"))
        .when(kind == 4, F.lit(""))
        .otherwise(
            F.concat(
                request, F.col("event_type"), F.lit(" by user "), F.col("user_id").cast("string"),
                F.lit('","submitted_at":"'), F.col("ts").cast("date").cast("string"), F.lit('T00:00:00Z"}'),
            )
        )
    )
    return events.select(
        F.col("event_id").alias("position"), F.base64(payload.cast("binary")).alias("data"),
        F.to_timestamp(F.lit("2024-06-01 00:00:00")).alias("arrived_at"),
    )


def labelled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records with a known label."""
    rows = raw_records(spark, sf_dir)
    value = F.lower(F.trim("label"))
    known = F.when(value == "mildly positive", "positive").otherwise(
        normalize_label(F.col("label"), "silver", unknown="null")
    )
    return rows.select("record_seq", "text", known.alias("label_normalized")).where(
        F.col("label_normalized").isin(*LABELS)
    )


def _predicted(bucket: Column, kept: Column) -> Column:
    label = F.col("label_normalized")
    other = F.when(label == "negative", "neutral").when(label == "neutral", "positive").otherwise("negative")
    return F.when(bucket < kept, label).otherwise(other)


def _with_predictions(rows: DataFrame, runs: Sequence[Column]) -> DataFrame:
    scored = rows.withColumn("_run", F.explode(F.array(*runs)))
    bucket = hash_bucket(F.sha2(F.concat_ws("|", F.col("_run.seed").cast("string"), "record_seq"), 256))
    scored = scored.withColumn("_bucket", bucket)
    return scored.withColumns(
        {
            "prediction": _predicted(F.col("_bucket"), F.col("_run.kept")),
            "score": (F.lit(50) + F.col("_bucket") % 50) / 100.0,
        }
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled records times three models."""
    runs = [
        F.struct(F.lit(m).alias("model"), F.lit(s).alias("seed"), F.lit(k).alias("kept")) for m, s, k in MODELS
    ]
    rows = _with_predictions(labelled_records(spark, sf_dir), runs)
    return rows.select(
        F.col("_run.model").alias("model_key"), "record_seq", "text", "label_normalized", "prediction", "score"
    )


def candidate_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled records times every candidate that produced predictions."""
    runs = [
        F.struct(
            F.lit(b).alias("batch"), F.lit(m).alias("model"), F.lit(s).alias("seed"), F.lit(k).alias("kept")
        )
        for b, m, s, k, _ in CANDIDATES if k is not None
    ]
    rows = _with_predictions(labelled_records(spark, sf_dir).drop("text"), runs)
    return rows.select(
        F.col("_run.batch").alias("training_batch_id"), F.col("_run.model").alias("model_key"), "record_seq",
        "label_normalized", "prediction",
    )


def candidates(spark: SparkSession) -> DataFrame:
    rows = [
        (b, m, "transformer", f"run-{b}-{m}", f"sentiment_{m}", str(i + 1), at)
        for i, (b, m, _, _, at) in enumerate(CANDIDATES)
    ]
    frame = spark.createDataFrame(
        rows,
        "training_batch_id string, model_key string, model_family string, run_id string, "
        "registered_model_name string, model_version string, event_ts string",
    )
    return frame.withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class probabilities per labelled record: ties occur, and every seventh record lacks a class."""
    rows = labelled_records(spark, sf_dir).drop("text")
    parts = [(hash_bucket(seeded_hash(seed, "record_seq")) % 10).cast("double") / 10.0 for seed in (42, 43, 44)]
    full = F.create_map(
        F.lit("positive"), parts[0], F.lit("negative"), parts[1], F.lit("neutral"), parts[2]
    )
    short = F.create_map(F.lit("negative"), parts[1], F.lit("neutral"), parts[2])
    return rows.withColumn("probabilities", F.when(F.col("record_seq") % 7 == 0, short).otherwise(full))


def training_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training log events: fractional epochs, one metric per event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_id") % 4
    metric = {"loss": 0, "eval_loss": 1, "eval_accuracy": 2, "eval_macro_f1": 3}
    return events.select(
        F.concat(F.lit("run-"), (F.col("user_id") % 5).cast("string")).alias("run_id"),
        F.when(F.col("user_id") % 2 == 0, "warmup").otherwise("finetune").alias("phase"),
        ((F.col("user_id") % 20) + (F.col("event_id") % 3) * F.lit(0.00004).cast("double")).alias("epoch"),
        F.col("event_id").alias("seq"),
        *[F.when(kind == number, F.col("value")).alias(name) for name, number in metric.items()],
    )


def source_shapes(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, object]]:
    """The raw records as four differently shaped sources."""
    raw = raw_records(spark, sf_dir)
    part = F.col("record_seq") % 4
    split = F.coalesce(source_split(F.lower(F.trim("split"))), F.lit("train")).alias("given_split")
    shapes = [
        ("instruction", "huggingface", [F.col("text").alias("input"), F.col("label").alias("output")]),
        ("multilingual", "huggingface", [F.col("text").alias("sentence"), F.col("label"), F.col("language")]),
        ("polarity", "huggingface", [F.col("text"), F.col("label").alias("polarity")]),
        ("capitalised", "kaggle", [F.col("text").alias("Sentence"), F.col("label").alias("Sentiment")]),
    ]
    return [
        (
            raw.where(part == number).select("record_seq", split, *columns),
            source_spec(shape, f"{shape}_set", f"org/{shape}", platform),
        )
        for number, (shape, platform, columns) in enumerate(shapes)
    ]


def standardized_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [
        standardize(frame, spec, F.col("given_split"), keep=("record_seq",))
        for frame, spec in source_shapes(spark, sf_dir)
    ]


def bucket_split(key: str, seed: int = 42) -> Column:
    return split_from_bucket(hash_bucket(seeded_hash(seed, key)))
