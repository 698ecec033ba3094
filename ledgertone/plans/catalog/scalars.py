"""Scalar functions (F) and predicates (P)."""

from pyspark.sql import functions as F

from ledgertone.functions import labels as L
from ledgertone.functions import text as X
from ledgertone.operators import medallion as M
from ledgertone.operators import reports as R
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.registry import query
from ledgertone.schemas import LABELS
from ledgertone.sources import columns as C
from ledgertone.sources import specs as S

# The entities of the pages; each also counts without its semicolon.
_ENTITY_SQL = "html"
for _name, _character in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    _ENTITY_SQL = f"regexp_replace({_ENTITY_SQL}, '&{_name};?', '{_character}', 'g')"


@query("clean_ascii_letters", f"SELECT doc_id, {Q.letters('text')} AS cleaned FROM documents")
def clean_ascii_letters(spark, sf_dir):
    documents = I.table(spark, sf_dir, "documents")
    return X.with_clean_text(documents.select("doc_id", "text"), "letters", target="cleaned").drop("text")


@query(
    "clean_ascii_letters_html", f"SELECT page_id, {Q.letters(_ENTITY_SQL)} AS cleaned FROM pages"
)
def clean_ascii_letters_html(spark, sf_dir):
    pages = I.table(spark, sf_dir, "pages")
    return pages.select("page_id", X.clean_ascii_letters(F.col("html")).alias("cleaned"))


@query("clean_ascii_light", f"SELECT doc_id, {Q.light('text')} AS cleaned FROM documents")
def clean_ascii_light(spark, sf_dir):
    documents = I.table(spark, sf_dir, "documents")
    return X.with_clean_text(documents.select("doc_id", "text"), "light", target="cleaned").drop("text")


@query("clean_silver", f"SELECT doc_id, {Q.silver_text('text')} AS cleaned FROM documents")
def clean_silver(spark, sf_dir):
    documents = I.table(spark, sf_dir, "documents")
    return documents.select("doc_id", X.clean_silver(F.col("text")).alias("cleaned"))


@query(
    "clean_v1",
    "SELECT doc_id, regexp_replace(lower(trim(text)), '\\s+', ' ', 'g') AS cleaned FROM documents",
)
def clean_v1(spark, sf_dir):
    documents = I.table(spark, sf_dir, "documents")
    return documents.select("doc_id", X.clean_v1(F.col("text")).alias("cleaned"))


@query(
    "normalize_label",
    f"""WITH {Q.RAW} SELECT record_seq, {Q.label('label', 'words')} AS words, {Q.label('label', 'signed')} AS signed,
    {Q.label('label', 'ordinal')} AS "ordinal", {Q.label('label', 'silver', keep=False)} AS silver FROM raw_records""",
)
def normalize_label(spark, sf_dir):
    raw = I.raw_records(spark, sf_dir)
    value = F.col("label")
    return raw.select(
        "record_seq",
        *[L.normalize_label(value, p).alias(p) for p in ("words", "signed", "ordinal")],
        L.normalize_label(value, "silver", unknown="null").alias("silver"),
    )


@query(
    "label_index_to_name",
    """SELECT doc_id, coalesce(CASE quality + toxic * 2 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive'
    END, CAST(quality + toxic * 2 AS VARCHAR)) AS named FROM labels""",
)
def label_index_to_name(spark, sf_dir):
    number = F.col("quality") + F.col("toxic") * 2
    labels = I.table(spark, sf_dir, "labels")
    return labels.select("doc_id", L.label_index_to_name(number, LABELS).alias("named"))


@query(
    "label_id",
    f"""WITH {Q.CANONICAL} SELECT record_seq, CASE label_normalized WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1
    WHEN 'positive' THEN 2 END AS label_id FROM canonical""",
)
def label_id(spark, sf_dir):
    rows = I.raw_records(spark, sf_dir)
    return rows.select("record_seq", L.label_id(L.normalize_label(F.col("label"), "signed")).alias("label_id"))


@query(
    "record_hash",
    f"""WITH {Q.STAGED} SELECT raw_text, raw_label, source_split, source_dataset, source_record_hash FROM staged""",
)
def record_hash(spark, sf_dir):
    staged = M.bronze_stage(I.bronze_input(spark, sf_dir))
    return staged.select("raw_text", "raw_label", "source_split", "source_dataset", "source_record_hash")


@query(
    "text_hash",
    "SELECT doc_id, sha256(regexp_replace(lower(trim(text)), '\\s+', ' ', 'g')) AS text_hash FROM documents",
)
def text_hash(spark, sf_dir):
    documents = I.table(spark, sf_dir, "documents")
    return documents.select("doc_id", X.text_hash(X.clean_v1(F.col("text"))).alias("text_hash"))


@query(
    "hash_split",
    f"""SELECT doc_id, b AS bucket, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT doc_id, {Q.bucket(Q.seeded(42, 'doc_id'))} AS b FROM documents)""",
)
def hash_split(spark, sf_dir):
    bucket = X.hash_bucket(X.seeded_hash(42, "doc_id"))
    documents = I.table(spark, sf_dir, "documents")
    return documents.select("doc_id", bucket.alias("bucket"), L.split_from_bucket(bucket).alias("split"))


@query(
    "text_features",
    f"""WITH {Q.FEATURES} SELECT record_seq, text, label_normalized, split, char_count, word_count,
    lower(text) AS text_lower FROM features""",
)
def text_features(spark, sf_dir):
    features = R.text_features(I.canonical_records(spark, sf_dir))
    return features.select(
        "record_seq", "text", "label_normalized", "split", "char_count", "word_count",
        F.lower("text").alias("text_lower"),
    )


@query(
    "safe_names",
    f"""WITH {Q.RAW} SELECT record_seq AS "record_seq", dataset_id AS "dataset", dataset_label AS dataset_2, label AS column_3,
    lower(trim(regexp_replace(dataset_id, '[^a-zA-Z0-9_]+', '_', 'g'), '_')) AS safe_key FROM raw_records""",
)
def safe_names(spark, sf_dir):
    raw = I.raw_records(spark, sf_dir)
    odd = raw.select(
        F.col("record_seq").alias("Record Seq"), F.col("dataset_id").alias("Dataset"),
        F.col("dataset_label").alias("(dataset)"), F.col("label").alias("??"),
        X.safe_key(F.col("dataset_id")).alias("safe-key"),
    )
    return C.with_safe_names(odd)


@query(
    "result_partition_date",
    f"""WITH {Q.STREAM} SELECT position, CASE WHEN submitted_at <> '' THEN split_part(submitted_at, 'T', 1)
    ELSE '2024-06-01' END AS date FROM requests""",
)
def result_partition_date(spark, sf_dir):
    from ledgertone.streaming.requests import decode_request, result_date, validate_request

    rows = validate_request(decode_request(I.stream_records(spark, sf_dir)))
    return rows.select(
        "position", result_date(F.col("submitted_at"), F.lit("2024-06-01T00:00:00Z")).alias("date")
    )


_P = [f"CAST({Q.bucket(Q.seeded(s, 'record_seq'))} % 10 AS DOUBLE) / 10.0" for s in (42, 43, 44)]


@query(
    "canonical_prediction",
    f"""WITH {Q.LABELLED} SELECT record_seq,
    CASE WHEN neg >= neu AND neg >= pos THEN 'negative' WHEN neu >= pos THEN 'neutral' ELSE 'positive' END AS label,
    greatest(neg, neu, pos) AS score, neg AS p_negative, neu AS p_neutral, pos AS p_positive
    FROM (SELECT record_seq, {_P[1]} AS neg, {_P[2]} AS neu,
      CASE WHEN record_seq % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE {_P[0]} END AS pos FROM labelled)""",
)
def canonical_prediction(spark, sf_dir):
    rows = I.probabilities(spark, sf_dir).withColumn("p", L.canonical_prediction(F.col("probabilities")))
    return rows.select(
        "record_seq", "p.label", "p.score", *[F.col("p.probabilities")[n].alias(f"p_{n}") for n in LABELS]
    )


@query(
    "remap_label_ids",
    """SELECT doc_id, CASE m WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 1 END AS canonical_id,
    CASE m WHEN 2 THEN 0 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS model_id
    FROM (SELECT doc_id, quality + toxic * 2 AS m FROM labels)""",
)
def remap_label_ids(spark, sf_dir):
    order = ("positive", "negative", "neutral")
    number = F.col("quality") + F.col("toxic") * 2
    return I.table(spark, sf_dir, "labels").select(
        "doc_id", L.remap_label_ids(number, order).alias("canonical_id"),
        L.remap_label_ids(number, order, to_model=True).alias("model_id"),
    )


@query(
    "resolve_columns",
    f"""WITH {Q.RAW} SELECT record_seq, text AS found, label AS found_any_case, 'canonical_parquet' AS defaulted
    FROM raw_records""",
)
def resolve_columns(spark, sf_dir):
    raw = I.raw_records(spark, sf_dir)
    return raw.select(
        "record_seq",
        C.resolve_column(raw, ["headline", "text", "label"]).alias("found"),
        C.resolve_column(raw, ["Label"], ignore_case=True, required=True).alias("found_any_case"),
        C.resolve_column(raw, ["news", "Label"], "canonical_parquet").alias("defaulted"),
    )


_SHAPES = [("instruction", "huggingface"), ("multilingual", "huggingface"), ("polarity", "huggingface"),
           ("capitalised", "kaggle")]
SOURCES_SQL = f"""{Q.RAW}, sources AS (""" + " UNION ALL ".join(
    f"""SELECT record_seq, 'org/{shape}' AS dataset_id, '{shape}_set' AS dataset_label,
    '{platform}' AS source_platform, coalesce({Q.split('split')}, 'train') AS split, {Q.letters('text')} AS text,
    {Q.label('label', 'signed')} AS label_normalized FROM raw_records WHERE record_seq % 4 = {n}
    {"AND lower(language) IN ('en', 'english')" if shape == 'multilingual' else ''}"""
    for n, (shape, platform) in enumerate(_SHAPES)
) + ")"


@query("standardize_source", f"WITH {SOURCES_SQL} SELECT dataset_label, record_seq, split, text, label_normalized FROM sources")
def standardize_source(spark, sf_dir):
    """Each of the four shapes, one under the other."""
    columns = ("dataset_label", "record_seq", "split", "text", "label_normalized")
    first, *rest = [df.select(*columns) for df in I.standardized_sources(spark, sf_dir)]
    for df in rest:
        first = first.union(df)
    return first


@query("union_canonical", f"WITH {SOURCES_SQL} SELECT * FROM sources")
def union_canonical(spark, sf_dir):
    return C.union_by_name(I.standardized_sources(spark, sf_dir))


@query("language_filter", "SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def language_filter(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    return S.language_filter(documents, strict=True)


@query("canonical_valid_filter", f"WITH {Q.VALID} SELECT record_seq, text, label_normalized FROM valid")
def canonical_valid_filter(spark, sf_dir):
    rows = S.canonical_valid(I.canonical_records(spark, sf_dir))
    return rows.select("record_seq", "text", "label_normalized")


@query(
    "source_split_map",
    f"WITH {Q.RAW} SELECT record_seq, {Q.split('split')} AS split FROM raw_records",
)
def source_split_map(spark, sf_dir):
    raw = I.raw_records(spark, sf_dir)
    return raw.select("record_seq", L.source_split(F.lower(F.trim("split"))).alias("split"))


@query(
    "display_names",
    f"""WITH {Q.RAW} SELECT record_seq, label, CASE label WHEN 'Bullish' THEN 'Positive (market)' WHEN '-1'
    THEN 'Negative (signed)' ELSE label END AS shown FROM raw_records""",
)
def display_names(spark, sf_dir):
    raw = I.raw_records(spark, sf_dir).select("record_seq", "label")
    return R.display_names(raw, "label", {"Bullish": "Positive (market)", "-1": "Negative (signed)"}, "shown")


@query(
    "fill_defaults",
    f"""WITH {Q.RAW} SELECT record_seq, trim(coalesce(text, ''), chr(10) || chr(13) || chr(9) || ' ') AS text,
    coalesce(label, 'missing') AS label_normalized, coalesce(split, 'unspecified') AS split FROM raw_records""",
)
def fill_defaults(spark, sf_dir):
    raw = I.raw_records(spark, sf_dir).withColumnRenamed("label", "label_normalized")
    return M.fill_defaults(raw).select("record_seq", "text", "label_normalized", "split")
