"""SQL building blocks of the twins."""

from ledgertone.plans.inputs import CANDIDATES, MODELS

# Spellings of labels and splits, written out here so that a wrong list in the code shows.
ALIAS_PROFILES = {
    "words": {
        "positive": ("positive", "mildly positive", "moderately positive", "strong positive"),
        "negative": ("negative", "mildly negative", "moderately negative", "strong negative"),
        "neutral": ("neutral",),
    },
    "signed": {
        "positive": ("positive", "mildly positive", "moderately positive", "strong positive", "bullish", "pos",
                     "positivo", "1"),
        "negative": ("negative", "mildly negative", "moderately negative", "strong negative", "bearish", "neg",
                     "negativo", "-1"),
        "neutral": ("neutral", "neu", "neutro", "0"),
    },
    "ordinal": {
        "positive": ("positive", "pos", "bullish", "mildly positive", "moderately positive", "strong positive", "2"),
        "negative": ("negative", "neg", "bearish", "mildly negative", "moderately negative", "strong negative", "0"),
        "neutral": ("neutral", "neu", "1"),
    },
    "silver": {
        "positive": ("positive", "pos", "1", "bullish"),
        "negative": ("negative", "neg", "-1", "bearish"),
        "neutral": ("neutral", "neu", "0"),
    },
}
SPLIT_ALIASES = {
    "train": ("train", "training"), "validation": ("validation", "valid", "val"), "test": ("test", "testing"),
}


def quoted(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def aliases(value: str, table: dict, otherwise: str | None = None) -> str:
    whens = " ".join(f"WHEN {value} IN ({quoted(names)}) THEN '{name}'" for name, names in table.items())
    return f"CASE {whens}{' ELSE ' + otherwise if otherwise else ''} END"


def label(value: str, profile: str, keep: bool = True) -> str:
    value = f"lower(trim({value}))"
    return aliases(value, ALIAS_PROFILES[profile], value if keep else None)


def split(value: str) -> str:
    return aliases(f"lower(trim({value}))", SPLIT_ALIASES)


def ascii_only(value: str) -> str:
    return f"regexp_replace(strip_accents({value}), '[^\\x00-\\x7F]', '', 'g')"


def letters(value: str) -> str:
    return f"nullif(trim(regexp_replace(lower({ascii_only(value)}), '[^a-z]+', ' ', 'g')), '')"


def light(value: str) -> str:
    return f"trim(regexp_replace({ascii_only(value)}, '\\s+', ' ', 'g'))"


def silver_text(value: str) -> str:
    v = f"trim(regexp_replace(lower({value}), '\\s+', ' ', 'g'))"
    v = f"regexp_replace({v}, 'https?://\\S+|www\\.\\S+', '', 'g')"
    v = f"regexp_replace({v}, '[^a-zA-Z0-9áéíóúñüÁÉÍÓÚÑÜ$%.,;:!?\\- ]', '', 'g')"
    return f"trim(regexp_replace({v}, '\\s+', ' ', 'g'))"


def joined_hash(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"sha256(concat_ws('||', {parts}))"


def seeded(seed: int | str, key: str) -> str:
    return f"sha256(concat('{seed}|', CAST({key} AS VARCHAR)))"


def bucket(hashed: str) -> str:
    return f"(CAST('0x' || substr({hashed}, 1, 8) AS BIGINT) % 100)"


def np_round(value: str, digits: int) -> str:
    return f"(round_even(CAST({value} AS DOUBLE) * 1e{digits}, 0) / 1e{digits})"


RAW = """raw_records AS (
SELECT d.doc_id AS record_seq, concat('org/', d.source) AS dataset_id, d.source AS dataset_label,
  CASE WHEN d.doc_id % 4 = 3 THEN 'kaggle' ELSE 'huggingface' END AS source_platform, d.lang AS language,
  CASE d.doc_id % 10 WHEN 7 THEN 'Validation' WHEN 8 THEN ' test ' WHEN 9 THEN NULL ELSE 'train' END AS split,
  CASE WHEN d.doc_id % 97 = 0 THEN '  ' WHEN d.doc_id % 89 = 0 THEN NULL ELSE d.text END AS text,
  CASE WHEN l.doc_id IS NULL THEN CASE d.doc_id % 5 WHEN 0 THEN 'mixed' WHEN 1 THEN 'Negative' WHEN 2 THEN 'POS' END
    WHEN l.toxic = 1 THEN CASE d.doc_id % 3 WHEN 0 THEN 'Negative' WHEN 1 THEN ' bearish ' ELSE '-1' END
    WHEN l.quality = 1 THEN CASE d.doc_id % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'Bullish' ELSE 'mildly positive' END
    ELSE CASE d.doc_id % 3 WHEN 0 THEN 'Neutral' WHEN 1 THEN 'NEU' ELSE '0' END END AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

CANONICAL = f"""{RAW}, canonical AS (
SELECT *, {joined_hash('dataset_label', 'split', 'text', 'label_normalized')} AS source_record_hash FROM (
SELECT record_seq, dataset_id, dataset_label, source_platform, {split('split')} AS split, {letters('text')} AS text,
  label AS label_raw, {label('label', 'signed')} AS label_normalized FROM raw_records))"""

VALID = f"""{CANONICAL}, valid AS (
SELECT * FROM canonical WHERE text IS NOT NULL AND length(trim(text)) > 0 AND label_normalized IS NOT NULL)"""

BRONZE_HASH = joined_hash(
    "raw_text", "raw_label", "source_platform", "source_dataset_id", "source_dataset", "source_split"
)
STAGED = f"""{RAW}, staged AS (
SELECT {BRONZE_HASH} AS source_record_hash, * FROM (
SELECT trim(text) AS raw_text, trim(lower(label)) AS raw_label, coalesce(split, 'unknown') AS source_split,
  dataset_label AS source_dataset, dataset_id AS source_dataset_id, source_platform,
  CAST(NULL AS VARCHAR) AS source_download_batch_id, concat('canonical/', dataset_label) AS source_path
FROM raw_records))"""

BRONZE = f"""{STAGED}, bronze AS (
SELECT DISTINCT * FROM staged
WHERE raw_text IS NOT NULL AND length(raw_text) > 0 AND raw_label IS NOT NULL)"""

SILVER = f"""{BRONZE}, base AS (
SELECT *, {silver_text('raw_text')} AS text_clean, {label('raw_label', 'silver', keep=False)} AS label_normalized,
  lower(trim(source_split)) AS source_split_clean FROM bronze),
silver AS (SELECT * FROM base
WHERE length(text_clean) >= 5 AND label_normalized IN ('negative', 'neutral', 'positive'))"""

SPLIT_OR_HASH = (
    f"coalesce({split('source_split_clean')}, "
    f"CASE WHEN {bucket(seeded(42, 'source_record_hash'))} < 70 THEN 'train' "
    f"WHEN {bucket(seeded(42, 'source_record_hash'))} < 85 THEN 'validation' ELSE 'test' END)"
)
PRIORITY = "CASE split WHEN 'test' THEN 1 WHEN 'validation' THEN 2 WHEN 'train' THEN 3 ELSE 4 END"

SPLIT_ROWS = f"""{SILVER}, split_rows AS (
SELECT source_record_hash, text_clean, label_normalized, {SPLIT_OR_HASH} AS split,
  CAST(length(text_clean) AS INTEGER) AS feature_text_length, source_dataset, source_path FROM silver)"""

GOLD = f"""{SPLIT_ROWS}, gold AS (
SELECT * EXCLUDE (rn, k) FROM (
  SELECT *, row_number() OVER (PARTITION BY text_clean
      ORDER BY {PRIORITY}, source_dataset, label_normalized, source_record_hash) AS rn,
    min(label_normalized) OVER (PARTITION BY text_clean) = max(label_normalized) OVER (PARTITION BY text_clean) AS k
  FROM split_rows) WHERE rn = 1 AND k)"""

SILVER_V1 = f"""{CANONICAL}, v1 AS (
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY text_hash, label_normalized, split ORDER BY record_seq) AS rn FROM (
    SELECT *, sha256(text_clean) AS text_hash FROM (
      SELECT record_seq, dataset_id, dataset_label, source_platform, lower(trim(split)) AS split,
        trim(text) AS text_raw, regexp_replace(lower(trim(text)), '\\s+', ' ', 'g') AS text_clean,
        lower(trim(label_normalized)) AS label_normalized FROM canonical))
  WHERE length(text_clean) > 0 AND label_normalized IN ('negative', 'neutral', 'positive')
    AND split IN ('train', 'validation', 'test')) WHERE rn = 1)"""

CURATED = f"""{CANONICAL}, curated AS (
SELECT record_seq, dataset_id, dataset_label, source_platform, split, trim(text) AS text, label_normalized,
  CASE label_normalized WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END AS label_id
FROM canonical WHERE trim(text) <> '' AND label_normalized IN ('negative', 'neutral', 'positive'))"""

WORDS = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"

# Features keep the unlabelled rows too, so the defaults show.
FEATURES = f"""{CANONICAL}, filled AS (
SELECT record_seq, dataset_id, dataset_label, source_platform, coalesce(split, 'unspecified') AS split,
  trim(coalesce(text, '')) AS text, coalesce(label_normalized, 'missing') AS label_normalized,
  CASE label_normalized WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END AS label_id
FROM canonical),
features AS (SELECT *, CAST(length(text) AS INTEGER) AS char_count, CAST({WORDS} AS INTEGER) AS word_count,
  row_number() OVER (PARTITION BY dataset_label, lower(text) ORDER BY record_seq) > 1 AS duplicate_within_dataset,
  row_number() OVER (PARTITION BY lower(text) ORDER BY record_seq) > 1 AS duplicate_global FROM filled)"""

_known = aliases(
    "lower(trim(label))",
    {k: (*v, "mildly positive") if k == "positive" else v for k, v in ALIAS_PROFILES["silver"].items()},
)
LABELLED = f"""{RAW}, labelled AS (
SELECT record_seq, text, {_known} AS label_normalized FROM raw_records WHERE {_known} IS NOT NULL)"""

_PREDICTED = (
    "CASE WHEN bucket < kept THEN label_normalized ELSE CASE label_normalized WHEN 'negative' THEN 'neutral' "
    "WHEN 'neutral' THEN 'positive' ELSE 'negative' END END"
)
_MODEL_ROWS = ", ".join(f"('{m}', '{s}', {k})" for m, s, k in MODELS)
PREDICTIONS = f"""{LABELLED}, predictions AS (
SELECT model_key, record_seq, text, label_normalized, {_PREDICTED} AS prediction, (50 + bucket % 50) / 100.0 AS score
FROM (SELECT *, {bucket("sha256(concat(seed, '|', CAST(record_seq AS VARCHAR)))")} AS bucket
  FROM labelled, (VALUES {_MODEL_ROWS}) m(model_key, seed, kept)))"""

_RUN_ROWS = ", ".join(f"('{b}', '{m}', '{s}', {k})" for b, m, s, k, _ in CANDIDATES if k is not None)
_CANDIDATE_ROWS = ", ".join(
    f"('{b}', '{m}', 'transformer', 'run-{b}-{m}', 'sentiment_{m}', '{i + 1}', TIMESTAMP '{at}')"
    for i, (b, m, _, _, at) in enumerate(CANDIDATES)
)


def metric_ctes(source: str, by: str, classes: str | None = None) -> str:
    """cells, classes and metrics over ``source`` grouped by ``by`` (comma list)."""
    names = classes or "(VALUES ('negative'), ('neutral'), ('positive')) c(class)"
    keys = [k.strip() for k in by.split(",")]
    same = " AND ".join(f"x.{k} = g.{k}" for k in keys)
    picked = ", ".join(f"g.{k}" for k in keys)
    return f"""cells AS (SELECT {by}, label_normalized AS label, prediction, count(*) AS n FROM {source}
  GROUP BY {by}, label_normalized, prediction),
classes AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision_,
    CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall_,
    CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END AS f1 FROM (
  SELECT {picked}, class,
    CAST(coalesce(sum(x.n) FILTER (x.label = class), 0) AS DOUBLE) AS support,
    CAST(coalesce(sum(x.n) FILTER (x.prediction = class), 0) AS DOUBLE) AS predicted,
    CAST(coalesce(sum(x.n) FILTER (x.label = class AND x.prediction = class), 0) AS DOUBLE) AS tp
  FROM (SELECT DISTINCT {by} FROM cells) g CROSS JOIN {names} JOIN cells x ON {same}
  GROUP BY {picked}, class)),
totals AS (SELECT {by}, CAST(sum(n) AS BIGINT) AS eval_rows,
  CAST(sum(n) FILTER (label = prediction) AS DOUBLE) / sum(n) AS accuracy FROM cells GROUP BY {by}),
averages AS (SELECT {by}, avg(precision_) AS macro_precision, avg(recall_) AS macro_recall, avg(f1) AS macro_f1,
  sum(f1 * support) / sum(support) AS weighted_f1 FROM classes GROUP BY {by}),
metrics AS (SELECT * FROM totals JOIN averages USING ({by}))"""


CANDIDATE_METRICS = f"""{LABELLED}, runs AS (
SELECT training_batch_id, model_key, record_seq, label_normalized, {_PREDICTED} AS prediction
FROM (SELECT *, {bucket("sha256(concat(seed, '|', CAST(record_seq AS VARCHAR)))")} AS bucket
  FROM labelled, (VALUES {_RUN_ROWS}) m(training_batch_id, model_key, seed, kept))),
{metric_ctes('runs', 'training_batch_id, model_key')},
candidates AS (SELECT * FROM (VALUES {_CANDIDATE_ROWS}) v(training_batch_id, model_key, model_family, run_id,
  registered_model_name, model_version, event_ts)),
candidate_metrics AS (SELECT c.training_batch_id, c.model_key, c.model_family, c.run_id, c.registered_model_name,
  CASE WHEN m.eval_rows IS NOT NULL THEN c.model_version END AS model_version, m.eval_rows, m.accuracy, m.macro_f1,
  m.weighted_f1, m.macro_precision AS precision_macro, m.macro_recall AS recall_macro,
  CASE WHEN m.eval_rows IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN m.eval_rows IS NULL THEN 'no predictions' END AS error_message, c.event_ts
FROM candidates c LEFT JOIN metrics m USING (training_batch_id, model_key))"""

STREAM = """stream_records AS (SELECT event_id AS position,
  CASE WHEN event_id % 50 = 0 THEN concat('{"text":"', event_type, '"}')
    WHEN event_id % 50 = 1 THEN concat('{"request_id":"req-', event_id, '","text":"  "}')
    WHEN event_id % 50 = 2 THEN '{not json' WHEN event_id % 50 = 3 THEN '[1,2]' WHEN event_id % 50 = 4 THEN ''
    ELSE concat('{"request_id":"req-', event_id, '","text":"', event_type, ' by user ', user_id,
      '","submitted_at":"', CAST(CAST(ts AS DATE) AS VARCHAR), 'T00:00:00Z"}') END AS payload FROM events),
requests AS (SELECT position, payload,
  CASE WHEN position % 50 IN (2, 3, 4) THEN '' ELSE trim(coalesce(TRY_CAST(payload AS JSON) ->> 'text', '')) END AS text,
  CASE WHEN position % 50 IN (2, 3, 4) THEN '' ELSE coalesce(TRY_CAST(payload AS JSON) ->> 'submitted_at', '') END AS submitted_at,
  CASE WHEN position % 50 IN (0, 2, 3, 4) THEN concat('invalid-record-', position)
    ELSE TRY_CAST(payload AS JSON) ->> 'request_id' END AS request_id,
  CASE position % 50 WHEN 0 THEN 'request_id is required.' WHEN 1 THEN 'text is required.'
    WHEN 2 THEN 'Record data is not valid JSON.' WHEN 3 THEN 'Record JSON must be an object.'
    WHEN 4 THEN 'Record is missing data.' END AS error_message FROM stream_records)"""

EVENTS = """training_events AS (SELECT concat('run-', user_id % 5) AS run_id,
  CASE WHEN user_id % 2 = 0 THEN 'warmup' ELSE 'finetune' END AS phase,
  (user_id % 20) + (event_id % 3) * CAST(0.00004 AS DOUBLE) AS epoch, event_id AS seq,
  CASE WHEN event_id % 4 = 0 THEN value END AS loss, CASE WHEN event_id % 4 = 1 THEN value END AS eval_loss,
  CASE WHEN event_id % 4 = 2 THEN value END AS eval_accuracy,
  CASE WHEN event_id % 4 = 3 THEN value END AS eval_macro_f1 FROM events)"""
