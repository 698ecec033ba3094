"""Counts, summaries and distributions."""

from pyspark.sql import functions as F

from ledgertone.operators import overlap as O
from ledgertone.operators import reports as R
from ledgertone.operators import sketches as K
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.medallion import gold
from ledgertone.plans.catalog.registry import query
from ledgertone.session import scratch_path, stage
from ledgertone.sinks import tables as W

_TRIMMED = """trimmed AS (SELECT * FROM features
  WHERE word_count <= (SELECT quantile_cont(word_count, 0.99) FROM features))"""


def features(spark, sf_dir):
    """Feature rows without the duplicate flags."""
    return R.text_features(I.canonical_records(spark, sf_dir))


def flagged(spark, sf_dir):
    return R.model_features(
        I.canonical_records(spark, sf_dir).withColumn("label_id", F.lit(None).cast("int")),
        ["record_seq"], "2024-01-31",
    )


@query(
    "count_by_split_label",
    f"""WITH {Q.GOLD} SELECT split, label_normalized, CAST(grouping(split, label_normalized) AS BIGINT) AS grouping_level,
    count(*) AS rows FROM gold
    GROUP BY GROUPING SETS ((split), (label_normalized), (split, label_normalized))""",
)
def count_by_split_label(spark, sf_dir):
    return R.count_by_split_label(gold(spark, sf_dir))


@query(
    "model_features",
    f"""WITH {Q.FEATURES} SELECT record_seq, dataset_id, dataset_label, source_platform, split, text,
    label_normalized, label_id, char_count, word_count, duplicate_within_dataset, duplicate_global,
    '2024-01-31' AS snapshot_date FROM features""",
)
def model_features(spark, sf_dir):
    from ledgertone.functions.labels import label_id

    rows = I.canonical_records(spark, sf_dir).withColumn("label_id", label_id(F.col("label_normalized")))
    return R.model_features(rows, ["record_seq"], "2024-01-31")


@query(
    "dataset_summary",
    f"""WITH {Q.FEATURES} SELECT dataset_label, count(*) AS rows,
    string_agg(DISTINCT split, ', ' ORDER BY split) AS splits,
    count(DISTINCT label_normalized) AS normalized_label_count, round(avg(char_count), 6) AS avg_chars,
    quantile_cont(word_count, 0.5) AS median_words,
    {Q.np_round('avg(CAST(char_count = 0 AS INTEGER)) * 100', 2)} AS missing_text_pct,
    {Q.np_round('avg(CAST(duplicate_within_dataset AS INTEGER)) * 100', 2)} AS duplicate_pct
    FROM features GROUP BY dataset_label""",
)
def dataset_summary(spark, sf_dir):
    return R.dataset_summary(flagged(spark, sf_dir)).withColumn("avg_chars", F.round("avg_chars", 6))


@query(
    "label_distribution",
    f"""WITH {Q.FEATURES} SELECT dataset_label, label_normalized, count(*) AS rows,
    round(count(*) / sum(count(*)) OVER (PARTITION BY dataset_label), 9) AS share
    FROM features GROUP BY dataset_label, label_normalized""",
)
def label_distribution(spark, sf_dir):
    return R.label_distribution(features(spark, sf_dir)).withColumn("share", F.round("share", 9))


@query(
    "split_distribution",
    f"WITH {Q.FEATURES} SELECT dataset_label, split, count(*) AS rows FROM features GROUP BY dataset_label, split",
)
def split_distribution(spark, sf_dir):
    return R.split_distribution(features(spark, sf_dir))


@query(
    "split_manifest",
    f"""WITH {Q.VALID} SELECT dataset_label, split, count(*) AS rows, CAST(8 AS BIGINT) AS columns,
    count(DISTINCT label_raw) AS unique_raw_labels, count(DISTINCT label_normalized) AS unique_normalized_labels
    FROM valid GROUP BY dataset_label, split""",
)
def split_manifest(spark, sf_dir):
    from ledgertone.sources.specs import canonical_valid

    return R.split_manifest(canonical_valid(I.canonical_records(spark, sf_dir)), columns=8)


@query(
    "word_count_by_label",
    f"""WITH {Q.FEATURES} SELECT dataset_label, label_normalized, count(*) AS rows, round(avg(word_count), 6) AS mean_words,
    quantile_cont(word_count, 0.5) AS median_words, round(quantile_cont(word_count, 0.9), 6) AS p90_words,
    CAST(max(word_count) AS BIGINT) AS max_words FROM features GROUP BY dataset_label, label_normalized""",
)
def word_count_by_label(spark, sf_dir):
    report = R.word_count_by_label(features(spark, sf_dir))
    return report.withColumns({c: F.round(c, 6) for c in ("mean_words", "p90_words")})


@query(
    "summarize_splits",
    f"""WITH {Q.CANONICAL}, counted AS (SELECT split, label_normalized, {Q.WORDS} AS words FROM canonical)
    SELECT split, count(*) AS rows, {Q.np_round('avg(words)', 2)} AS mean_words,
    count(*) FILTER (label_normalized = 'negative') AS negative,
    count(*) FILTER (label_normalized = 'neutral') AS neutral,
    count(*) FILTER (label_normalized = 'positive') AS positive FROM counted GROUP BY split""",
)
def summarize_splits(spark, sf_dir):
    return R.summarize_splits(I.canonical_records(spark, sf_dir))


@query(
    "word_count_histogram",
    f"""WITH {Q.FEATURES}, {_TRIMMED}, edges AS (SELECT CAST(min(word_count) AS DOUBLE) AS low,
      (CAST(max(word_count) AS DOUBLE) - min(word_count)) / 30 AS width FROM trimmed),
    binned AS (SELECT dataset_label, label_normalized, low, width,
      CAST(least(floor((word_count - low) / width), 29) AS BIGINT) AS bin FROM trimmed, edges),
    counted AS (SELECT dataset_label, label_normalized, bin, low, width, count(*) AS rows FROM binned GROUP BY ALL)
    SELECT dataset_label, label_normalized, bin, rows, round(low + bin * width, 6) AS bin_start,
    round(rows / (sum(rows) OVER (PARTITION BY dataset_label, label_normalized) * width), 9) AS density
    FROM counted""",
)
def word_count_histogram(spark, sf_dir):
    bins = R.word_count_histogram(features(spark, sf_dir))
    return bins.withColumns({"bin_start": F.round("bin_start", 6), "density": F.round("density", 9)})


def _box(source: str, by: str) -> str:
    same = " AND ".join(f"r.{c} = q.{c}" for c in by.split(", "))
    picked = ", ".join(f"q.{c}" for c in by.split(", "))
    return f"""quartiles AS (SELECT {by}, quantile_cont(word_count, 0.25) AS q1,
      quantile_cont(word_count, 0.5) AS median, quantile_cont(word_count, 0.75) AS q3 FROM {source} GROUP BY {by})
    SELECT {picked}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
    CAST(min(word_count) FILTER (word_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS BIGINT)
      AS whisker_low,
    CAST(max(word_count) FILTER (word_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS BIGINT)
      AS whisker_high, count(*) AS rows
    FROM {source} r JOIN quartiles q ON {same} GROUP BY {picked}, q1, median, q3"""


def _rounded_box(box):
    return box.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("word_count_box", f"WITH {Q.FEATURES}, {_TRIMMED}, {_box('trimmed', 'dataset_label, label_normalized')}")
def word_count_box(spark, sf_dir):
    return _rounded_box(R.word_count_box(features(spark, sf_dir), trim=True))


@query("word_count_box_overall", f"WITH {Q.FEATURES}, {_box('features', 'label_normalized')}")
def word_count_box_overall(spark, sf_dir):
    return _rounded_box(R.word_count_box(features(spark, sf_dir), by_dataset=False))


@query(
    "dataset_overlap",
    f"""WITH {Q.VALID}, held AS (SELECT DISTINCT dataset_label AS d, sha256(lower(text)) AS h FROM valid),
    sizes AS (SELECT d, count(*) AS n FROM held GROUP BY d)
    SELECT a.d AS dataset_a, b.d AS dataset_b, count(*) AS shared_texts, any_value(sa.n) AS texts_a,
    any_value(sb.n) AS texts_b, round_even(count(*) / CAST(least(any_value(sa.n), any_value(sb.n)) AS DOUBLE), 6)
      AS shared_share
    FROM held a JOIN held b ON a.h = b.h AND a.d < b.d JOIN sizes sa ON sa.d = a.d JOIN sizes sb ON sb.d = b.d
    GROUP BY a.d, b.d""",
)
def dataset_overlap(spark, sf_dir):
    from ledgertone.sources.specs import canonical_valid

    rows = canonical_valid(I.canonical_records(spark, sf_dir)).select(
        "dataset_label", F.sha2(F.lower("text"), 256).alias("text_hash")
    )
    rows = stage(rows, "hashes")
    return O.overlap_shares(O.dataset_overlap(rows), rows)


@query(
    "length_sketches",
    f"""WITH {Q.FEATURES} SELECT dataset_label, label_normalized, count(word_count) AS rows, min(word_count) AS low,
    max(word_count) AS high, true AS within FROM features GROUP BY dataset_label, label_normalized""",
)
def length_sketches(spark, sf_dir):
    """Sketches of two dates, stored and merged; ``within`` tells whether every quantile has a rank within the error."""
    base, by = scratch_path(spark, "sketches"), ["dataset_label", "label_normalized"]
    rows = features(spark, sf_dir).withColumn("date", F.concat(F.lit("2024-01-3"), F.col("record_seq") % 2))
    sketches = K.length_sketches(rows, "word_count", [*by, "date"])
    W.overwrite_snapshot_partition(sketches, base, "date")
    merged = K.merged_sketches(spark.read.schema(sketches.schema).parquet(base), by)
    told = K.sketch_quantiles(merged, (0.25, 0.5, 0.9))
    lengths = rows.groupBy(*by, "word_count").agg(F.count("*").alias("n"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    ranked = lengths.withColumnsRenamed({c: f"_{c}" for c in by}).join(told, same)
    out = [c for c in told.columns if not c.startswith("p")]
    below, upto, within = [], [], F.lit(True)
    for name, fraction in (("p25", 0.25), ("p50", 0.5), ("p90", 0.9)):
        below.append(F.sum(F.when(F.col("word_count") < F.col(name), F.col("n")).otherwise(0)).alias(f"below_{name}"))
        upto.append(F.sum(F.when(F.col("word_count") <= F.col(name), F.col("n")).otherwise(0)).alias(f"upto_{name}"))
        slack = F.greatest(F.lit(3 * K.rank_error()) * F.col("rows"), F.lit(1.0))
        within = within & (F.col(f"below_{name}") <= fraction * F.col("rows") + slack) & (
            F.col(f"upto_{name}") >= fraction * F.col("rows") - slack)
    return ranked.groupBy(*out).agg(*below, *upto).select(*out, within.alias("within"))
