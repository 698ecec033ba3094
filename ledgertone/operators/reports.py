"""Dataset summaries, distributions and text-length statistics.

Length statistics all start from one small histogram (dataset, label, words -> rows): medians,
percentiles, box and density values are exact and never buffer a group's rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertone.functions.text import char_count, np_round, word_count
from ledgertone.operators.dedup import duplicate_flags
from ledgertone.operators.medallion import fill_defaults
from ledgertone.schemas import LABELS, MODEL_FEATURES
from ledgertone.session import computed_once, cut_lineage


def text_features(df: DataFrame) -> DataFrame:
    """Defaults filled, character and word counts added."""
    text = F.col("text")
    return computed_once(fill_defaults(df), char_count=char_count(text), word_count=word_count(text))


def model_features(df: DataFrame, key: Sequence[str], snapshot_date: str) -> DataFrame:
    """Curated rows to feature-snapshot rows."""
    flagged = duplicate_flags(text_features(df), key)
    return flagged.withColumn("snapshot_date", F.lit(snapshot_date)).select(
        *[k for k in key if k not in MODEL_FEATURES.fieldNames()], *MODEL_FEATURES.fieldNames()
    )


def count_by_split_label(df: DataFrame) -> DataFrame:
    """Counts by split, by label and by both; the fine counts are summed up, not the rows."""
    fine = df.groupBy("split", "label_normalized").agg(F.count("*").alias("rows"))
    return fine.groupingSets(
        [["split"], ["label_normalized"], ["split", "label_normalized"]], "split", "label_normalized"
    ).agg(F.sum("rows").alias("rows"), F.grouping_id().cast("bigint").alias("grouping_level")).select(
        "split", "label_normalized", "grouping_level", "rows"
    )


def word_histogram(features: DataFrame, *by: str) -> DataFrame:
    return features.groupBy(*by, "word_count").agg(F.count("*").alias("n"))


def percentile_of(histogram_column: str, share: float | Sequence[float], count: str = "n") -> Column:
    """Exact percentile with linear interpolation over (value, count) rows."""
    shares = f"array({', '.join(map(str, share))})" if isinstance(share, (list, tuple)) else str(share)
    return F.expr(f"percentile({histogram_column}, {shares}, {count})")


def dataset_summary(features: DataFrame) -> DataFrame:
    """Per dataset: rows, splits, labels, lengths, blank and duplicate shares."""
    fine = features.groupBy("dataset_label", "split", "label_normalized", "word_count").agg(
        F.count("*").alias("n"),
        F.sum("char_count").alias("chars"),
        F.count_if(F.col("char_count") == 0).alias("blank"),
        F.count_if("duplicate_within_dataset").alias("copies"),
    )
    rows = F.sum("n")
    return fine.groupBy("dataset_label").agg(
        rows.alias("rows"),
        F.array_join(F.array_sort(F.collect_set("split")), ", ").alias("splits"),
        F.count_distinct("label_normalized").alias("normalized_label_count"),
        (F.sum("chars") / rows).alias("avg_chars"),
        percentile_of("word_count", 0.5).alias("median_words"),
        np_round(F.sum("blank") / rows * 100, 2).alias("missing_text_pct"),
        np_round(F.sum("copies") / rows * 100, 2).alias("duplicate_pct"),
    )


def label_distribution(features: DataFrame) -> DataFrame:
    """Rows of each label within its dataset and their share; every label that occurs has its row."""
    counts = features.groupBy("dataset_label", "label_normalized").agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(W.partitionBy("dataset_label"))  # one row per label
    return counts.withColumn("share", F.col("rows") / total)


def split_distribution(features: DataFrame) -> DataFrame:
    """Rows of each split of each dataset; every split that occurs has its row."""
    return features.groupBy("dataset_label", "split").agg(F.count("*").alias("rows"))


def split_manifest(canonical: DataFrame, columns: int | None = None) -> DataFrame:
    """Per dataset and split: rows, columns, distinct raw and normalised labels."""
    width = len(canonical.columns) if columns is None else columns
    # Distinct (raw, normalised) pairs are few; the second step counts over them.
    pairs = canonical.groupBy("dataset_label", "split", "label_raw", "label_normalized").agg(
        F.count("*").alias("n")
    )
    return pairs.groupBy("dataset_label", "split").agg(
        F.sum("n").alias("rows"),
        F.lit(width).cast("bigint").alias("columns"),
        F.count_distinct("label_raw").alias("unique_raw_labels"),
        F.count_distinct("label_normalized").alias("unique_normalized_labels"),
    )


def split_label_counts(canonical: DataFrame) -> DataFrame:
    """Rows of each split, and of each label in it as a map."""
    fine = canonical.groupBy("split", F.coalesce("label_normalized", F.lit("missing")).alias("label")).agg(
        F.count("*").alias("n")
    )
    return fine.groupBy("split").agg(
        F.sum("n").alias("rows"), F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("labels")
    )


def word_count_by_label(features: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, mean, median, 90th percentile and maximum of words per dataset and label."""
    counted = word_histogram(features, "dataset_label", "label_normalized")
    if approximate:
        ranks = [F.percentile_approx("word_count", p, 10_000).cast("double") for p in (0.5, 0.9)]
        counted = features.withColumn("n", F.lit(1))
    else:
        ranks = [percentile_of("word_count", p) for p in (0.5, 0.9)]
    return counted.groupBy("dataset_label", "label_normalized").agg(
        F.sum("n").alias("rows"),
        (F.sum(F.col("word_count") * F.col("n")) / F.sum("n")).alias("mean_words"),
        ranks[0].alias("median_words"),
        ranks[1].alias("p90_words"),
        F.max("word_count").cast("bigint").alias("max_words"),
    )


def summarize_splits(df: DataFrame) -> DataFrame:
    words = word_count(F.col("text"))
    return df.groupBy("split").agg(
        F.count("*").alias("rows"),
        np_round(F.avg(words), 2).alias("mean_words"),
        *[F.count_if(F.col("label_normalized") == name).alias(name) for name in LABELS],
    )


def _trimmed(features: DataFrame, quantile: float = 0.99) -> DataFrame:
    """Length histogram up to the overall quantile; kept, because every figure comes from it."""
    counted = cut_lineage(word_histogram(features, "dataset_label", "label_normalized"))
    # Group rows are few; the overall quantile reads the per-length totals.
    overall = counted.groupBy("word_count").agg(F.sum("n").alias("n"))
    limit = overall.agg(percentile_of("word_count", quantile).alias("limit"))
    return counted.where(F.col("word_count") <= limit.scalar())


def word_count_histogram(features: DataFrame, bins: int = 30) -> DataFrame:
    """Density per dataset and label over common equal-width bins up to the 99th percentile."""
    trimmed = _trimmed(features)
    low = trimmed.agg(F.min("word_count").cast("double").alias("low")).scalar()
    high = trimmed.agg(F.max("word_count").cast("double").alias("high")).scalar()
    placed = trimmed.withColumns({"low": low, "width": (high - low) / F.lit(bins)})
    position = F.when(F.col("width") > 0, F.floor((F.col("word_count") - F.col("low")) / F.col("width"))).otherwise(0)
    binned = placed.withColumn("bin", F.least(position, F.lit(bins - 1)).cast("bigint"))
    per_bin = binned.groupBy("dataset_label", "label_normalized", "bin").agg(
        F.sum("n").alias("rows"), F.first("low").alias("low"), F.first("width").alias("width")
    )
    total = F.sum("rows").over(W.partitionBy("dataset_label", "label_normalized"))
    return per_bin.select(
        "dataset_label", "label_normalized", "bin", "rows",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.when(F.col("width") > 0, F.col("rows") / (total * F.col("width"))).alias("density"),
    )


def word_count_box(features: DataFrame, by_dataset: bool = True, trim: bool = False) -> DataFrame:
    """Quartiles and whiskers (furthest value within 1.5 interquartile ranges) of words per label.

    ``trim`` leaves out lengths beyond the 99th percentile of all rows first.
    """
    by = ["dataset_label", "label_normalized"] if by_dataset else ["label_normalized"]
    counted = _trimmed(features) if trim else cut_lineage(word_histogram(features, *by))
    counted = counted.groupBy(*by, "word_count").agg(F.sum("n").alias("n"))
    # Quartiles join back onto the histogram, which has one row per length.
    quartiles = counted.groupBy(*by).agg(percentile_of("word_count", [0.25, 0.5, 0.75]).alias("q"))
    q1, q3 = F.col("q")[0], F.col("q")[2]
    reach = (q3 - q1) * 1.5
    inside = F.when(F.col("word_count").between(q1 - reach, q3 + reach), F.col("word_count"))
    return counted.join(quartiles, by).groupBy(*by).agg(
        F.first(q1).alias("q1"), F.first(F.col("q")[1]).alias("median"), F.first(q3).alias("q3"),
        F.min(inside).cast("bigint").alias("whisker_low"), F.max(inside).cast("bigint").alias("whisker_high"),
        F.sum("n").alias("rows"),
    )


def display_names(df: DataFrame, column: str, names: dict[str, str], target: str) -> DataFrame:
    """Display name where the table has one, else the value itself."""
    chain = F
    for value, shown in names.items():
        chain = chain.when(F.col(column) == value, F.lit(shown))
    return df.withColumn(target, chain.otherwise(F.col(column)) if names else F.col(column))


def evidence_latest(table: DataFrame, order: str, rows: int) -> DataFrame:
    """Newest rows of a control table, as a top-k rather than a full sort."""
    rest = [c for c in table.columns if c != order]
    return table.orderBy(F.col(order).desc(), *rest).limit(rows)
