"""Declarative source mappings onto the canonical contract."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertone.functions.labels import label_index_to_name, normalize_label
from ledgertone.functions.text import with_clean_text
from ledgertone.schemas import CANONICAL
from ledgertone.sources.columns import find_column, resolve_column


@dataclass(frozen=True)
class SourceSpec:
    """How one dataset maps onto the canonical six columns."""

    key: str
    dataset_id: str
    dataset_label: str
    source_platform: str
    text_columns: tuple[str, ...]
    label_columns: tuple[str, ...]
    language_columns: tuple[str, ...] = ()
    languages: tuple[str, ...] = ("en", "english")
    strict_language: bool = False
    cleaner: str = "letters"
    label_profile: str = "signed"
    class_names: tuple[str, ...] = ()
    default_split: str = "train"
    enabled: bool = True


# Column candidates per source shape, first match wins.
SHAPES = {
    "instruction": {
        "text_columns": ("input", "text", "sentence", "Sentence", "Text"),
        "label_columns": ("output", "label", "sentiment", "Sentiment"),
    },
    "multilingual": {
        "text_columns": ("sentence", "text", "Sentence", "Text"),
        "label_columns": ("label", "sentiment", "Sentiment"),
        "language_columns": ("language", "lang"),
    },
    "polarity": {
        "text_columns": ("text", "sentence", "Sentence", "Text", "headline", "content"),
        "label_columns": ("polarity", "label", "sentiment", "Sentiment"),
    },
    "capitalised": {
        "text_columns": ("Sentence", "sentence", "text", "Text", "headline", "news", "content"),
        "label_columns": ("Sentiment", "sentiment", "label", "Label"),
    },
    "generic": {
        "text_columns": ("text", "sentence", "Sentence", "input", "headline", "title", "content"),
        "label_columns": ("label", "sentiment", "Sentiment", "output", "polarity", "target"),
    },
}


def source_spec(shape: str, key: str, dataset_id: str, source_platform: str, **options) -> SourceSpec:
    options.setdefault("dataset_label", key)
    return SourceSpec(
        key=key, dataset_id=dataset_id, source_platform=source_platform, **{**SHAPES[shape], **options}
    )


def language_filter(
    df: DataFrame, columns: tuple[str, ...] = ("language", "lang"), languages: tuple[str, ...] = ("en", "english"),
    strict: bool = False,
) -> DataFrame:
    """Keep the wanted languages; a source without a language column passes unchanged.

    Strict mode compares the bare column with the first language, which Parquet can use to skip row groups.
    """
    found = find_column(df.columns, columns, ignore_case=not strict)
    if found is None:
        return df
    if strict:
        return df.where(F.col(found) == languages[0])
    return df.where(F.lower(F.col(found).cast("string")).isin(*languages))


def standardize(
    df: DataFrame, spec: SourceSpec, split: str | Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Canonical columns of one source, in one projection; ``keep`` carries row keys along."""
    if spec.language_columns:
        df = language_filter(df, spec.language_columns, spec.languages, spec.strict_language)
    text = resolve_column(df, spec.text_columns, ignore_case=True, required=True)
    label = resolve_column(df, spec.label_columns, ignore_case=True, required=True)
    if spec.class_names:
        label = label_index_to_name(label, spec.class_names)
    if split is None:
        split = spec.default_split
    rows = df.select(
        *keep,
        F.lit(spec.dataset_id).alias("dataset_id"),
        F.lit(spec.dataset_label).alias("dataset_label"),
        F.lit(spec.source_platform).alias("source_platform"),
        (F.lit(split) if isinstance(split, str) else split).alias("split"),
        text.alias("text"),
        normalize_label(label, spec.label_profile).alias("label_normalized"),
    )
    return with_clean_text(rows, spec.cleaner).select(*keep, *CANONICAL.fieldNames())


def canonical_valid(df: DataFrame, labels: tuple[str, ...] | None = None) -> DataFrame:
    """Text present and not blank, label present and, if asked, in the domain."""
    df = df.where(F.col("text").isNotNull() & (F.length(F.trim("text")) > 0) & F.col("label_normalized").isNotNull())
    return df.where(F.col("label_normalized").isin(*labels)) if labels else df


def canonical_columns(df: DataFrame) -> DataFrame:
    return df.select(*CANONICAL.fieldNames())
