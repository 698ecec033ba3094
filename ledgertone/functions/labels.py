"""Label and split normalisation, label ids, class probabilities."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgertone.functions.text import strip_ws
from ledgertone.schemas import LABEL_IDS, LABELS

# Accepted spellings per label. The profiles differ on purpose: "signed" reads 1/0/-1,
# "ordinal" reads 0/1/2 as class numbers, "words" has no numbers, "silver" only the short forms.
ALIAS_PROFILES = {
    "words": {
        "positive": ("positive", "mildly positive", "moderately positive", "strong positive"),
        "negative": ("negative", "mildly negative", "moderately negative", "strong negative"),
        "neutral": ("neutral",),
    },
    "signed": {
        "positive": (
            "positive", "mildly positive", "moderately positive", "strong positive", "bullish", "pos", "positivo",
            "1",
        ),
        "negative": (
            "negative", "mildly negative", "moderately negative", "strong negative", "bearish", "neg", "negativo",
            "-1",
        ),
        "neutral": ("neutral", "neu", "neutro", "0"),
    },
    "ordinal": {
        "positive": (
            "positive", "pos", "bullish", "mildly positive", "moderately positive", "strong positive", "2",
        ),
        "negative": (
            "negative", "neg", "bearish", "mildly negative", "moderately negative", "strong negative", "0",
        ),
        "neutral": ("neutral", "neu", "1"),
    },
    "silver": {
        "positive": ("positive", "pos", "1", "bullish"),
        "negative": ("negative", "neg", "-1", "bearish"),
        "neutral": ("neutral", "neu", "0"),
    },
}

# Source split names per canonical split.
SPLIT_ALIASES = {
    "train": ("train", "training"),
    "validation": ("validation", "valid", "val"),
    "test": ("test", "testing"),
}


def _by_alias(value: Column, aliases: dict[str, Sequence[str]]) -> Column:
    chain = F
    for name, spellings in aliases.items():
        chain = chain.when(value.isin(*spellings), F.lit(name))
    return chain


def normalize_label(c: Column, profile: str = "signed", unknown: str = "pass") -> Column:
    """Canonical label; an unknown spelling passes through lower-cased, or becomes null."""
    # The silver rule trims blanks only, the others any whitespace.
    value = F.lower(F.trim(c)) if profile == "silver" else F.lower(strip_ws(c))
    known = _by_alias(value, ALIAS_PROFILES[profile])
    return known.otherwise(value) if unknown == "pass" else known


def label_index_to_name(c: Column, names: Sequence[str] | Column) -> Column:
    """Class number to class name; anything out of range stays as it is."""
    listed = names if isinstance(names, Column) else F.array(*[F.lit(n) for n in names])
    raw = c.cast("string")
    index = raw.try_cast("int")
    return F.coalesce(F.when(index >= 0, F.get(listed, index)), raw)


def label_id(c: Column) -> Column:
    chain = F
    for name, number in LABEL_IDS.items():
        chain = chain.when(c == name, F.lit(number))
    return chain.cast("int")


def source_split(c: Column) -> Column:
    """Canonical split for a known source split name, else null."""
    return _by_alias(c, SPLIT_ALIASES)


def split_from_bucket(bucket: Column) -> Column:
    """70/15/15 by hash bucket 0..99."""
    return F.when(bucket < 70, "train").when(bucket < 85, "validation").otherwise("test")


def in_domain(c: Column, domain: Sequence[str] = LABELS) -> Column:
    """Two-valued membership: null is not a member."""
    return F.coalesce(c.isin(*domain), F.lit(False))


def domain_bit(c: Column, domain: Sequence[str]) -> Column:
    """One bit per domain value, so that bit_or collects the distinct values seen in a group."""
    chain = F
    for position, value in enumerate(domain):
        chain = chain.when(c == value, F.lit(1 << position))
    return chain.otherwise(F.lit(0))


def bits_to_names(bits: Column, domain: Sequence[str]) -> Column:
    """Sorted, comma-joined domain values of a bit set."""
    listed = sorted(range(len(domain)), key=lambda i: domain[i])
    return F.concat_ws(
        ", ", *[F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(domain[i])) for i in listed]
    )


def canonical_prediction(probabilities: Column) -> Column:
    """Class probabilities (map) in canonical order: missing class 0, first of equals wins."""
    scores = {name: F.coalesce(probabilities[name], F.lit(0.0)) for name in LABELS}
    score = F.greatest(*scores.values())
    label = F
    for name, value in scores.items():
        label = label.when(value == score, F.lit(name))
    ordered = F.create_map(*[part for name, value in scores.items() for part in (F.lit(name), value)])
    return F.struct(label.alias("label"), score.alias("score"), ordered.alias("probabilities"))


def remap_label_ids(c: Column, model_label_order: Sequence[str], to_model: bool = False) -> Column:
    """Model class numbers to canonical label ids, or back."""
    chain = F
    for model_id, name in enumerate(model_label_order):
        canonical = LABEL_IDS[name]
        source, target = (canonical, model_id) if to_model else (model_id, canonical)
        chain = chain.when(c == source, F.lit(target))
    return chain
