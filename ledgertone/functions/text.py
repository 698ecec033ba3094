"""Text cleaners, hashes and length features as Column expressions."""

import html
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertone.session import computed_once

# The characters Python's str.strip and str.split treat as whitespace.
PY_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_BLANKS = " " * len(PY_SPACES)
_ENTITY = r"&[#a-zA-Z]"
# The characters silver text keeps, after lower-casing. Written out one by one: Java matches a
# class of single Latin-1 characters by bit set, and is some ten times slower once it holds two ranges.
_NOT_KEPT_IN_SILVER = r"[^abcdefghijklmnopqrstuvwxyz0123456789áéíóúñü$%.,;:!?\- ]"
# Marks a character that folds to several letters while others fold to one.
_SEVERAL = "\ue000"
_URL = r"https?://\S+|www\.\S+"


def strip_ws(c: Column) -> Column:
    """Python's str.strip; Spark's trim removes blanks only."""
    return F.btrim(c, F.lit(PY_SPACES))


def _blank_ws(c: Column) -> Column:
    return F.translate(c, PY_SPACES, _BLANKS)


def collapse_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(_blank_ws(c), " +", " "))


def word_list(c: Column) -> Column:
    """Python's str.split(): the non-empty runs between whitespace."""
    return F.filter(F.split(_blank_ws(c), " "), lambda w: w != "")


def _fold(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """NFKD-to-ASCII by rule: each character that folds to ASCII, and its target. Characters folding to
    several letters (ligatures, fractions) get a mark instead and go the Python way."""
    characters, targets = [], []
    for code in range(0x80, sys.maxunicode + 1):
        # Without a decomposition a character stays itself and is dropped.
        folded = _fold(chr(code)) if unicodedata.decomposition(chr(code)) else ""
        if folded:
            characters.append(chr(code))
            targets.append(folded if len(folded) == 1 else _SEVERAL)
    return "".join(characters), "".join(targets)


def _python_ascii(c: Column) -> Column:
    @F.arrow_udf(T.StringType())
    def unescape_and_fold(values: pa.Array) -> pa.Array:
        def convert(value: str | None) -> str | None:
            if value is None:
                return None
            folded = unicodedata.normalize("NFKD", html.unescape(value))
            return folded.encode("ascii", "ignore").decode("ascii")

        return pa.array([convert(v) for v in values.to_pylist()], type=pa.string())

    return unescape_and_fold(c)


def _folded(c: Column) -> Column:
    """Each character that folds to one ASCII letter folded, those that fold to several marked."""
    return F.translate(c, *_fold_table())


def to_ascii(c: Column, entities: bool = True, folded: Column | None = None) -> Column:
    """HTML-unescape, then NFKD to ASCII with everything else dropped.

    Plain ASCII and Latin text stays in the JVM. Only values that hold an entity or a character
    folding to several letters are sent to Python; the Arrow batch carries nulls for the rest.
    With ``entities=False`` (text known to hold none) nothing leaves the JVM unless it must.
    The folded text is needed on both sides of the Python node: ``with_clean_text`` makes it once and passes it in.
    """
    is_ascii = F.octet_length(c) == F.length(c)
    folded = _folded(c) if folded is None else folded
    native = F.when(is_ascii, c).otherwise(F.regexp_replace(folded, r"[^\x00-\x7F]+", ""))
    hard = ~is_ascii & F.contains(folded, F.lit(_SEVERAL))
    if entities:
        hard = c.rlike(_ENTITY) | hard
    return F.coalesce(_python_ascii(F.when(hard, c)), native)


def clean_ascii_letters(
    c: Column, empty_to_null: bool = True, entities: bool = True, folded: Column | None = None
) -> Column:
    """Lower-case ASCII words separated by single blanks.

    Non-letters become blanks and blanks collapse, which one pattern does in one pass.
    """
    words = F.btrim(F.regexp_replace(F.lower(to_ascii(c, entities, folded)), "[^a-z]+", " "))
    return F.nullif(words, F.lit("")) if empty_to_null else words


def clean_ascii_light(c: Column, entities: bool = True, folded: Column | None = None) -> Column:
    """ASCII text with collapsed whitespace; digits, punctuation and case stay."""
    return collapse_ws(to_ascii(c, entities, folded))


def clean_silver(c: Column) -> Column:
    """Lower case, no URLs, Spanish letters, digits and basic punctuation kept."""
    text = F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))
    text = F.regexp_replace(F.regexp_replace(text, _URL, ""), _NOT_KEPT_IN_SILVER, "")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def clean_v1(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")


CLEANERS = {
    "letters": clean_ascii_letters,
    "light": clean_ascii_light,
    "silver": clean_silver,
    "v1": clean_v1,
}


def with_clean_text(df: DataFrame, cleaner: str, text: str = "text", target: str | None = None) -> DataFrame:
    """Adds or replaces ``target`` (default: the text itself) by the cleaned text; what is costly runs once a row."""
    target = target or text
    if cleaner not in ("letters", "light"):
        return computed_once(df, **{target: CLEANERS[cleaner](F.col(text))})
    ascii_only = F.octet_length(text) == F.length(text)
    rows = computed_once(df, _folded=F.when(~ascii_only, _folded(F.col(text))))
    cleaned = CLEANERS[cleaner](F.col(text), folded=F.col("_folded"))
    return computed_once(rows, **{target: cleaned}).drop("_folded")


def record_hash(*columns: str | Column) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.sha2(F.concat_ws("||", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def text_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def seeded_hash(seed: int | str, key: str | Column) -> Column:
    """Uniform, engine-independent order for splits and samples."""
    key = F.col(key) if isinstance(key, str) else key
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), key.cast("string")), 256)


def hash_bucket(hashed: Column, buckets: int = 100) -> Column:
    return F.pmod(F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def char_count(c: Column) -> Column:
    return F.length(c)


def word_count(c: Column) -> Column:
    return F.size(word_list(c))


def safe_key(c: Column) -> Column:
    """Dataset key safe for paths: other characters become underscores, none at the ends."""
    return F.lower(F.btrim(F.regexp_replace(c, "[^a-zA-Z0-9_]+", "_"), F.lit("_")))


def np_round(c: Column, digits: int) -> Column:
    """numpy's round: scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)
