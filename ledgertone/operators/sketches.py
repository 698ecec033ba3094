"""Quantiles of lengths from sketches that are stored and merged, so that older rows need not be read again.

A sketch is a KLL sketch, a binary column beside exact row counts and extremes. With parameter ``k`` a quantile's rank is
off by at most ``rank_error(k)`` (a share of all rows) with 99 % confidence, however many sketches were merged; up to about
``k`` rows it is exact. Nulls are not counted. Which rows a sketch keeps is drawn at random, so results within the error
may differ from run to run; where they must not, the exact reports are there.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 200


def rank_error(k: int = K) -> float:
    """Normalized rank error of a quantile, as the sketch's library states it."""
    return 2.296 / k**0.9723


def length_sketches(df: DataFrame, value: str, by: Sequence[str], k: int = K) -> DataFrame:
    """One row per group: rows, low, high, sketch. Each task sends one sketch per group."""
    return df.groupBy(*by).agg(
        F.count(value).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("sketch"),
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of several dates or datasets as one per group; only sketches are read."""
    return sketches.where("rows > 0").groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )


def sketch_quantiles(sketches: DataFrame, fractions: Sequence[float] = (0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Replaces the sketch by a column for each fraction, ``p25`` for 0.25."""
    quantiles = [
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(f))).alias(f"p{f * 100:g}".replace(".", "_"))
        for f in fractions
    ]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *quantiles)
