"""Deduplication with a defined survivor, and duplicate flags that survive hot texts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertone.operators.bloom import FILTER_BYTES, bloom_filter, bloom_passed
from ledgertone.session import BROADCAST_ROWS, cut_lineage, small_side


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by a total order.

    ``row_number() = 1`` plans a partial WindowGroupLimit: every task sends at most one row per key
    into the shuffle, so a key holding a third of the rows costs no more than any other.
    """
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def known_keys(
    batch: DataFrame, existing: DataFrame, key: str, max_rows: int = BROADCAST_ROWS, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """The batch's keys that the table holds, checkpointed. The table is read where it lies and never shuffled.

    A batch of few keys is broadcast to the scan. Of a larger one a Bloom filter goes there, and only keys that pass it
    move, to be compared with the batch's. The filter has at most ``filter_bytes``; the more keys a batch has beyond
    an eighth of its bits, the more rows pass, and the comparison keeps the result exact.
    """
    keys = cut_lineage(batch.select(key).where(F.col(key).isNotNull()).distinct())
    count = keys.count()
    if count == 0:
        return keys
    if count <= max_rows:
        return cut_lineage(existing.select(key).join(small_side(keys), key, "left_semi").distinct())
    passed = bloom_passed(existing.select(key), key, bloom_filter(keys, key, count, filter_bytes))
    return cut_lineage(passed.join(keys, key, "left_semi").distinct())


def new_rows(batch: DataFrame, existing: DataFrame, key: str = "source_record_hash") -> DataFrame:
    """Rows whose key the table does not hold yet, and those without a key. What the table grows by later does not
    change the result; the batch is read twice."""
    return batch.join(known_keys(batch, existing, key), key, "left_anti")


def duplicate_flags(
    df: DataFrame, key: Sequence[str], dataset: str = "dataset_label", text: str = "text"
) -> DataFrame:
    """Flags every row but the first of its lower-cased text, within its dataset and overall.

    ``key`` must be unique. The first key per text comes from aggregations that combine map-side, so a hot text ships
    a row per task. The rows meet it in a join without further grouping, where a text with very many rows can be
    split over tasks.
    """
    rows = df.withColumn("_text", F.coalesce(F.sha2(F.lower(F.col(text)), 256), F.lit("")))
    order = F.struct(*key)
    local = rows.groupBy("_text", dataset).agg(F.min(order).alias("_first_here"))
    overall = local.groupBy("_text").agg(F.min("_first_here").alias("_first"))
    first = local.join(overall, "_text").select(
        F.col("_text").alias("_t"), F.col(dataset).alias("_d"), "_first_here", "_first"
    )
    met = rows.join(
        first, (F.col("_text") == F.col("_t")) & F.col(dataset).eqNullSafe(F.col("_d")), "left"
    )
    return met.withColumns(
        {"duplicate_within_dataset": order != F.col("_first_here"), "duplicate_global": order != F.col("_first")}
    ).drop("_text", "_t", "_d", "_first_here", "_first")
