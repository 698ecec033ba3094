"""Splits, samples and caps."""

from pyspark.sql import functions as F

from ledgertone.operators import dedup as D
from ledgertone.operators import splits as P
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.registry import query
from ledgertone.schemas import LABELS
from ledgertone.session import stage
from ledgertone.sources.specs import canonical_valid

_CUT = """CASE WHEN rk <= n - 2 * CAST(round(n * 0.2) AS BIGINT) THEN 'train'
  WHEN rk <= n - CAST(round(n * 0.2) AS BIGINT) THEN 'validation' ELSE 'test' END"""
_ORDER = """CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 WHEN 'test' THEN 2 ELSE 3 END,
  coalesce(split, ''), record_seq"""
_IN_DOMAIN = "label_normalized IN ('negative', 'neutral', 'positive')"


def _rows(spark, sf_dir):
    """The canonical table as a table: finding the cuts reads its key columns several times."""
    rows = canonical_valid(I.canonical_records(spark, sf_dir)).select(
        "record_seq", "dataset_label", "split", "text", "label_normalized"
    )
    return stage(rows, "canonical")


@query(
    "duplicate_flags",
    f"""WITH {Q.FEATURES} SELECT record_seq, dataset_label, duplicate_within_dataset, duplicate_global FROM features""",
)
def duplicate_flags(spark, sf_dir):
    from ledgertone.operators.medallion import fill_defaults

    rows = fill_defaults(I.canonical_records(spark, sf_dir)).select("record_seq", "dataset_label", "text")
    return D.duplicate_flags(rows, ["record_seq"]).drop("text")


@query(
    "sequential_split",
    f"""WITH {Q.VALID} SELECT record_seq, dataset_label, {_CUT} AS split FROM (SELECT *,
      row_number() OVER (PARTITION BY dataset_label ORDER BY {_ORDER}) AS rk,
      count(*) OVER (PARTITION BY dataset_label) AS n FROM valid)""",
)
def sequential_split(spark, sf_dir):
    return P.sequential_split(_rows(spark, sf_dir), ["record_seq"]).select("record_seq", "dataset_label", "split")


@query(
    "shuffled_split",
    f"""WITH {Q.VALID} SELECT record_seq, dataset_label, {_CUT} AS split FROM (SELECT *,
      row_number() OVER (PARTITION BY dataset_label ORDER BY {Q.seeded(42, 'record_seq')}) AS rk,
      count(*) OVER (PARTITION BY dataset_label) AS n FROM valid)""",
)
def shuffled_split(spark, sf_dir):
    return P.shuffled_split(_rows(spark, sf_dir), "record_seq").select("record_seq", "dataset_label", "split")


@query(
    "stratified_split",
    f"""WITH {Q.VALID}, counts AS (SELECT label_normalized, count(*) AS c FROM valid WHERE {_IN_DOMAIN} GROUP BY 1),
    sizes AS (SELECT sum(c) AS total, count(*) > 1 AND min(c) >= 3 AS strat FROM counts),
    grouped AS (SELECT v.*, s.total, CASE WHEN s.strat THEN label_normalized ELSE '*' END AS g
      FROM valid v, sizes s WHERE {_IN_DOMAIN})
    SELECT record_seq, label_normalized, CASE WHEN total < 20 THEN 'train' ELSE {_CUT} END AS split FROM (SELECT *,
      row_number() OVER (PARTITION BY g ORDER BY {Q.seeded(42, 'record_seq')}) AS rk,
      count(*) OVER (PARTITION BY g) AS n FROM grouped)""",
)
def stratified_split(spark, sf_dir):
    rows = P.stratified_split(_rows(spark, sf_dir), "record_seq", min_rows=20, min_per_class=3)
    return rows.select("record_seq", "label_normalized", "split")


@query(
    "stratified_sample",
    f"""WITH {Q.VALID} SELECT record_seq, label_normalized, text FROM (SELECT *, row_number() OVER (
      PARTITION BY label_normalized ORDER BY {Q.seeded(42, 'record_seq')}) AS rk FROM valid WHERE {_IN_DOMAIN})
    WHERE rk <= 75""",
)
def stratified_sample(spark, sf_dir):
    rows = _rows(spark, sf_dir).where(F.col("label_normalized").isin(*LABELS))
    return P.stratified_sample(rows, 75, "record_seq").select("record_seq", "label_normalized", "text")


@query(
    "cap_split_rows",
    f"""WITH {Q.VALID} SELECT record_seq, split FROM (SELECT *, row_number() OVER (
      PARTITION BY split ORDER BY {Q.seeded(42, 'record_seq')}) AS rk FROM valid)
    WHERE split IS NULL OR split <> 'train' OR rk <= 100""",
)
def cap_split_rows(spark, sf_dir):
    return P.cap_split_rows(_rows(spark, sf_dir), "train", 100, "record_seq").select("record_seq", "split")


@query(
    "cap_split_rows_large",
    f"""WITH {Q.RAW} SELECT record_seq, split FROM (SELECT *, row_number() OVER (
      PARTITION BY split ORDER BY {Q.seeded(7, 'record_seq')}) AS rk, count(*) OVER (PARTITION BY split) AS n
      FROM raw_records)
    WHERE split IS NULL OR split <> 'train' OR rk <= 400""",
)
def cap_split_rows_large(spark, sf_dir):
    """A cap of some hundred rows, below what the split holds."""
    rows = I.raw_records(spark, sf_dir).select("record_seq", "split")
    return P.cap_split_rows(rows, "train", 400, "record_seq", seed=7)


@query(
    "distributed_rank",
    f"""WITH {Q.RAW} SELECT record_seq, dataset_label,
      row_number() OVER (PARTITION BY dataset_label ORDER BY label NULLS FIRST, record_seq) AS rank FROM raw_records""",
)
def distributed_rank(spark, sf_dir):
    rows = I.raw_records(spark, sf_dir).select("dataset_label", "label", "record_seq")
    return P.distributed_rank(rows, ["label", "record_seq"], ["dataset_label"]).drop("label")
