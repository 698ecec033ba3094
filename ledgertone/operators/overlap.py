"""What datasets share: texts held by several of them, and the terms each one uses most."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_overlap(df: DataFrame, dataset: str = "dataset_label", text_hash: str = "text_hash") -> DataFrame:
    """(dataset_a, dataset_b, shared_texts): how many distinct texts each pair of datasets has in common, a < b.

    Each text is reduced to the set of its datasets, and each distinct set is counted once; pairs are made from sets, not
    by joining rows of one text with each other. A text with a third of all rows is one row a task and dataset. Rows
    without a dataset or hash are left out. A set is as large as the number of datasets.
    """
    held = df.where(F.col(dataset).isNotNull() & F.col(text_hash).isNotNull()).select(dataset, text_hash).distinct()
    sets = held.groupBy(text_hash).agg(F.array_sort(F.collect_set(dataset)).alias("names")).where(F.size("names") > 1)
    counted = sets.groupBy("names").agg(F.count("*").alias("n"))
    firsts = F.sequence(F.lit(1), F.size("names") - 1)
    pairs = F.flatten(F.transform(firsts, lambda i: F.transform(
        F.slice("names", i + 1, F.size("names")), lambda b: F.struct(F.get("names", i - 1).alias("a"), b.alias("b")))))
    return counted.select("n", F.explode(pairs).alias("pair")).groupBy(
        F.col("pair.a").alias("dataset_a"), F.col("pair.b").alias("dataset_b")
    ).agg(F.sum("n").alias("shared_texts"))


def overlap_shares(overlap: DataFrame, df: DataFrame, dataset: str = "dataset_label", text_hash: str = "text_hash"):
    """The overlap with the number of distinct texts of both datasets, and the share of the smaller one that is shared."""
    held = df.where(F.col(dataset).isNotNull() & F.col(text_hash).isNotNull()).select(dataset, text_hash).distinct()
    sizes = held.groupBy(dataset).agg(F.count("*").alias("texts"))  # a row per dataset
    a = sizes.select(F.col(dataset).alias("dataset_a"), F.col("texts").alias("texts_a"))
    b = sizes.select(F.col(dataset).alias("dataset_b"), F.col("texts").alias("texts_b"))
    return overlap.join(a, "dataset_a").join(b, "dataset_b").withColumn(
        "shared_share", F.bround(F.col("shared_texts") / F.least("texts_a", "texts_b"), 6)
    )
