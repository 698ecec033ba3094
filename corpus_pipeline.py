"""From documents to token sequences: quality rules, line dedup, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. ``run``
writes each result as Parquet under the shared folder and reads it again for the next stage. What a stage staged on the
way is removed when its result is written, and a result when the next one is.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertone.llm.jaccard_join import one_of_each
from ledgertone.llm.line_dedup import line_dedup
from ledgertone.llm.packing import pack
from ledgertone.llm.quality_rules import cleaned
from ledgertone.llm.secret_scan import redacted
from ledgertone.session import remove_path, scratch_path, scratch_scope

END_ID = 1


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go, then documents that fail the base rule or lost too much."""
    return _counted(cleaned(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; a document of which no word is left is a copy throughout and goes too. One that had no
    word before cannot come from the stage before, but would go as well."""
    return _counted(line_dedup(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return _counted(redacted(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality_rules", quality), ("line_dedup", lines), ("jaccard_join", near_duplicates), ("secret_scan", secrets),
    ("packing", sequences),
]

# The tokenizer cannot be expressed in SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            done = stage(spark, docs, sf_dir)
            done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
