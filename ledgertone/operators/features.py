"""Vocabulary, encoded sequences, TF-IDF weights and the trainable baseline."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StringIndexerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgertone.operators.evaluation import class_weights
from ledgertone.operators.terms import grams, slices, top_grams
from ledgertone.schemas import LABELS
from ledgertone.session import BROADCAST_BYTES, BROADCAST_ROWS, computed_once, cut_lineage, stage

# Characters a sequence tokenizer turns into blanks, and the term pattern of the vectorizer.
SEQUENCE_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"


def sequence_tokens(c: Column) -> Column:
    cleaned = F.translate(F.lower(c), SEQUENCE_FILTERS, " " * len(SEQUENCE_FILTERS))
    return F.filter(F.split(cleaned, " "), lambda t: t != "")


def build_vocabulary(df: DataFrame, size: int, text: str = "text") -> DataFrame:
    """Token to index 1..size-1 by falling frequency; index 0 is padding.

    Only tokens that can be frequent enough are counted over all texts (``top_grams``); at most ``size`` rows are
    numbered.
    """
    top = top_grams(df, sequence_tokens(F.col(text)), size - 1).select("term", F.col("total").alias("frequency"))
    top = top.withColumnRenamed("term", "token")
    order = [F.col("frequency").desc(), F.col("token")]
    return top.withColumn("index", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)))


def encode_sequences(
    df: DataFrame, vocabulary: DataFrame, key: str, length: int, text: str = "text"
) -> DataFrame:
    """Key and vocabulary ids of each text in order, unknown tokens dropped, cut or padded at the end.

    A vocabulary that proves to be small goes to the tasks, which look tokens up in Arrow batches: no shuffle. A
    larger one is joined.
    """
    kept = cut_lineage(vocabulary.select("token", "index"))
    rows, size = kept.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("token") + 8), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        return _encode_by_lookup(df, kept, key, length, text)
    return _encode_by_join(df, kept, key, length, text)


def _encode_by_lookup(df: DataFrame, vocabulary: DataFrame, key: str, length: int, text: str) -> DataFrame:
    known = vocabulary.toArrow()
    names, numbers = known.column("token").combine_chunks(), known.column("index").combine_chunks().cast(pa.int32())

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def look_up(tokens: pa.Array) -> pa.Array:
        flat = tokens.flatten().cast(names.type)
        found = pc.index_in(flat, value_set=names)
        ids = np.append(numbers.to_numpy(), 0).astype(np.int32)[pc.fill_null(found, -1).to_numpy()]
        owner = np.repeat(np.arange(len(tokens)), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy())
        good = pc.is_valid(found).to_numpy(zero_copy_only=False)
        owner, ids = owner[good], ids[good]
        counts = np.bincount(owner, minlength=len(tokens))
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        inside = place < length
        out = np.zeros(len(tokens) * length, np.int32)
        out[owner[inside] * length + place[inside]] = ids[inside]
        offsets = np.arange(0, len(out) + 1, length, dtype=np.int32) if length else np.zeros(len(tokens) + 1, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out))

    tokens = F.coalesce(sequence_tokens(F.col(text)), F.array().cast("array<string>"))
    return df.select(key, look_up(tokens).alias("sequence"))


def _encode_by_join(df: DataFrame, vocabulary: DataFrame, key: str, length: int, text: str) -> DataFrame:
    """A text's tokens start in one task, so the collecting aggregation packs them up again before the shuffle;
    texts without a known token stay through the outer explode and join."""
    tokens = df.select(key, F.posexplode_outer(sequence_tokens(F.col(text))).alias("pos", "token"))
    known = tokens.join(vocabulary, "token", "left")
    found = F.collect_list(F.when(F.col("index").isNotNull(), F.struct("pos", "index")))
    packed = known.groupBy(key).agg(F.array_sort(found).alias("_found"))
    ids = packed.select(key, F.slice(F.col("_found.index"), 1, length).alias("_ids"))
    return ids.select(key, F.concat("_ids", F.array_repeat(F.lit(0), F.lit(length) - F.size("_ids"))).alias("sequence"))


def term_words(c: Column) -> Column:
    """Lower-case words of two or more characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(TERM_PATTERN), F.lit(0))


def _terms_of(words: Column) -> Column:
    """The words, and the pairs of neighbours."""
    zipped = F.arrays_zip(F.slice(words, 1, F.size(words) - 1).alias("a"), F.slice(words, 2, F.size(words)).alias("b"))
    pairs = F.when(F.size(words) > 1, F.transform(zipped, lambda p: F.concat_ws(" ", p["a"], p["b"])))
    return F.concat(words, F.coalesce(pairs, F.array().cast("array<string>")))


def with_terms(df: DataFrame, text: str = "text_clean") -> DataFrame:
    """Adds ``terms``: the words and pairs. The words are found once per text; the pairs refer to them several times."""
    found = computed_once(df, _words=term_words(F.col(text)))
    return computed_once(found, terms=_terms_of(F.col("_words"))).drop("_words")


def term_counts(df: DataFrame, key: str, text: str = "text_clean") -> DataFrame:
    """(key, term, tf), partitioned by key. The texts are partitioned while they are still text, so that counting and
    what follows per document needs no further shuffle; the counts are kept, since several steps read them."""
    terms = with_terms(df.select(key, text).repartition(key), text).select(key, F.explode("terms").alias("term"))
    return cut_lineage(terms.groupBy(key, "term").agg(F.count("*").alias("tf")))


def top_terms(df: DataFrame, max_features: int, text: str = "text_clean") -> DataFrame:
    """(term, total, df): the ``max_features`` most frequent words and pairs; equally frequent ones by name."""
    return top_grams(df, term_words(F.col(text)), max_features, orders=2)


def tfidf_weights(df: DataFrame, key: str, max_features: int, text: str = "text_clean") -> DataFrame:
    """Smoothed TF-IDF over the most frequent 1- and 2-grams, each document at unit length.

    A feature table that proves to be small goes to the tasks; then each document is counted, weighted and scaled where
    it is read, and neither texts nor terms are shuffled. With a larger one the counted terms are joined (``key`` must
    then be unique).
    """
    features = cut_lineage(top_terms(df, max_features, text).select("term", "df"))
    documents = df.count()
    rows, size = features.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        return _weights_by_lookup(df, key, features.toArrow(), documents, text)
    return _weights_by_join(df, key, features, documents, text)


def _weights_by_lookup(df: DataFrame, key: str, features: pa.Table, documents: int, text: str) -> DataFrame:
    vocabulary = features.column("term").combine_chunks().cast(pa.string())
    frequency = features.column("df").to_numpy()
    scale = np.log((1 + documents) / (1 + frequency)) + 1
    lists = df.select(key, term_words(F.col(text)).alias("words"))
    schema = T.StructType([
        df.schema[key], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType()),
        T.StructField("df", T.LongType()), T.StructField("weight", T.DoubleType()),
    ])

    def weigh(batches):
        fields = to_arrow_schema(schema)
        for batch in slices(batches):
            terms, owner, index = grams(batch.column(1), 2)
            place = pc.fill_null(pc.index_in(terms.cast(pa.string()), value_set=vocabulary), -1).to_numpy()[index]
            owner, place = owner[place >= 0], place[place >= 0]
            cell, tf = np.unique(owner * max(len(vocabulary), 1) + place, return_counts=True)
            owner, place = np.divmod(cell, max(len(vocabulary), 1))
            raw = tf * scale[place]
            norm = np.sqrt(np.bincount(owner, raw * raw, len(batch)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(owner)).cast(fields.field(0).type), vocabulary.take(pa.array(place)),
                pa.array(tf), pa.array(frequency[place]), pa.array(raw / norm[owner]),
            ], schema=fields)

    return lists.mapInArrow(weigh, schema)


def _weights_by_join(df: DataFrame, key: str, features: DataFrame, documents: int, text: str) -> DataFrame:
    weighted = term_counts(df, key, text).join(features, "term").withColumn(
        "_raw", F.col("tf") * (F.log((1 + documents) / (1 + F.col("df"))) + 1)
    )
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(W.partitionBy(key)))
    return weighted.withColumn("weight", F.col("_raw") / norm).drop("_raw")


def tfidf_features(train: DataFrame, max_features: int, text: str = "text_clean") -> PipelineModel:
    """The stages from ``terms`` to unit-length weights, with the vocabulary of ``tfidf_weights`` in its order.

    Spark's IDF lacks the "+1" of the smoothed weight, so counts are scaled by factors made from document frequencies.
    """
    top = top_terms(train, max_features, text).select("term", "df").collect()  # at most max_features terms
    documents = train.count()
    factors = [float(np.log((1 + documents) / (1 + r["df"]))) + 1 for r in top]
    return PipelineModel([
        CountVectorizerModel.from_vocabulary([r["term"] for r in top], inputCol="terms", outputCol="tf"),
        ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol="tf", outputCol="tfidf"),
        Normalizer(inputCol="tfidf", outputCol="features"),
    ])


def tfidf_logreg_fit(
    train: DataFrame, max_features: int, text: str = "text_clean", label: str = "label_normalized",
    max_iter: int = 500, tol: float = 1e-4,
) -> PipelineModel:
    """TF-IDF with balanced multinomial logistic regression.

    The balanced weights sum to the row count, which makes a ridge penalty of 1/n equal a unit inverse penalty on summed
    losses. Words are found once: what follows reads them from a staged copy.
    """
    words = F.array_join(term_words(F.col(text)), " ").alias(text)
    train = stage(train.where(F.col(label).isin(*LABELS)).select(label, words), "words")
    features = tfidf_features(train, max_features, text)
    weights = class_weights(train, label).select(label, "weight")  # at most one row per label
    labels = StringIndexerModel.from_labels(list(LABELS), inputCol=label, outputCol="label_id", handleInvalid="error")
    rows = labels.transform(with_terms(train.join(F.broadcast(weights), label), text))
    prepared = features.transform(rows).select("label_id", "weight", "features").cache()
    try:
        fitted = LogisticRegression(
            labelCol="label_id", featuresCol="features", weightCol="weight", family="multinomial",
            maxIter=max_iter, tol=tol, regParam=1.0 / max(prepared.count(), 1), elasticNetParam=0.0, standardization=False,
        ).fit(prepared)
    finally:
        prepared.unpersist()
    return PipelineModel([*features.stages, fitted])


def logreg_predict(model: PipelineModel, df: DataFrame, text: str = "text_clean") -> DataFrame:
    """Prediction and score (highest class probability) per row."""
    from pyspark.ml.functions import vector_to_array

    kept = df.columns
    scored = model.transform(with_terms(df, text))
    names = F.array(*[F.lit(n) for n in LABELS])
    return scored.select(
        *kept,
        F.get(names, F.col("prediction").cast("int")).alias("prediction"),
        F.array_max(vector_to_array("probability")).alias("score"),
    )
