"""Vocabulary, sequences, TF-IDF, model fit and scoring."""

from pyspark.sql import functions as F

from ledgertone.operators import evaluation as E
from ledgertone.operators import features as T
from ledgertone.operators import scoring as G
from ledgertone.operators.terms import top_grams
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.evaluation import metrics_table
from ledgertone.plans.catalog.medallion import gold
from ledgertone.plans.catalog.registry import query
from ledgertone.session import cut_lineage, stage

VOCABULARY_SIZE = 2_000
SEQUENCE_LENGTH = 64
MAX_FEATURES = 10_000
# The characters that become blanks, written out here so that a wrong list in the code shows.
_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'
_TOKENS = (
    f"list_filter(string_split(translate(lower(text), '{_FILTERS}', repeat(' ', {len(_FILTERS)})), ' '), "
    "lambda t: t <> '')"
)
_VOCABULARY = f"""vocabulary AS (SELECT token, frequency, CAST(row_number() OVER (ORDER BY frequency DESC, token)
    AS INTEGER) AS index FROM (SELECT token, count(*) AS frequency FROM
    (SELECT unnest({_TOKENS}) AS token FROM documents) GROUP BY token) QUALIFY index < {VOCABULARY_SIZE})"""


@query("build_vocabulary", f"WITH {_VOCABULARY} SELECT * FROM vocabulary")
def build_vocabulary(spark, sf_dir):
    return T.build_vocabulary(I.table(spark, sf_dir, "documents"), VOCABULARY_SIZE)


@query(
    "encode_sequences",
    f"""WITH {_VOCABULARY}, tokens AS (SELECT doc_id, unnest({_TOKENS}) AS token,
      generate_subscripts({_TOKENS}, 1) AS pos FROM documents),
    ids AS (SELECT doc_id, list(index ORDER BY pos) AS ids FROM tokens JOIN vocabulary USING (token) GROUP BY doc_id)
    SELECT doc_id, array_to_string(list_resize(coalesce(ids, []), {SEQUENCE_LENGTH}, 0), ' ') AS sequence
    FROM documents LEFT JOIN ids USING (doc_id)""",
)
def encode_sequences(spark, sf_dir):
    documents = I.table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = T.build_vocabulary(documents, VOCABULARY_SIZE)
    encoded = T.encode_sequences(documents, vocabulary, "doc_id", SEQUENCE_LENGTH)
    return encoded.select("doc_id", F.concat_ws(" ", F.col("sequence").cast("array<string>")).alias("sequence"))


_TERMS = "regexp_extract_all(lower(text_clean), '[\\p{L}\\p{N}_]{2,}')"


@query(
    "tfidf_weights",
    f"""WITH {Q.GOLD}, words AS (SELECT source_record_hash, {_TERMS} AS w FROM gold),
    terms AS (SELECT source_record_hash, unnest(list_concat(w, list_transform(range(1, len(w)),
      lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words),
    tf AS (SELECT source_record_hash, term, count(*) AS tf FROM terms GROUP BY ALL),
    feature AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term
      ORDER BY total DESC, term LIMIT 10000),
    raw AS (SELECT source_record_hash, term, tf, df,
      tf * (ln((1.0 + (SELECT count(*) FROM gold)) / (1.0 + df)) + 1) AS r FROM tf JOIN feature USING (term))
    SELECT source_record_hash, term, tf, df,
      round(r / sqrt(sum(r * r) OVER (PARTITION BY source_record_hash)), 6) AS weight FROM raw""",
)
def tfidf_weights(spark, sf_dir):
    weights = T.tfidf_weights(stage(gold(spark, sf_dir), "gold"), "source_record_hash", MAX_FEATURES)
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    "terms_by_dataset",
    f"""WITH {Q.GOLD}, words AS (SELECT source_dataset, source_record_hash, {_TERMS} AS w FROM gold),
    terms AS (SELECT source_dataset, source_record_hash, unnest(list_concat(w, list_transform(range(1, len(w)),
      lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words)
    SELECT source_dataset, term, count(*) AS total, count(DISTINCT source_record_hash) AS df FROM terms
    GROUP BY source_dataset, term QUALIFY row_number() OVER (PARTITION BY source_dataset ORDER BY total DESC, term) <= 50""",
)
def terms_by_dataset(spark, sf_dir):
    """The fifty most frequent words and pairs of each dataset."""
    words = T.term_words(F.col("text_clean"))
    return top_grams(stage(gold(spark, sf_dir), "gold"), words, 50, orders=2, by="source_dataset")


@query("tfidf_logreg_fit")
def tfidf_logreg_fit(spark, sf_dir):
    """Metrics of the fitted baseline on the held-out rows."""
    rows = stage(gold(spark, sf_dir), "gold")
    model = T.tfidf_logreg_fit(rows.where(F.col("split") == "train"), MAX_FEATURES)
    scored = T.logreg_predict(model, rows.where(F.col("split") != "train"))
    return E.classification_metrics(scored.withColumn("model_key", F.lit("tfidf_logreg")), ["model_key"])


@query(
    "tfidf_logreg_terms",
    f"""WITH {Q.GOLD}, words AS (SELECT source_record_hash, {_TERMS} AS w FROM gold WHERE split = 'train'),
    terms AS (SELECT source_record_hash, unnest(list_concat(w, list_transform(range(1, len(w)),
      lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words),
    feature AS (SELECT term, count(*) AS total, count(DISTINCT source_record_hash) AS df FROM terms GROUP BY term
      ORDER BY total DESC, term LIMIT {MAX_FEATURES})
    SELECT term, CAST(row_number() OVER (ORDER BY total DESC, term) - 1 AS BIGINT) AS place,
      round(ln((1.0 + (SELECT count(*) FROM words)) / (1.0 + df)) + 1, 9) AS scale FROM feature""",
)
def tfidf_logreg_terms(spark, sf_dir):
    """The model's vocabulary, in its order, with the factor that each count is scaled by."""
    rows = stage(gold(spark, sf_dir), "gold")
    model = T.tfidf_features(rows.where(F.col("split") == "train"), MAX_FEATURES)
    terms, factors = model.stages[0].vocabulary, model.stages[1].getScalingVec().toArray().tolist()
    return spark.createDataFrame(
        [(t, i, round(f, 9)) for i, (t, f) in enumerate(zip(terms, factors))], "term string, place bigint, scale double"
    )


@query(
    "tfidf_logreg_scored",
    f"WITH {Q.GOLD} SELECT split, label_normalized, count(*) AS rows, count(*) AS with_prediction, true AS in_range "
    "FROM gold GROUP BY split, label_normalized",
)
def tfidf_logreg_scored(spark, sf_dir):
    """Every row of every split is scored, with a label of the domain and a probability."""
    rows = stage(gold(spark, sf_dir), "gold")
    scored = T.logreg_predict(T.tfidf_logreg_fit(rows.where(F.col("split") == "train"), MAX_FEATURES), rows)
    return scored.groupBy("split", "label_normalized").agg(
        F.count("*").alias("rows"), F.count_if(F.col("prediction").isin("negative", "neutral", "positive")).alias(
            "with_prediction"),
        F.bool_and((F.col("score") >= 1 / 3) & (F.col("score") <= 1)).alias("in_range"),
    )


class BucketScorer:
    """Stands in for a model: label and score by a hash of the text, the same in any engine."""

    def predict(self, texts):
        import hashlib

        import pandas as pd

        buckets = [int(hashlib.sha256(t.encode()).hexdigest()[:8], 16) % 100 for t in texts]
        labels = ["negative" if b < 33 else "neutral" if b < 66 else "positive" for b in buckets]
        return pd.DataFrame({"prediction": labels, "score": [(50 + b % 50) / 100.0 for b in buckets]})


_SCORED = f"""scored AS (SELECT source_record_hash, text_clean,
  CASE WHEN b < 33 THEN 'negative' WHEN b < 66 THEN 'neutral' ELSE 'positive' END AS prediction,
  (50 + b % 50) / CAST(100 AS DOUBLE) AS score
  FROM (SELECT *, {Q.bucket('sha256(text_clean)')} AS b FROM gold WHERE split = 'test'))"""


def _input(spark, sf_dir):
    return gold(spark, sf_dir).where(F.col("split") == "test").select("source_record_hash", "text_clean")


@query("score_texts", f"WITH {Q.GOLD}, {_SCORED} SELECT * FROM scored")
def score_texts(spark, sf_dir):
    return G.score_texts(_input(spark, sf_dir), BucketScorer)


@query(
    "batch_predictions",
    f"""WITH {Q.GOLD}, {_SCORED}, {Q.CANDIDATE_METRICS.replace('raw_records AS', 'raw_again AS', 1)}
    SELECT 'predict-1' AS prediction_batch_id, source_record_hash, text_clean, prediction, score,
    'Champion' AS model_alias, registered_model_name, model_version FROM scored, (
      SELECT registered_model_name, model_version FROM candidate_metrics WHERE status = 'SUCCESS'
      AND training_batch_id = 'b2' ORDER BY macro_f1 DESC, accuracy DESC, model_key LIMIT 1)""",
)
def batch_predictions(spark, sf_dir):
    promoted = E.promote_top3(metrics_table(spark, sf_dir)).withColumns(
        {"promoted_ts": F.col("event_ts"), "promotion_batch_id": F.lit("promotion")}
    )
    champion = cut_lineage(G.resolve_model_alias(promoted, "Champion"))
    scored = G.score_texts(_input(spark, sf_dir), BucketScorer)
    return G.batch_predictions(scored, champion, "predict-1").drop("prediction_ts")
