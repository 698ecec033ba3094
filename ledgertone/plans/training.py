"""Training, evaluation, promotion and batch prediction jobs."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertone.operators import evaluation as E
from ledgertone.operators import features as T
from ledgertone.operators import medallion as M
from ledgertone.operators import reports as R
from ledgertone.operators import scoring as G
from ledgertone.operators import splits as P
from ledgertone.plans.medallion import Workspace, _log
from ledgertone.schemas import CONTROL_TABLES, EVIDENCE_ORDER
from ledgertone.session import cut_lineage, scratch_scope, stage
from ledgertone.sinks import tables as W
from ledgertone.sources import readers as S

REGISTERED_MODEL = "sentiment_classifier"
MAX_FEATURES = 10_000

# (training rows, evaluation rows) -> evaluation rows with prediction and score
Fit = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Candidate:
    model_key: str
    fit: Fit
    model_family: str = "transformer"
    base_model: str | None = None


def baseline(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    return T.logreg_predict(T.tfidf_logreg_fit(train, MAX_FEATURES), evaluation)


def scorer_candidate(load: Callable[[], G.Scorer]) -> Fit:
    """A ready-made model as a candidate: nothing to fit, only rows to score."""
    return lambda train, evaluation: G.score_texts(evaluation, load)


def train_candidates(
    spark: SparkSession, space: Workspace, candidates: Sequence[Candidate], batch_id: str, fallback: bool = True,
    eval_rows_per_class: int | None = None, seed: int = 42, stored_rows_per_class: int | None = None,
) -> DataFrame:
    """One metrics row per candidate, from all held-out rows unless a number per class is asked for.

    A failing candidate leaves a FAILED row and, if allowed, the baseline steps in. The classification report, the
    confusion matrix and the predictions of each candidate are stored beside the metrics: those of every evaluation row,
    unless a number per class is asked for.
    """
    with scratch_scope(spark):
        _train_candidates(
            spark, space, candidates, batch_id, fallback, eval_rows_per_class, seed, stored_rows_per_class
        )
    metrics = spark.table(space.table("model_candidate_metrics"))
    return metrics.where(F.col("training_batch_id") == batch_id)


def _train_candidates(
    spark, space, candidates, batch_id, fallback, eval_rows_per_class, seed, stored_rows_per_class
) -> None:
    gold = spark.table(space.table("gold"))
    train = gold.where(F.col("split") == "train")
    held_out = M.eval_set(gold).select("source_record_hash", "text_clean", "label_normalized")
    if eval_rows_per_class is not None:
        held_out = P.stratified_sample(held_out, eval_rows_per_class, "source_record_hash", seed=seed)
    evaluation = stage(held_out, "eval")
    train_rows = train.count()
    tried, scored = [], []

    def attempt(candidate: Candidate, mode: str) -> bool:
        try:
            rows = candidate.fit(train, evaluation).withColumn("model_key", F.lit(candidate.model_key))
            scored.append(
                stage(rows.select("model_key", "source_record_hash", "label_normalized", "prediction", "score"), "p")
            )
            tried.append((candidate, mode, None))
        except Exception as error:  # a candidate may fail in any way; the run records it
            tried.append((candidate, mode, str(error)))
            return False
        return True

    for candidate in candidates:
        if not attempt(candidate, "evaluate") and fallback:
            attempt(Candidate(f"{candidate.model_key}_fallback_tfidf", baseline, "baseline"), "fallback")
    if not scored:
        raise RuntimeError("no candidate could be trained or evaluated")
    predictions = scored[0]
    for more in scored[1:]:
        predictions = predictions.unionByName(more)
    existing = spark.table(space.table("model_candidate_metrics"))
    last = existing.agg(F.coalesce(F.max(F.col("model_version").cast("int")), F.lit(0))).first()[0]
    rows, version = [], last
    for candidate, mode, error in tried:
        version += error is None
        rows.append((
            batch_id, candidate.model_key, candidate.model_family, candidate.base_model, mode,
            f"{batch_id}-{candidate.model_key}", REGISTERED_MODEL, str(version) if error is None else None, train_rows,
            error,
        ))
    plan = spark.createDataFrame(
        rows,
        "training_batch_id string, model_key string, model_family string, hf_model_name string, "
        "training_mode string, run_id string, registered_model_name string, model_version string, "
        "train_rows bigint, error_message string",
    )
    metrics = E.candidate_metrics(predictions, plan, ["model_key"]).withColumn("event_ts", F.current_timestamp())
    kept = stage(metrics.select(*CONTROL_TABLES["model_candidate_metrics"].fieldNames()), "metrics")
    W.evolve_and_append(kept, space.table("model_candidate_metrics"))
    _store_evaluation(space, predictions, evaluation, batch_id, seed, stored_rows_per_class)
    _log(spark, space, batch_id, "train", "SUCCESS", f"candidates ok={len(scored)}", len(scored))


def _store_evaluation(
    space: Workspace, predictions: DataFrame, evaluation: DataFrame, batch_id: str, seed: int,
    stored_rows_per_class: int | None,
) -> None:
    """Report, matrix and predictions, a row set per candidate."""
    cells = cut_lineage(predictions)
    kept = cells
    if stored_rows_per_class is not None:
        kept = P.take_per_group(
            cells, ["model_key", "label_normalized"], stored_rows_per_class, "source_record_hash", seed
        )
    texts = evaluation.select("source_record_hash", "text_clean")
    outputs = {
        "model_classification_report": E.classification_report(cells, ["model_key"]),
        "model_confusion_matrix": E.confusion_matrix(cells, ["model_key"]),
        "model_sample_predictions": kept.join(texts, "source_record_hash"),
    }
    for name, rows in outputs.items():
        W.evolve_and_append(
            rows.withColumns({"training_batch_id": F.lit(batch_id), "event_ts": F.current_timestamp()}),
            space.table(name),
        )


def train_from_snapshot(
    spark: SparkSession, base: str, snapshot_date: str, out: str, max_train_rows: int = 0, seed: int = 42,
    fit: Callable[[DataFrame], object] | None = None, predict: Callable[[object, DataFrame], DataFrame] | None = None,
) -> dict[str, str]:
    """Trains on one dated feature snapshot and writes report, confusion matrix and metrics of its other splits.

    ``max_train_rows`` caps the training split (0: all of it). Without ``fit`` and ``predict`` the baseline is used.
    """
    fit = fit or (lambda train: T.tfidf_logreg_fit(train, MAX_FEATURES, text="text"))
    predict = predict or (lambda model, rows: T.logreg_predict(model, rows, text="text"))
    with scratch_scope(spark):
        rows = M.training_frame(S.scan_snapshot(spark, base, snapshot_date)).select("text", "label_normalized", "split")
        rows = P.with_tie(rows).withColumnRenamed(P.TIE, "row_id")
        model = fit(P.cap_split_rows(rows.where(F.col("split") == "train"), "train", max_train_rows, "row_id", seed))
        scored = predict(model, rows.where(F.col("split") != "train"))
        scored = stage(scored.select("split", "label_normalized", "prediction"), "scored")
        written = {}
        for name, report in {
            "metrics": E.classification_metrics(scored, ["split"]),
            "classification_report": E.classification_report(scored, ["split"]),
            "confusion_matrix": E.confusion_matrix(scored, ["split"]),
        }.items():
            written[name] = f"{out}/snapshot_date={snapshot_date}/{name}"
            report.write.mode("overwrite").parquet(written[name])
        return written


def register_models(
    spark: SparkSession, space: Workspace, batch_id: str, threshold: float, best_only: bool = False,
    metric: str = "macro_f1",
) -> DataFrame:
    """Registers the candidates of a training batch whose metric reaches the threshold, or the best one only.

    Each gets the next version of its model. Nothing good enough is an error, as there is nothing to register.
    """
    metrics = spark.table(space.table("model_candidate_metrics")).where(F.col("training_batch_id") == batch_id)
    runs = E.best_run(metrics, metric) if best_only else metrics.where(F.col("status") == "SUCCESS")
    registry = space.table("model_registry")
    versions = spark.table(registry) if W.table_exists(spark, registry) else None
    gated = E.registration_gate(runs.drop("model_version"), versions, threshold, metric)
    with scratch_scope(spark):
        kept = stage(
            gated.select("registered_model_name", "model_version", "run_id", "model_key", "training_batch_id", metric)
            .withColumn("registered_ts", F.current_timestamp()), "registered",
        )
        count = kept.count()  # at most one row per candidate
        if not count:
            raise RuntimeError(f"no candidate of {batch_id} reaches {metric} >= {threshold}")
        W.evolve_and_append(kept, registry)
    _log(spark, space, batch_id, "register", "SUCCESS", f"registered {count} models", count)
    return spark.table(registry).where(F.col("training_batch_id") == batch_id)


def evidence(spark: SparkSession, space: Workspace, rows: int) -> dict[str, DataFrame]:
    """The newest ``rows`` rows of each control table that exists, in the order of the pipeline."""
    return {
        name: R.evidence_latest(spark.table(space.table(name)), order, rows)
        for name, order in EVIDENCE_ORDER.items() if W.table_exists(spark, space.table(name))
    }


def promote(spark: SparkSession, space: Workspace, batch_id: str, metric: str = "macro_f1") -> DataFrame:
    """Aliases for the best three models of the latest training batch."""
    top = E.promote_top3(spark.table(space.table("model_candidate_metrics")), metric)
    stamped = top.withColumns({"promotion_batch_id": F.lit(batch_id), "promoted_ts": F.current_timestamp()})
    with scratch_scope(spark):
        kept = stage(stamped.select(*CONTROL_TABLES["model_promotion_audit"].fieldNames()), "promoted")
        rows = kept.count()  # at most three
        if rows == 0:
            raise RuntimeError("no successful model to promote")
        W.evolve_and_append(kept, space.table("model_promotion_audit"))
    _log(spark, space, batch_id, "promote", "SUCCESS", f"promoted {rows} models", rows)
    return spark.table(space.table("model_promotion_audit")).where(F.col("promotion_batch_id") == batch_id)


def predict_batch(
    spark: SparkSession, space: Workspace, score: Callable[[DataFrame, str], DataFrame], batch_id: str,
    alias: str = "Champion",
) -> DataFrame:
    """Score the inference table with the model behind an alias and append the predictions.

    ``score`` gets the rows and the model key the alias points to.
    """
    model = cut_lineage(
        G.resolve_model_alias(spark.table(space.table("model_promotion_audit")), alias)
        .where(F.col("registered_model_name") == REGISTERED_MODEL)
    )
    found = model.first()
    if found is None:
        raise LookupError(f"no model promoted as {alias}")
    rows = spark.table(space.table("inference_input")).select("source_record_hash", "text_clean")
    if rows.isEmpty():
        raise ValueError("no rows to predict")
    with scratch_scope(spark):
        kept = stage(G.batch_predictions(score(rows, found["model_key"]), model, batch_id), "predictions")
        W.evolve_and_append(kept, space.table("batch_predictions"))
        written = kept.count()
    _log(spark, space, batch_id, "predict", "SUCCESS", f"{written} predictions", written)
    return spark.table(space.table("batch_predictions")).where(F.col("prediction_batch_id") == batch_id)
