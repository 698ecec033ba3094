"""Metrics, ranking, promotion (A14-A19, W08, W09, L, M04-M06, J05)."""

from pyspark.sql import functions as F

from ledgertone.operators import evaluation as E
from ledgertone.operators import reports as R
from ledgertone.operators import scoring as G
from ledgertone.plans import inputs as I
from ledgertone.plans.catalog import sql as Q
from ledgertone.plans.catalog.registry import query
from ledgertone.session import cut_lineage

_BY_MODEL = f"{Q.PREDICTIONS}, {Q.metric_ctes('predictions', 'model_key')}"
_METRICS = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")


def rounded(df, *columns, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _round_sql(*columns, digits=9):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def metrics_table(spark, sf_dir):
    """Candidate metrics: a handful of rows out of all predictions, so they are kept once computed."""
    return cut_lineage(
        E.candidate_metrics(
            I.candidate_predictions(spark, sf_dir), I.candidates(spark), ["training_batch_id", "model_key"]
        )
    )


@query(
    "class_weights",
    f"""WITH {Q.LABELLED}, c AS (SELECT label_normalized, count(*) AS rows FROM labelled GROUP BY 1)
    SELECT label_normalized, rows,
    round(CAST(sum(rows) OVER () AS DOUBLE) / (count(*) OVER () * rows), 9) AS weight FROM c""",
)
def class_weights(spark, sf_dir):
    return rounded(E.class_weights(I.labelled_records(spark, sf_dir)), "weight")


@query(
    "classification_metrics",
    f"WITH {_BY_MODEL} SELECT model_key, eval_rows, {_round_sql(*_METRICS)} FROM metrics",
)
def classification_metrics(spark, sf_dir):
    return rounded(E.classification_metrics(I.predictions(spark, sf_dir), ["model_key"]), *_METRICS)


@query(
    "classification_metrics_seen",
    f"""WITH {Q.PREDICTIONS}, seen AS (SELECT * FROM predictions WHERE label_normalized <> 'neutral'
      AND prediction <> 'neutral'),
    {Q.metric_ctes('seen', 'model_key', "(VALUES ('negative'), ('positive')) c(class)")}
    SELECT model_key, eval_rows, {_round_sql(*_METRICS)} FROM metrics""",
)
def classification_metrics_seen(spark, sf_dir):
    """The averages run over the classes that occur."""
    rows = I.predictions(spark, sf_dir).where(
        (F.col("label_normalized") != "neutral") & (F.col("prediction") != "neutral")
    )
    return rounded(E.classification_metrics(rows, ["model_key"], labels=None), *_METRICS)


@query(
    "classification_report",
    f"""WITH {_BY_MODEL} SELECT model_key, class AS row, round(precision_, 9) AS precision, round(recall_, 9) AS recall,
      round(f1, 9) AS f1_score, support FROM classes
    UNION ALL SELECT model_key, 'accuracy', round(accuracy, 9), round(accuracy, 9), round(accuracy, 9),
      round(accuracy, 9) FROM totals
    UNION ALL SELECT model_key, 'macro avg', round(avg(precision_), 9), round(avg(recall_), 9), round(avg(f1), 9),
      sum(support) FROM classes GROUP BY model_key
    UNION ALL SELECT model_key, 'weighted avg', round(sum(precision_ * support) / sum(support), 9),
      round(sum(recall_ * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), sum(support)
      FROM classes GROUP BY model_key""",
)
def classification_report(spark, sf_dir):
    report = E.classification_report(I.predictions(spark, sf_dir), ["model_key"])
    return rounded(report, "precision", "recall", "f1_score", "support")


_GRID = ", ".join(
    f"count(*) FILTER (p.label_normalized = c.class AND p.prediction = '{n}') AS pred_{n}"
    for n in ("negative", "neutral", "positive")
)


@query(
    "confusion_matrix",
    f"""WITH {Q.PREDICTIONS} SELECT model_key, concat('real_', class) AS real, {_GRID}
    FROM predictions p, (VALUES ('negative'), ('neutral'), ('positive')) c(class) GROUP BY model_key, class""",
)
def confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(I.predictions(spark, sf_dir), ["model_key"])


_HISTORY = """arg_max(loss, seq) FILTER (loss IS NOT NULL) AS train_loss,
    arg_max(eval_loss, seq) FILTER (eval_loss IS NOT NULL) AS validation_loss,
    arg_max(eval_accuracy, seq) FILTER (eval_accuracy IS NOT NULL) AS validation_accuracy,
    arg_max(eval_macro_f1, seq) FILTER (eval_macro_f1 IS NOT NULL) AS validation_macro_f1"""


@query(
    "training_history",
    f"""WITH {Q.EVENTS} SELECT run_id, round(epoch, 4) AS epoch, {_HISTORY} FROM training_events
    GROUP BY run_id, round(epoch, 4)""",
)
def training_history(spark, sf_dir):
    return E.training_history(I.training_events(spark, sf_dir), ["run_id"])


@query(
    "phase_epochs",
    f"""WITH {Q.EVENTS}, h AS (SELECT run_id, phase, round(epoch, 4) AS epoch,
      arg_max(loss, seq) FILTER (loss IS NOT NULL) AS train_loss FROM training_events
      GROUP BY run_id, phase, round(epoch, 4)),
    began AS (SELECT run_id, phase, min(seq) AS started FROM training_events GROUP BY run_id, phase)
    SELECT h.*, CAST(row_number() OVER (PARTITION BY run_id ORDER BY started, epoch) AS INTEGER) AS epoch_index
    FROM h JOIN began USING (run_id, phase)""",
)
def phase_epochs(spark, sf_dir):
    history = E.training_history(I.training_events(spark, sf_dir), ["run_id", "phase"], first_seq=True)
    return E.phase_epochs(history, ["run_id"]).select("run_id", "phase", "epoch", "train_loss", "epoch_index")


@query(
    "metrics_long",
    f"""WITH {_BY_MODEL} SELECT * FROM (UNPIVOT (SELECT model_key, CAST(eval_rows AS DOUBLE) AS eval_rows,
      {_round_sql(*_METRICS)} FROM metrics) ON eval_rows, {', '.join(_METRICS)} INTO NAME metric VALUE value)""",
)
def metrics_long(spark, sf_dir):
    wide = E.classification_metrics(I.predictions(spark, sf_dir), ["model_key"])
    return rounded(E.metrics_long(wide, ["model_key"]), "value")


_CM = ("accuracy", "macro_f1", "weighted_f1", "precision_macro", "recall_macro")
_CANDIDATE_COLUMNS = (
    "training_batch_id", "model_key", "model_family", "run_id", "registered_model_name", "model_version", "eval_rows",
    "status", "error_message",
)


@query(
    "candidate_metrics",
    f"""WITH {Q.CANDIDATE_METRICS} SELECT {', '.join(_CANDIDATE_COLUMNS)}, {_round_sql(*_CM)}
    FROM candidate_metrics""",
)
def candidate_metrics(spark, sf_dir):
    return rounded(metrics_table(spark, sf_dir).select(*_CANDIDATE_COLUMNS, *_CM), *_CM)


_OK = "status = 'SUCCESS' AND model_version IS NOT NULL"
_LATEST = f"SELECT arg_max(training_batch_id, event_ts) FROM candidate_metrics WHERE {_OK}"
_RANKED = "row_number() OVER (ORDER BY macro_f1 DESC NULLS LAST, accuracy DESC NULLS LAST, model_key)"
PROMOTED = f"""{Q.CANDIDATE_METRICS}, promoted AS (SELECT * EXCLUDE (rk),
  ['Champion', 'Challenger_1', 'Challenger_2'][rk] AS alias FROM (SELECT *, {_RANKED} AS rk FROM candidate_metrics
  WHERE {_OK} AND training_batch_id = ({_LATEST})) WHERE rk <= 3)"""


@query(
    "promote_top3",
    f"""WITH {PROMOTED} SELECT alias, model_key, model_version, registered_model_name, training_batch_id,
    round(macro_f1, 9) AS macro_f1, round(accuracy, 9) AS accuracy FROM promoted""",
)
def promote_top3(spark, sf_dir):
    top = E.promote_top3(metrics_table(spark, sf_dir)).select(
        "alias", "model_key", "model_version", "registered_model_name", "training_batch_id", "macro_f1", "accuracy"
    )
    return rounded(top, "macro_f1", "accuracy")


@query("latest_batch", f"WITH {Q.CANDIDATE_METRICS} SELECT ({_LATEST}) AS training_batch_id")
def latest_batch(spark, sf_dir):
    return E.latest_batch(metrics_table(spark, sf_dir))


@query(
    "best_run",
    f"""WITH {Q.CANDIDATE_METRICS} SELECT run_id, model_key, round(macro_f1, 9) AS macro_f1 FROM candidate_metrics
    WHERE status = 'SUCCESS' ORDER BY macro_f1 DESC NULLS LAST, model_key LIMIT 1""",
)
def best_run(spark, sf_dir):
    return rounded(E.best_run(metrics_table(spark, sf_dir)).select("run_id", "model_key", "macro_f1"), "macro_f1")


@query(
    "evidence_latest",
    f"""WITH {Q.CANDIDATE_METRICS} SELECT run_id, status, model_version FROM candidate_metrics
    ORDER BY event_ts DESC LIMIT 4""",
)
def evidence_latest(spark, sf_dir):
    return R.evidence_latest(metrics_table(spark, sf_dir), "event_ts", 4).select("run_id", "status", "model_version")


@query(
    "registration_gate",
    f"""WITH {Q.CANDIDATE_METRICS}, old AS (SELECT registered_model_name, max(CAST(model_version AS INTEGER)) AS v
      FROM candidate_metrics WHERE training_batch_id = 'b1' GROUP BY 1)
    SELECT run_id, registered_model_name, CAST(coalesce(v, 0) + row_number() OVER (
      PARTITION BY registered_model_name ORDER BY macro_f1 DESC, run_id) AS VARCHAR) AS model_version
    FROM candidate_metrics LEFT JOIN old USING (registered_model_name)
    WHERE training_batch_id = 'b2' AND macro_f1 >= 0.5""",
)
def registration_gate(spark, sf_dir):
    metrics = metrics_table(spark, sf_dir)
    runs = metrics.where(F.col("training_batch_id") == "b2").drop("model_version")
    versions = metrics.where(F.col("training_batch_id") == "b1")
    gated = E.registration_gate(runs, versions, threshold=0.5)
    return gated.select("run_id", "registered_model_name", "model_version")


@query(
    "resolve_model_alias",
    f"""WITH {PROMOTED} SELECT alias, registered_model_name, model_version, model_key FROM promoted""",
)
def resolve_model_alias(spark, sf_dir):
    promoted = E.promote_top3(metrics_table(spark, sf_dir)).withColumns(
        {"promoted_ts": F.col("event_ts"), "promotion_batch_id": F.lit("promotion")}
    )
    return G.resolve_model_alias(promoted)


@query(
    "sample_predictions",
    f"""WITH {Q.PREDICTIONS} SELECT model_key, record_seq, text, label_normalized, prediction,
    CAST(score AS DOUBLE) AS score FROM predictions""",
)
def sample_predictions(spark, sf_dir):
    scored = I.predictions(spark, sf_dir)
    return E.sample_predictions(I.labelled_records(spark, sf_dir), scored, "record_seq", ["model_key"])
