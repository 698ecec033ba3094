"""Classification metrics as relational aggregates, model ranking and promotion."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertone.schemas import LABELS, PROMOTION_ALIASES
from ledgertone.session import cut_lineage

METRICS = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")


def confusion_cells(
    predictions: DataFrame, by: Sequence[str] = (), label: str = "label_normalized", prediction: str = "prediction"
) -> DataFrame:
    """Rows per (label, prediction): the only pass over the predictions, all metrics follow from it."""
    return predictions.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _class_counts(cells: DataFrame, by: Sequence[str], labels: Sequence[str] | None) -> DataFrame:
    """Support, predictions, hits and scores per class, for every class met and every class asked for."""
    zero = F.lit(0).cast("bigint")
    n, hit = F.col("n"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)

    def entry(name: Column, support: Column, predicted: Column, true: Column) -> Column:
        return F.struct(
            name.alias("class"), support.alias("support"), predicted.alias("predicted"), true.alias("true_positive")
        )

    entries = [entry(F.col("label"), n, zero, hit), entry(F.col("prediction"), zero, n, zero)]
    entries += [entry(F.lit(name), zero, zero, zero) for name in labels or ()]
    counts = (
        cells.select(*by, F.inline(F.array(*entries)))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "true_positive")])
    )
    tp, support, predicted = F.col("true_positive"), F.col("support"), F.col("predicted")
    return counts.withColumns(
        {
            "precision": _ratio(tp, predicted),
            "recall": _ratio(tp, support),
            "f1_score": _ratio(2 * tp, support + predicted),
            "counted": F.lit(True) if labels is None else F.coalesce(F.col("class").isin(*labels), F.lit(False)),
        }
    )


def _averages() -> list[Column]:
    """Aggregates over the classes of a group; accuracy covers all rows, the averages the counted classes."""

    def counted(c: Column) -> Column:
        return F.when(F.col("counted"), c)

    weight = F.sum(counted(F.col("support")))
    scores = ("precision", "recall", "f1_score")
    return [
        F.sum("support").alias("eval_rows"),
        (F.sum("true_positive") / F.sum("support")).alias("accuracy"),
        weight.alias("support"),
        *[F.avg(counted(F.col(s))).alias(f"macro_{s}") for s in scores],
        *[_ratio(F.sum(counted(F.col(s) * F.col("support"))), weight).alias(f"weighted_{s}") for s in scores],
    ]


def classification_metrics(
    predictions: DataFrame, by: Sequence[str] = (), label: str = "label_normalized",
    prediction: str = "prediction", labels: Sequence[str] | None = LABELS,
) -> DataFrame:
    """Accuracy, macro precision/recall/F1 and weighted F1 per group, for any number of models at once.

    ``labels`` fixes the classes averaged over; None takes those that occur.
    """
    classes = _class_counts(confusion_cells(predictions, by, label, prediction), by, labels)
    return classes.groupBy(*by).agg(*_averages()).select(
        *by, "eval_rows", "accuracy", "macro_precision", "macro_recall", F.col("macro_f1_score").alias("macro_f1"),
        F.col("weighted_f1_score").alias("weighted_f1"),
    )


def classification_report(
    predictions: DataFrame, by: Sequence[str] = (), label: str = "label_normalized",
    prediction: str = "prediction", labels: Sequence[str] | None = LABELS,
) -> DataFrame:
    """Per-class rows plus accuracy, macro avg and weighted avg; the accuracy row repeats one value."""
    classes = cut_lineage(_class_counts(confusion_cells(predictions, by, label, prediction), by, labels))
    scores = ("precision", "recall", "f1_score")

    def line(name: str, values: Sequence[Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"), *[v.alias(s) for s, v in zip(scores, values)],
            support.cast("double").alias("support"),
        )

    accuracy = F.col("accuracy")
    summary = classes.groupBy(*by).agg(*_averages()).select(
        *by,
        F.inline(F.array(
            line("accuracy", [accuracy] * 3, accuracy),
            line("macro avg", [F.col(f"macro_{s}") for s in scores], F.col("support")),
            line("weighted avg", [F.col(f"weighted_{s}") for s in scores], F.col("support")),
        )),
    )
    rows = classes.where("counted").select(
        *by, F.col("class").alias("row"), *scores, F.col("support").cast("double").alias("support")
    )
    return rows.unionByName(summary)


def confusion_matrix(
    predictions: DataFrame, by: Sequence[str] = (), label: str = "label_normalized", prediction: str = "prediction",
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Full grid including empty cells: one row per real label, one column per predicted label."""
    cells = confusion_cells(predictions, by, label, prediction)
    counts = [
        F.coalesce(
            F.sum(F.when((F.col("label") == F.col("real")) & (F.col("prediction") == p), F.col("n"))), F.lit(0)
        ).alias(f"pred_{p}")
        for p in labels
    ]
    # Every cell visits every real label, so that labels nobody has still get their row.
    return (
        cells.withColumn("real", F.explode(F.array(*[F.lit(name) for name in labels])))
        .groupBy(*by, "real").agg(*counts)
        .withColumn("real", F.concat(F.lit("real_"), "real"))
    )


def class_weights(df: DataFrame, label: str = "label_normalized") -> DataFrame:
    """Balanced weights n / (classes x class rows), from the class counts alone."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("rows"))
    everything = W.partitionBy(F.lit(0))  # one row per class
    return counts.withColumn(
        "weight", F.sum("rows").over(everything) / (F.count("*").over(everything) * F.col("rows"))
    )


# Event field per column of the training history.
HISTORY_FIELDS = {
    "train_loss": "loss",
    "validation_loss": "eval_loss",
    "validation_accuracy": "eval_accuracy",
    "validation_macro_f1": "eval_macro_f1",
}


def training_history(events: DataFrame, by: Sequence[str] = (), first_seq: bool = False) -> DataFrame:
    """Event log to one row per epoch (rounded to four decimals); the last value logged wins.

    ``first_seq`` adds the place of the epoch's first event in the log.
    """
    rows = events.where(F.col("epoch").isNotNull()).withColumn("epoch", F.round(F.col("epoch").cast("double"), 4))
    last = [
        F.max_by(F.col(field), F.when(F.col(field).isNotNull(), F.col("seq"))).alias(name)
        for name, field in HISTORY_FIELDS.items() if field in events.columns
    ]
    if first_seq:
        last.append(F.min("seq").alias("first_seq"))
    return rows.groupBy(*by, "epoch").agg(*last)


def phase_epochs(
    history: DataFrame, run: Sequence[str], phase: str = "phase", epoch: str = "epoch",
    phases: Sequence[str] | None = None, first_seq: str = "first_seq",
) -> DataFrame:
    """Training phases of a run put one after the other under one epoch index, in the order in which they ran.

    That order is given by ``phases`` (others follow by name), or else by each phase's first event in the log.
    """
    if phases is None:
        place = F.min(first_seq).over(W.partitionBy(*run, phase))
    else:
        place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, phases)), F.col(phase)), F.lit(0)),
                           F.lit(len(phases) + 1))
    index = F.row_number().over(W.partitionBy(*run).orderBy("_place", phase, epoch))
    return history.withColumn("_place", place).withColumn("epoch_index", index).drop("_place")


def metrics_long(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Numeric columns to (metric, value) rows; booleans are not numbers."""
    numeric = [
        c for c, t in metrics.dtypes
        if c not in keys and t in ("tinyint", "smallint", "int", "bigint", "float", "double")
    ]
    wide = metrics.select(*keys, *[F.col(c).cast("double") for c in numeric])
    return wide.unpivot(list(keys), numeric, "metric", "value").where(F.col("value").isNotNull())


def successful_models(metrics: DataFrame) -> DataFrame:
    return metrics.where((F.col("status") == "SUCCESS") & F.col("model_version").isNotNull())


def latest_batch(metrics: DataFrame) -> DataFrame:
    """Batch of the newest successful model."""
    return successful_models(metrics).agg(
        F.max_by("training_batch_id", F.struct("event_ts", "training_batch_id")).alias("training_batch_id")
    )


def promote_top3(metrics: DataFrame, metric: str = "macro_f1") -> DataFrame:
    """Best three models of the latest batch with their aliases; missing metrics rank last."""
    batch = latest_batch(metrics).scalar()
    order = [F.col(metric).desc(), F.col("accuracy").desc(), F.col("model_key")]
    best = (
        successful_models(metrics).where(F.col("training_batch_id") == batch)
        .orderBy(*order).limit(len(PROMOTION_ALIASES))
    )
    # At most three rows are left to number.
    place = F.row_number().over(W.partitionBy("training_batch_id").orderBy(*order))
    names = F.array(*[F.lit(a) for a in PROMOTION_ALIASES])
    return best.withColumn("alias", F.get(names, place - 1))


def best_run(metrics: DataFrame, metric: str = "macro_f1") -> DataFrame:
    return metrics.where(F.col("status") == "SUCCESS").orderBy(F.col(metric).desc_nulls_last(), "model_key").limit(1)


def registration_gate(
    runs: DataFrame, versions: DataFrame | None = None, threshold: float = 0.50, metric: str = "macro_f1"
) -> DataFrame:
    """Runs good enough to register, each with the next version number of its model."""
    passed = runs.where(F.col(metric) >= threshold)
    order = W.partitionBy("registered_model_name").orderBy(F.col(metric).desc(), "run_id")
    numbered = passed.withColumn("_step", F.row_number().over(order))
    if versions is not None:
        current = versions.groupBy("registered_model_name").agg(
            F.max(F.col("model_version").cast("int")).alias("_current")
        )
        numbered = numbered.join(current, "registered_model_name", "left")
    else:
        numbered = numbered.withColumn("_current", F.lit(0))
    version = F.coalesce("_current", F.lit(0)) + F.col("_step")
    return numbered.withColumn("model_version", version.cast("string")).drop("_step", "_current")


def candidate_metrics(predictions: DataFrame, candidates: DataFrame, by: Sequence[str]) -> DataFrame:
    """One metrics row per candidate; a candidate without predictions is FAILED."""
    scored = classification_metrics(predictions, by)
    joined = candidates.join(scored, list(by), "left")
    failed = F.col("eval_rows").isNull()
    message = F.col("error_message") if "error_message" in candidates.columns else F.lit("no predictions")
    return joined.withColumns(
        {
            "status": F.when(failed, "FAILED").otherwise("SUCCESS"),
            "error_message": F.when(failed, F.coalesce(message, F.lit("no predictions"))),
            "model_version": F.when(~failed, F.col("model_version")),
        }
    ).withColumnsRenamed({"macro_precision": "precision_macro", "macro_recall": "recall_macro"})


def sample_predictions(eval_rows: DataFrame, scored: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Evaluation rows with their predictions; ``by`` names what tells several models apart."""
    return eval_rows.join(scored.select(*by, key, "prediction", "score"), key)
