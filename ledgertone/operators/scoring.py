"""Pluggable distributed scoring."""

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertone.operators.dedup import keep_first
from ledgertone.schemas import CONTROL_TABLES

MINI_BATCH = 16
SCORE_TYPE = T.StructType(
    [
        T.StructField("prediction", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


class Scorer(Protocol):
    """A loaded model: texts in, a frame with prediction and score (same order) out."""

    def predict(self, texts: list[str]) -> pd.DataFrame: ...


def _message(error: Exception) -> str:
    return str(error) or type(error).__name__


def score_texts(
    df: DataFrame, load: Callable[[], Scorer], text: str = "text_clean", mini_batch: int = MINI_BATCH,
    errors: str | None = None,
) -> DataFrame:
    """Adds prediction and score. ``load`` runs once per task, on the worker.

    Only the text crosses to Python; a null text is scored as nothing. A failing scorer fails the job, unless
    ``errors`` names a column for messages: then a mini-batch that fails is scored text by text, and only the texts
    that fail again have a message (all of them if the scorer cannot be loaded).
    """

    @F.pandas_udf(SCORE_TYPE)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            model, broken = load(), None
        except Exception as error:  # whatever it is, it becomes each text's message
            if errors is None:
                raise
            model, broken = None, _message(error)
        for batch in batches:
            texts = batch.tolist()
            labels, scores, messages = ([None] * len(texts) for _ in range(3))
            present = [i for i, t in enumerate(texts) if isinstance(t, str)]

            def predict(part, texts=texts, labels=labels, scores=scores):
                result = model.predict([texts[i] for i in part])
                for i, name, value in zip(part, result["prediction"], result["score"], strict=True):
                    labels[i], scores[i] = name, value

            for start in range(0, len(present), mini_batch):
                part = present[start : start + mini_batch]
                if broken is not None:
                    for i in part:
                        messages[i] = broken
                    continue
                try:
                    predict(part)
                except Exception:
                    if errors is None:
                        raise
                    for i in part:
                        try:
                            predict([i])
                        except Exception as error:
                            labels[i] = scores[i] = None
                            messages[i] = _message(error)
            yield pd.DataFrame({
                "prediction": pd.Series(labels, dtype=object), "score": pd.Series(scores, dtype="float64"),
                "error": pd.Series(messages, dtype=object),
            })

    scored = df.withColumn("_scored", score(F.col(text)))
    more = [F.col("_scored.error").alias(errors)] if errors else []
    return scored.select(*df.columns, "_scored.prediction", "_scored.score", *more)


def resolve_model_alias(promotions: DataFrame, alias: str | None = None) -> DataFrame:
    """The model each alias points to: its newest promotion."""
    rows = promotions if alias is None else promotions.where(F.col("alias") == alias)
    newest = keep_first(
        rows, ["registered_model_name", "alias"],
        [F.col("promoted_ts").desc(), F.col("promotion_batch_id").desc(), F.col("model_version")],
    )
    return newest.select("alias", "registered_model_name", "model_version", "model_key")


def batch_predictions(scored: DataFrame, model: DataFrame, prediction_batch_id: str) -> DataFrame:
    """Scored rows stamped with batch, alias, model and version. ``model`` is one resolved alias row."""
    stamp = {
        "prediction_batch_id": F.lit(prediction_batch_id),
        "model_alias": model.select("alias").scalar(),
        "registered_model_name": model.select("registered_model_name").scalar(),
        "model_version": model.select("model_version").scalar(),
        "prediction_ts": F.current_timestamp(),
    }
    return scored.withColumns(stamp).select(*CONTROL_TABLES["batch_predictions"].fieldNames())
