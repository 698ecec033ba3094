"""Language identification with a blended-spectrum string kernel, Nyström landmarks and kernel ridge regression.

A text's features are the distinct byte n-grams (n = 1, 2, 3) of its lower-cased letters, with all else read as one
space. The kernel of two texts is the number of n-grams present in both, weighted by n and divided by the root of
their own. Landmarks are labelled texts; their kernel matrix gives the Nyström map, in which one ridge regression for
each language against the rest is fitted. Scoring is a product of presence rows with one small matrix: the regression
weights, carried back through the map and the landmarks' presence to n-grams.

Fitting uses a bounded sample of the labelled rows: about ``per_language`` of each language, chosen by a hash of the
id. The model has at most one row for each n-gram of the landmarks; it is broadcast with its size bounded by
``most_grams``. Scoring covers all rows and whole texts.

Results for unusual rows: ``und`` with score 0 where the text is null or has no letter, or nothing was learned; ties go
to the language first in alphabetical order; repeated rows get repeated results; a null id is passed through (and is
not sampled); other columns are not read.
"""

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertone.llm.batches import id_type, map_slices

ORDERS = (1, 2, 3)
WEIGHTS = (1.0, 2.0, 3.0)
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
_ROWS = 128


def prepared(text: str) -> bytes:
    return f" {_OTHER.sub(' ', text.lower())} ".encode()


def gram_codes(data: np.ndarray) -> list[np.ndarray]:
    """Codes of the n-grams that begin at each byte, one array for each order; code 0 is never one."""
    codes = [data.astype(np.int32)]
    for _ in ORDERS[1:]:
        codes.append((codes[-1][:-1] << 8) | data[len(codes):])
    return codes


def present(data: bytes) -> np.ndarray:
    """Distinct n-grams as order << 24 | code."""
    codes = gram_codes(np.frombuffer(data, np.uint8))
    return np.concatenate([np.unique(c) | (n << 24) for n, c in zip(ORDERS, codes)])


class Model:
    """Languages and, for each known n-gram, its row in the matrix of weights."""

    def __init__(self, languages: list[str], grams: np.ndarray, weights: np.ndarray, gram_weights: np.ndarray):
        self.languages, self.grams, self.weights, self.gram_weights = languages, grams, weights, gram_weights

    def tables(self) -> list[np.ndarray]:
        """For each order, the column of each code; the last column stands for unknown n-grams."""
        out = []
        for n in ORDERS:
            table = np.full(1 << (8 * n), len(self.grams), np.int32 if len(self.grams) >= 65535 else np.uint16)
            mine = np.flatnonzero(self.grams >> 24 == n)
            table[self.grams[mine] & 0xFFFFFF] = mine
            out.append(table)
        return out

    def scores(self, texts: list[bytes], tables: list[np.ndarray]) -> np.ndarray:
        """One row per text, one column per language: presence times weights, divided by the kernel's norm."""
        width = len(self.grams)
        presence = np.zeros((len(texts), width + 1), np.float32)
        for row, text in zip(presence, texts):
            for table, codes in zip(tables, gram_codes(np.frombuffer(text, np.uint8))):
                row[table[codes]] = 1.0
        presence = presence[:, :width]
        norm = np.sqrt(np.maximum(presence @ self.gram_weights, 1e-9))
        return (presence @ self.weights) / norm[:, None]


def fit(rows: list[tuple[str, np.ndarray]], landmarks: int, most_grams: int, ridge: float) -> Model | None:
    """rows: (language, distinct n-grams). The first ``landmarks`` rows of each language are the landmarks."""
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    seen, marks = dict.fromkeys(languages, 0), []
    for i, (lang, _) in enumerate(rows):
        if seen[lang] < landmarks:
            marks.append(i)
            seen[lang] += 1
    grams, df = np.unique(np.concatenate([rows[i][1] for i in marks]), return_counts=True)
    grams = np.sort(grams[np.lexsort((grams, -df))[:most_grams]])
    x = np.zeros((len(rows), len(grams)), np.float32)
    for i, (_, own) in enumerate(rows):
        at = np.searchsorted(grams, own)
        at[at == len(grams)] = 0
        x[i, at[grams[at] == own]] = 1.0
    gram_weights = np.asarray(WEIGHTS, np.float32)[(grams >> 24) - 1]
    norms = np.sqrt(np.maximum(x @ gram_weights, 1e-9))
    kernel = ((x * gram_weights) @ x[marks].T) / norms[:, None] / norms[marks]
    values, vectors = np.linalg.eigh(kernel[marks].astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = kernel @ root
    target = np.where(np.array([lang for lang, _ in rows])[:, None] == np.array(languages), 1.0, -1.0)
    gram_matrix = features.T @ features + ridge * np.eye(features.shape[1])
    dual = root @ np.linalg.solve(gram_matrix, features.T @ target)
    weights = (x[marks] * gram_weights / norms[marks][:, None]).T @ dual
    return Model(languages, grams, weights.astype(np.float32), gram_weights)


def fit_on(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = 400, landmarks: int = 64, most_grams: int = 60_000, ridge: float = 1.0,
) -> Model | None:
    """Fits on about ``per_language`` rows of each language among those where ``train`` holds.

    The rows' share is set from counts of all labelled rows; a hash of the id picks them, the same ones wherever the
    rows lie. Their n-gram sets, not their texts, come to the driver.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"),
        train.alias("train"),
    ).where(F.col("train") & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    limits = F.create_map(*[
        F.lit(v) for lang, n in counts for v in (lang, min(1 << 30, int((1 << 30) * per_language / n) + 1))
    ])
    sample = rows.where(draw < limits[F.col("lang")]).select("lang", draw.alias("draw"), "doc_id", "text")

    def start():
        def run(piece):
            grams = [present(prepared(t)) for t in piece.column("text").to_pylist()]
            return [piece.column("lang"), piece.column("draw"), piece.column("doc_id"), [g.tolist() for g in grams]]

        return run

    schema = f"lang string, draw long, doc_id {id_type(docs, id_col)}, grams array<int>"
    found = map_slices(sample, schema, start).collect()
    found.sort(key=lambda r: (r["lang"], r["draw"], str(r["doc_id"])))
    return fit([(r["lang"], np.asarray(r["grams"], np.int64)) for r in found], landmarks, most_grams, ridge)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``lang_pred`` and ``score``, the winner's regression value moved into 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        tables = model.tables() if model else None

        def run(piece):
            texts = piece.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
            names, marks = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for at in range(0, len(known), _ROWS):
                part = known[at:at + _ROWS]
                scores = model.scores([prepared(texts[i]) for i in part], tables)
                best = scores.argmax(axis=1)
                for i, b, s in zip(part, best, scores):
                    names[i] = model.languages[b]
                    marks[i] = float(min(1.0, max(0.0, (s[b] + 1.0) / 2.0)))
            return [piece.column("doc_id"), names, marks]

        return run

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_slices(rows, f"doc_id {id_type(docs, id_col)}, lang_pred string, score double", start)
