"""Resampling towards a target: documents drawn by hashed n-gram importance weights, in Arrow kernels.

Words are split off with ``ascii_lower`` and ``split_pattern_regex``, flattened and dictionary-encoded. n-grams are made
of shifted dictionary indices; only distinct ones are spelled out for their CRC, which continues that of the shorter
n-gram. A bucket's gain compares its share in the target with its share in the corpus; gains are taken by bucket and
reduced per document. Documents are drawn without replacement by weight plus Gumbel noise from the id.

The counts cover every text of both sides. What the driver holds is one number per bucket, and a histogram of scores.

Results for unusual rows: null and empty texts have no features, weight 0, and are never drawn unless ``min_words`` is 0.
Repeated rows count and are drawn each for itself, with equal scores. A null id draws its noise as an id without digits
and comes first among equal scores. Empty tables give no rows and even gains. Other columns are not read.
"""

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertone.llm.batches import id_and_text, id_type, map_slices
from ledgertone.llm.components import staged
from ledgertone.operators.splits import distributed_rank

# All ASCII but letters and digits, after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
STEP = 32


def hashed_ngrams(texts: pa.Array, orders: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order up to ``orders``: (text, bucket) of all n-grams of that many words, text by text."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=SEPARATORS)
    words, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
    full = pc.greater(pc.binary_length(words), 0)  # separators at an end leave an empty part
    words, owner = words.filter(full), owner.filter(full).to_numpy()
    encoded = words.dictionary_encode()
    index = encoded.indices.to_numpy().astype(np.int64)
    spelled = encoded.dictionary.cast(pa.binary()).to_pylist()
    crc = np.fromiter(map(zlib.crc32, spelled), np.int64, len(spelled))
    gram = index
    yield owner, pc.take(pa.array(crc % buckets), pa.array(gram)).to_numpy()
    for order in range(2, orders + 1):
        inside = np.flatnonzero(owner[order - 1:] == owner[:len(owner) - order + 1]) if len(owner) >= order else []
        # the n-gram one word shorter that starts here, and the word after it
        pair = gram[inside] * max(len(spelled), 1) + index[np.asarray(inside, np.int64) + order - 1]
        distinct, codes = np.unique(pair, return_inverse=True)
        shorter, word = np.divmod(distinct, max(len(spelled), 1))
        crc = np.fromiter(
            (zlib.crc32(b" " + spelled[w], c) for w, c in zip(word.tolist(), crc[shorter].tolist())), np.int64,
            len(distinct),
        )
        gram = np.full(len(owner), -1)  # by place of the first word, so that the next order can build on it
        gram[inside] = codes
        yield owner[inside], pc.take(pa.array(crc % buckets), pa.array(codes)).to_numpy()


def bucket_counts(docs: DataFrame, text_col: str = "text", orders: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts. A task sends one row per bucket; the driver gets ``buckets`` numbers."""

    def start():
        sums = np.zeros(buckets, np.int64)

        def run(piece):
            for _, bucket in hashed_ngrams(piece.column("text"), orders, buckets):
                np.add(sums, np.bincount(bucket, minlength=buckets), out=sums)

        run.sums = sums
        return run

    def finish(run):
        held = np.flatnonzero(run.sums)
        yield [held, run.sums[held]]

    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = map_slices(rows, "bucket long, n long", start, finish=finish)
    total = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the smoothed share in the target over that in the corpus, rounded down."""
    buckets = len(target)
    all_target, all_corpus = float(target.sum() + buckets), float(corpus.sum() + buckets)
    ratios = ((t + 1.0) * all_corpus / ((s + 1.0) * all_target) for t, s in zip(target.tolist(), corpus.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(doc_id, seed: int) -> int:
    told = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h = int.from_bytes(told[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(
    docs: DataFrame, gain: np.ndarray, orders: int = 1, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score): weight is the mean gain of a text's features, rounded down."""

    def start():
        def run(piece):
            size = len(piece)
            n, total, n_words = np.zeros(size, np.int64), np.zeros(size, np.int64), None
            for owner, bucket in hashed_ngrams(piece.column("text"), orders, len(gain)):
                counts = np.bincount(owner, minlength=size)
                n_words = counts if n_words is None else n_words
                held = np.flatnonzero(counts)
                n += counts
                if len(held):
                    firsts = (np.cumsum(counts) - counts)[held]
                    total[held] += np.add.reduceat(gain.take(bucket), firsts)
            weight = total // np.maximum(n, 1)
            told = np.fromiter((noise(i, seed) for i in piece.column("doc_id").to_pylist()), np.int64, size)
            return [piece.column("doc_id"), n_words, n, weight, weight + told]

        return run

    schema = f"doc_id {id_type(docs, id_col)}, n_words long, n_features long, weight long, score long"
    return map_slices(id_and_text(docs, id_col, text_col), schema, start)


def drawn(scored: DataFrame, percent: int = 10, min_words: int = 20) -> DataFrame:
    """Adds ``rank``: 1, 2, 3... for the ``percent`` of the documents with ``min_words`` words that score highest.

    A histogram of scores (scores are sums of logarithms, so it has a few thousand rows at any size) shows how far down
    the draw reaches; only rows from there on are put in order, by ranges.
    """
    held = staged(scored.withColumn("_tie", F.monotonically_increasing_id()), "scored")
    fit = F.col("n_words") >= min_words
    band = F.floor(F.col("score") / STEP).cast("long")
    counted = held.where(fit).groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()
    room = percent * sum(r["n"] for r in counted) // 100
    least, reached = None, 0
    for row in sorted(counted, key=lambda r: -r["band"]):
        if reached >= room:
            break
        least, reached = row["band"] * STEP, reached + row["n"]
    if least is None:
        return held.drop("_tie").withColumn("rank", F.lit(None).cast("long"))
    near = fit & (F.col("score") >= least)
    ranked = distributed_rank(held.where(near).withColumn("_low", -F.col("score")), ["_low", "doc_id", "_tie"])
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= room, F.col("rank")).cast("long"))
    others = held.where(~near).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*others.columns).unionByName(others).drop("_tie")


def importance_ranks(
    docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, orders: int = 1, buckets: int = BUCKETS,
    seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """One row per document: (doc_id, n_words, n_features, weight, score, rank); rank is null if it is not drawn."""
    gain = gains(bucket_counts(target, target_col, orders, buckets), bucket_counts(docs, text_col, orders, buckets))
    return drawn(weighted(docs, gain, orders, seed, id_col, text_col), percent, min_words)


def resampled(docs: DataFrame, ranks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents drawn, all columns. Rows that share an id stay together if one of them was drawn."""
    chosen = ranks.where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(chosen, docs[id_col].eqNullSafe(F.col("_drawn")), "left_semi")
