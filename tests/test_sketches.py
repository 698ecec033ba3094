"""Stored quantile sketches against exact ranks, and overlaps of datasets against plain sets."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgertone.operators import overlap as O
from ledgertone.operators import sketches as K


@pytest.mark.parametrize("k", [200, 800])
def test_merged_sketches_keep_their_error(spark, k):
    """Seven dates of very different sizes, skewed lengths, a third of all rows of one length."""
    rows = spark.range(0, 150_000, numPartitions=16).selectExpr(
        "CASE WHEN id < 140000 THEN 0 ELSE 1 + id % 6 END AS date",
        "CASE WHEN id % 3 = 0 THEN 17 ELSE CAST(pow(rand(7), 4) * 100000 AS INT) END AS words")
    held = sorted(r.words for r in rows.collect())
    fractions = [0.01, 0.1, 0.25, 0.4, 0.5, 0.75, 0.9, 0.99]
    merged = K.merged_sketches(K.length_sketches(rows, "words", ["date"], k), [])
    row = K.sketch_quantiles(merged, fractions).first()
    assert (row.rows, row.low, row.high) == (len(held), held[0], held[-1])
    for fraction in fractions:
        value = row[f"p{fraction * 100:g}"]
        below = sum(v < value for v in held) / len(held)
        upto = sum(v <= value for v in held) / len(held)
        assert below - 2 * K.rank_error(k) <= fraction <= upto + 2 * K.rank_error(k)
    assert 0.0132 < K.rank_error(200) < 0.0134 and K.rank_error(800) < 0.004


def test_sketches_are_stored_and_merged_without_their_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 1, 7), ("a", 2, 9), ("b", 2, None), ("c", 1, 4)],
                                 "name string, date int, words int")
    K.length_sketches(rows, "words", ["name", "date"]).write.parquet(str(tmp_path / "s"))
    merged = K.merged_sketches(spark.read.parquet(str(tmp_path / "s")), ["name"])
    got = {r.name: (r.rows, r.low, r.high, r.p50) for r in K.sketch_quantiles(merged, (0.5,)).collect()}
    assert got == {"a": (3, 5, 9, 7), "c": (1, 4, 4, 4)}  # nothing is known of b
    assert K.merged_sketches(spark.read.parquet(str(tmp_path / "s")).where("rows < 0"), ["name"]).collect() == []


def test_overlap_against_sets(spark):
    draw = random.Random(2)
    rows = [(draw.choice("abcdef"), f"t{int(draw.paretovariate(0.7))}") for _ in range(800)]
    rows += [("a", "hot")] * 500 + [("b", "hot")] * 2 + [(None, "t1"), ("c", None), ("alone", "own")]
    df = spark.createDataFrame(rows, "dataset_label string, text_hash string").repartition(4)
    held = {d: {t for e, t in rows if e == d and t} for d, _ in rows if d}
    want = {(a, b): len(held[a] & held[b]) for a, b in itertools.combinations(sorted(held), 2) if held[a] & held[b]}
    overlap = O.dataset_overlap(df)
    assert {(r.dataset_a, r.dataset_b): r.shared_texts for r in overlap.collect()} == want
    for r in O.overlap_shares(overlap, df).collect():
        a, b = held[r.dataset_a], held[r.dataset_b]
        assert (r.texts_a, r.texts_b) == (len(a), len(b))
        assert r.shared_share == pytest.approx(len(a & b) / min(len(a), len(b)), abs=1e-6)
    assert "CartesianProduct" not in overlap._jdf.queryExecution().toString()
    assert O.dataset_overlap(df.where(F.col("dataset_label") == "a")).collect() == []
