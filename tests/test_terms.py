"""Frequent terms by summaries and recounts, and keys looked for in a table that stays where it is."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgertone.operators import bloom as B
from ledgertone.operators import dedup as D
from ledgertone.operators import features as T
from ledgertone.operators import terms as H


def plain_terms(words, orders):
    words = words or []
    return words + ([f"{a} {b}" for a, b in zip(words, words[1:])] if orders == 2 else [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "ab", "é", "c"]), max_size=8)), max_size=6),
       st.sampled_from([1, 2]), st.integers(0, 2))
def test_grams_against_plain(texts, orders, skip):
    lists = pa.array(texts, pa.list_(pa.string())).slice(skip)
    terms, owner, index = H.grams(lists, orders)
    names = terms.to_pylist()
    want = [(i, t) for i, w in enumerate(texts[skip:]) for t in plain_terms(w, orders)]
    assert sorted((o, names[i]) for o, i in zip(owner.tolist(), index.tolist())) == sorted(want)
    assert len(set(names)) == len(names)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefghij"), max_size=30), max_size=12), st.integers(1, 6))
def test_summaries_keep_their_bound(parts, size):
    summary, true = H.Summary(size), Counter()
    for part in parts:
        counts = Counter(part)
        summary.add(pa.array(list(counts), pa.string()), np.array(list(counts.values()), np.int64))
        true += counts
    table = summary.reduce()
    told = dict(zip(table.column("term").to_pylist(), table.column("n").to_pylist()))
    assert len(told) <= size
    assert all(told.get(t, 0) <= n <= told.get(t, 0) + summary.error for t, n in true.items())
    assert summary.error <= sum(true.values()) / (size + 1)


def want_top(rows, size, orders):
    total, df = Counter(), Counter()
    for words in rows:
        terms = plain_terms(words, orders)
        total.update(terms)
        df.update(set(terms))
    return [(t, n, df[t]) for t, n in sorted(total.items(), key=lambda p: (-p[1], p[0]))[:size]]


@pytest.mark.parametrize("tracked,most", [(400_000, 1_000_000), (300, 1_000_000), (3, 1_000_000), (400_000, 5)],
                         ids=["all tracked", "proved", "bound fails", "too many candidates"])
def test_top_grams_are_exact(spark, sf_dir, tracked, most):
    """Also with summaries too small for a proof, and a word that holds a third of all occurrences."""
    words = F.split("text", " ")
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").repartition(5)
    df = df.withColumn("text", F.concat("text", F.lit(" hot" * 150)))
    rows = [r.text.split(" ") for r in df.collect()]
    for size, orders in ((10, 1), (25, 2)):
        got = H.top_grams(df, words, size, orders, tracked, most)
        assert sorted(map(tuple, got.collect()), key=lambda r: (-r[1], r[0])) == want_top(rows, size, orders)


def test_proof_limits_what_is_counted(spark, sf_dir):
    lists = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.split("text", " ").alias("words"))
    every = len({w for r in lists.collect() for w in r.words})
    candidates, errors = H.candidate_terms(lists.select(F.lit("1").alias("grp"), "words"), 10, 1, 300, 1_000_000)
    assert 10 <= len(candidates["1"]) < 300 < every and errors["1"] > 0
    plan = H.top_grams(lists, F.col("words"), 10, 1, 300)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan  # the counts are checkpointed; nothing is left to count


@pytest.mark.parametrize("tracked", [400_000, 100, 4], ids=["all tracked", "some proved", "none proved"])
def test_top_grams_by_group(spark, sf_dir, tracked):
    """Groups of very different sizes, one without a name, one smaller than what is asked for."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "text", F.expr("CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 7 = 0 THEN NULL ELSE 'rest' END AS name"))
    few = spark.createDataFrame([("x y x", "few"), (None, "none")], df.schema)
    rows = df.unionByName(few).collect()
    got = H.top_grams(df.unionByName(few), F.split("text", " "), 20, 2, tracked, by="name").collect()
    for name in {r.name for r in rows}:
        want = want_top([r.text.split(" ") for r in rows if r.name == name and r.text], 20, 2)
        own = [(r.term, r.total, r.df) for r in got if r.name == name]
        assert sorted(own, key=lambda r: (-r[1], r[0])) == want
    assert len(got) == sum(len(want_top([r.text.split(" ") for r in rows if r.name == n and r.text], 20, 2))
                           for n in {r.name for r in rows})


def test_top_grams_of_nothing(spark):
    nothing = spark.createDataFrame([(None,), ("",)], "text string")
    assert H.top_grams(nothing, T.term_words(F.col("text")), 5, 2).collect() == []
    assert T.tfidf_weights(nothing.withColumn("k", F.lit(1)), "k", 5, "text").collect() == []


def test_weights_by_lookup_and_by_join_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("text_clean")).where("doc_id < 60")
    features = T.top_terms(docs, 300).select("term", "df")
    n = docs.count()
    by_lookup = T._weights_by_lookup(docs, "doc_id", features.toArrow(), n, "text_clean").collect()
    by_join = T._weights_by_join(docs, "doc_id", features, n, "text_clean").collect()
    near = {(r.doc_id, r.term): (r.tf, r.df, round(r.weight, 9)) for r in by_lookup}
    assert near == {(r.doc_id, r.term): (r.tf, r.df, round(r.weight, 9)) for r in by_join} and near


def test_weights_shuffle_no_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("text_clean"))
    plan = T.tfidf_weights(docs, "doc_id", 100)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


# --- keys of a batch in a table -----------------------------------------------------------------------------------


@pytest.mark.parametrize("max_rows,filter_bytes", [(100_000, 1 << 20), (0, 1 << 20), (0, 1)],
                         ids=["broadcast", "filter", "crowded filter"])
def test_known_keys_are_exact(spark, max_rows, filter_bytes):
    batch = spark.range(0, 3000).selectExpr("CASE WHEN id % 50 = 0 THEN NULL ELSE concat('k', id % 900) END AS k", "id")
    table = spark.range(0, 5000).selectExpr("concat('k', id * 3) AS k", "id AS other")
    known = D.known_keys(batch, table, "k", max_rows, filter_bytes)
    want = {f"k{i % 900}" for i in range(3000) if i % 50} & {f"k{i * 3}" for i in range(5000)}
    assert sorted(r.k for r in known.collect()) == sorted(want)
    fresh = D.new_rows(batch, table, "k").collect()
    assert sorted(r.id for r in fresh) == [
        i for i in range(3000) if i % 50 == 0 or f"k{i % 900}" not in want]
    assert D.known_keys(batch.where("id < 0"), table, "k", max_rows).collect() == []
    assert D.known_keys(batch, table.where("other < 0"), "k", max_rows, filter_bytes).collect() == []


def test_filter_keeps_every_key_and_drops_most_others(spark):
    keys = spark.range(0, 20_000).selectExpr("concat('in', id) AS k")
    filled = B.bloom_filter(keys, "k", 20_000)
    assert filled.nbytes <= 20_000 * B.BITS_PER_KEY // 8 + B.SEGMENTS * 8
    assert B.bloom_passed(keys, "k", filled).count() == 20_000
    others = spark.range(0, 20_000).selectExpr("concat('out', id) AS k")
    assert B.bloom_passed(others, "k", filled).count() < 800


def test_the_table_is_not_shuffled(spark, tmp_path):
    """What reads the table's files has no exchange before the keys have been looked for."""
    spark.range(0, 5000).selectExpr("concat('k', id) AS k", "id").write.parquet(str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    batch = spark.range(0, 100).selectExpr("concat('k', id * 100) AS k")
    keys = batch.distinct()
    semi = table.select("k").join(F.broadcast(keys), "k", "left_semi")
    plan = semi._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.index("BroadcastHashJoin") < plan.index("Scan parquet")
    passed = B.bloom_passed(table, "k", B.bloom_filter(keys, "k", 100))
    assert "Exchange" not in passed._jdf.queryExecution().executedPlan().toString()


def test_slices_hold_bounded_words():
    lists = [["w"] * n for n in (150_000, 40_000, 20_000, 0, 450_000, 10)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(lists, pa.list_(pa.string()))], ["grp", "words"])
    got = [s.column(0).to_pylist() for s in H.slices([batch])]
    assert got == [[0, 1], [2, 3], [4], [5, 6]]


def test_groups_share_what_a_task_tracks():
    """A task's memory is bounded, however many groups it meets; the counts taken off are told for each."""
    words = [[f"{g}_{i}" for i in range(30_000)] for g in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "c", "d"]), pa.array(words)], ["grp", "words"])
    rows = pa.Table.from_batches(H._summarized(1, 80_000)([batch, batch]))
    kept = {g: rows.filter(pc.equal(rows.column("grp"), g)) for g in "abcd"}
    assert all(len(t) <= 20_001 for t in kept.values())
    for t in kept.values():
        told = dict(zip(t.column("term").to_pylist(), t.column("n").to_pylist()))
        error = told.pop(None)
        assert all(told.get(w, 0) <= 2 <= told.get(w, 0) + error for w in words["abcd".index(t.column("grp")[0].as_py())])
