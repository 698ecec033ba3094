"""Splits, ranks, samples and flags against plain windows, with a hot group and hot copies."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertone.functions.text import seeded_hash
from ledgertone.operators import dedup as D
from ledgertone.operators import splits as P


@pytest.fixture(scope="module")
def rows(spark):
    """3000 rows: half in one dataset, a third with one text, given splits mixed and some unknown."""
    draw = random.Random(7)
    data = []
    for i in range(3000):
        dataset = "hot" if i % 2 else f"d{i % 7}"
        text = "same Text" if i % 3 == 0 else f"text {draw.randrange(900)}"
        split = draw.choice(["train", "validation", "test", "extra", None])
        data.append((i, dataset, split, text, draw.choice(["negative", "neutral", "positive"])))
    df = spark.createDataFrame(
        data, "record_seq bigint, dataset_label string, split string, text string, label_normalized string"
    )
    return df.repartition(8).cache()


def as_dict(df, *columns):
    return {r["record_seq"]: tuple(r[c] for c in columns) for r in df.collect()}


def expected_cut(rank, total):
    fifth = F.round(total * 0.2).cast("bigint")
    return F.when(rank <= total - 2 * fifth, "train").when(rank <= total - fifth, "validation").otherwise("test")


def test_distributed_rank_equals_window(rows):
    got = P.distributed_rank(rows.select("dataset_label", "text", "record_seq"), ["text", "record_seq"], ["dataset_label"], 16)
    window = W.partitionBy("dataset_label").orderBy("text", "record_seq")
    want = rows.withColumn("rank", F.row_number().over(window).cast("bigint"))
    assert as_dict(got, "rank") == as_dict(want, "rank")


def test_sequential_split_equals_window(rows):
    order = F.when(F.col("split") == "train", 0).when(F.col("split") == "validation", 1).when(
        F.col("split") == "test", 2).otherwise(3)
    by = W.partitionBy("dataset_label")
    want = rows.withColumns({
        "rk": F.row_number().over(by.orderBy(order, F.coalesce("split", F.lit("")), "record_seq")),
        "n": F.count("*").over(by),
    }).withColumn("split", expected_cut(F.col("rk"), F.col("n")))
    assert as_dict(P.sequential_split(rows, ["record_seq"]), "split") == as_dict(want, "split")


def test_shuffled_split_equals_window(rows):
    by = W.partitionBy("dataset_label")
    want = rows.withColumns({
        "rk": F.row_number().over(by.orderBy(seeded_hash(42, "record_seq"))), "n": F.count("*").over(by),
    }).withColumn("split", expected_cut(F.col("rk"), F.col("n")))
    assert as_dict(P.shuffled_split(rows, "record_seq"), "split") == as_dict(want, "split")


def test_copies_share_a_split(rows):
    placed = P.shuffled_split(rows, "text")
    spread = placed.groupBy("dataset_label", "text").agg(F.count_distinct("split").alias("n"))
    assert spread.agg(F.max("n")).first()[0] == 1
    assert placed.count() == 3000


def test_stratified_split_sizes_and_fallbacks(rows):
    placed = P.stratified_split(rows, "record_seq").groupBy("label_normalized", "split").count().collect()
    sizes = {(r[0], r[1]): r[2] for r in placed}
    for label in ("negative", "neutral", "positive"):
        n = sum(c for (name, _), c in sizes.items() if name == label)
        assert sizes[label, "test"] == sizes[label, "validation"] == round(n * 0.2)
    few = rows.limit(15)
    assert {r[0] for r in P.stratified_split(few, "record_seq").select("split").distinct().collect()} != {"train"}
    asked = P.stratified_split(few, "record_seq", min_rows=20, min_per_class=3)
    assert [r[0] for r in asked.select("split").distinct().collect()] == ["train"]
    single = rows.where("label_normalized = 'neutral'")
    total = single.count()
    assert P.stratified_split(single, "record_seq").where("split = 'test'").count() == round(total * 0.2)


@pytest.mark.parametrize("count", [1, 20, 1200, 10_000])
def test_take_per_group_equals_window(rows, count):
    window = W.partitionBy("dataset_label").orderBy(seeded_hash(42, "record_seq"))
    want = rows.withColumn("rk", F.row_number().over(window)).where(F.col("rk") <= count)
    got = P.take_per_group(rows, ["dataset_label"], count, "record_seq")
    assert as_dict(got, "text") == as_dict(want, "text")


def test_cap_keeps_other_splits(rows):
    capped = {r[0]: r[1] for r in P.cap_split_rows(rows, "train", 50, "record_seq").groupBy("split").count().collect()}
    before = {r[0]: r[1] for r in rows.groupBy("split").count().collect()}
    assert capped == {**before, "train": 50}
    assert P.cap_split_rows(rows, "train", 0, "record_seq").count() == 3000


def test_duplicate_flags_equal_window(rows):
    within = W.partitionBy("dataset_label", F.lower("text")).orderBy("record_seq")
    overall = W.partitionBy(F.lower("text")).orderBy("record_seq")
    want = rows.withColumns({
        "duplicate_within_dataset": F.row_number().over(within) > 1,
        "duplicate_global": F.row_number().over(overall) > 1,
    })
    names = ("duplicate_within_dataset", "duplicate_global")
    assert as_dict(D.duplicate_flags(rows, ["record_seq"]), *names) == as_dict(want, *names)


def test_hot_text_is_spread(rows):
    """What is grouped before the join is a row per text, dataset and task; the rows meet it in a plain join, whose
    large partitions can be split."""
    plan = D.duplicate_flags(rows, ["record_seq"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan and "Join" in plan


def test_keep_first_reduces_before_the_shuffle(rows):
    kept = D.keep_first(rows, ["text"], ["record_seq"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert kept.count() == rows.select("text").distinct().count()


@pytest.mark.parametrize("threshold", ["10", "100000"])
def test_a_sample_has_its_size_whatever_repeats(spark, threshold):
    """Keys repeat, whole rows repeat, and the planner's group limit lies on either side of the count."""
    rows = [("a", i % 25, i % 50) for i in range(400)] + [("b", 7, 7)] * 40 + [("c", 1, i) for i in range(12)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(5)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        got = sorted(map(tuple, P.take_per_group(df, ["g"], 30, "k").collect()))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    sizes = {g: sum(r[0] == g for r in got) for g in "abc"}
    assert sizes == {"a": 30, "b": 30, "c": 12}
    assert got == sorted(map(tuple, P.take_per_group(df.repartition(2), ["g"], 30, "k").collect()))
    left = list(rows)
    for r in got:
        left.remove(r)  # no more copies than there are


@pytest.mark.parametrize("order", [["tied"], []])
def test_positional_split_is_exact_with_ties(spark, order):
    df = spark.range(1000).selectExpr("id", "id % 2 AS tied", "'one' AS dataset_label", "'train' AS split").coalesce(1)
    got = P.sequential_split(df, order).collect()
    sizes = {s: sum(r.split == s for r in got) for s in ("train", "validation", "test")}
    assert sizes == {"train": 600, "validation": 200, "test": 200}
    place = {"train": 0, "validation": 1, "test": 2}
    key = (lambda r: (r.tied, r.id)) if order else (lambda r: r.id)
    assert [place[r.split] for r in sorted(got, key=key)] == sorted(place[r.split] for r in got)


def test_no_task_holds_a_split_of_equal_keys(spark):
    """With every key equal, the rows' own numbers part them over the range partitions."""
    df = P.with_tie(spark.range(8000).selectExpr("id", "1 AS k", "'one' AS g").repartition(8))
    ranked = P.distributed_rank(df.select("g", "k", P.TIE), ["k", P.TIE], ["g"], 16)
    parts = [r["n"] for r in ranked.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(parts) > 4 and max(parts) < 4000


def test_phases_follow_in_the_order_they_ran(spark):
    from ledgertone.operators.evaluation import phase_epochs, training_history

    events = [("r", "warmup", e, e) for e in range(3)] + [("r", "finetune", e, 10 + e) for e in range(2)]
    df = spark.createDataFrame(events, "run string, phase string, epoch int, seq int").withColumn("loss", F.lit(1.0))
    history = training_history(df, ["run", "phase"], first_seq=True)
    for got in (phase_epochs(history, ["run"]), phase_epochs(history, ["run"], phases=["warmup", "finetune"])):
        rows = sorted(got.collect(), key=lambda r: r.epoch_index)
        assert [(r.phase, r.epoch) for r in rows] == [("warmup", 0), ("warmup", 1), ("warmup", 2), ("finetune", 0), ("finetune", 1)]


def test_encoding_by_lookup_equals_encoding_by_join(spark, sf_dir):
    from ledgertone.operators import features as T

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    documents = documents.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "qqqq zzzz")], documents.schema))
    vocabulary = T.build_vocabulary(documents, 300)
    looked_up = T.encode_sequences(documents, vocabulary, "doc_id", 32)
    joined = T._encode_by_join(documents, vocabulary.select("token", "index"), "doc_id", 32, "text")
    assert "Exchange" not in looked_up._jdf.queryExecution().executedPlan().toString()
    pairs = [{r.doc_id: list(r.sequence) for r in df.collect()} for df in (looked_up, joined)]
    assert pairs[0] == pairs[1] and len(pairs[0][-3]) == 32


def test_unreadable_csv_files_are_left_out_and_told(spark, tmp_path):
    from ledgertone.sources.readers import union_csv_files

    (tmp_path / "a.csv").write_text('text,label\n"x, y",positive\n')
    (tmp_path / "b b.csv").write_text("Headline,Target,more\nh,negative,1\n")
    (tmp_path / "c.csv").write_text("id,value\n1,2\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv.gz").write_bytes(b"this is not gzip")
    told = []
    got = union_csv_files(spark, [str(p) for p in tmp_path.iterdir()], left_out=told)
    assert sorted((r.text, r.label, r.Headline, r.more) for r in got.collect() if r.text) == [("x, y", "positive", None, None)]
    assert got.count() == 2
    assert sorted((p.rsplit("/", 1)[1], why) for p, why in told) == [
        ("c.csv", "no text or label column"), ("d.csv", "unreadable or empty"), ("e.csv.gz", "unreadable or empty"),
    ]


def test_sequential_split_follows_files_and_rows(spark, tmp_path):
    """However large the files are, and however Spark deals them out: by path, then as rows stand in them."""
    bounds = [(0, 100), (100, 1000), (1000, 1050)]
    for form in ("parquet", "csv"):
        for number, (first, last) in enumerate(bounds):
            part = spark.range(first, last, numPartitions=1).selectExpr("id", "'d' AS dataset_label", "'train' AS split")
            part.write.mode("append").option("header", True).format(form).save(f"{tmp_path}/{form}/part={number}")
        rows = spark.read.format(form).option("header", True).load(f"{tmp_path}/{form}")
        got = {int(r.id): r.split for r in P.sequential_split(rows, []).collect()}
        assert [got[i] for i in range(1050)] == ["train"] * 630 + ["validation"] * 210 + ["test"] * 210
    kept, fixed = P.with_place(spark.read.parquet(f"{tmp_path}/parquet"))
    assert fixed and len(kept.columns) == 5
    assert not P.with_place(spark.range(5))[1]
    numbered = spark.range(50).selectExpr("id", "'d' AS dataset_label", "'train' AS split")
    assert P.TIE not in P.sequential_split(numbered, ["id"], unique=True).columns
    got = {r.id: r.split for r in P.sequential_split(numbered, ["id"], unique=True).collect()}
    assert [got[i] for i in range(50)] == ["train"] * 30 + ["validation"] * 10 + ["test"] * 10


def test_a_sample_hashes_no_content_but_at_the_cut(spark):
    rows = spark.range(400).selectExpr("id % 40 AS k", "id", "'g' AS g")
    got = P.take_per_group(rows, ["g"], 25, "k").collect()
    assert len(got) == 25
    whole = [r for r in rows.collect() if sum(x.k == r.k for x in got) == 10]
    assert {(r.k, r.id) for r in whole} <= {(r.k, r.id) for r in got} and len(whole) == 20
    again = P.take_per_group(rows.repartition(7), ["g"], 25, "k").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
