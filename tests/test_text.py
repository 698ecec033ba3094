import html
import re
import sys
import unicodedata

from pyspark.sql import functions as F

from ledgertone.functions import labels as L
from ledgertone.functions import text as X

ODD_TEXTS = [
    "Q1 profit &amp; loss: &pound;5 &frac12; up &#8364;3", "café naïve Über ß ﬁnance ™",
    "&lt;b&gt;bold&lt;/b&gt; &amp;amp; &ampx &#x41;&#66;", "a—b…c ½", "ＡＢＣ 中文", "",
    "   ", None, "tab\tnew\nline nbsp\x1cfs", "A\U0001d400\U0001f600Z", "x" * 5000 + " &eacute; " + "y" * 5000,
    "null\x00char é",
]


def fold(value):
    return unicodedata.normalize("NFKD", html.unescape(value)).encode("ascii", "ignore").decode()


def test_cleaners_equal_the_plain_python_rule(spark):
    rows = list(enumerate(ODD_TEXTS))
    df = spark.createDataFrame(rows, "i int, t string")
    got = {
        r.i: r for r in df.select(
            "i", X.clean_ascii_letters(F.col("t")).alias("letters"), X.clean_ascii_light(F.col("t")).alias("light"),
            X.word_count(F.col("t")).alias("words"), X.strip_ws(F.col("t")).alias("stripped"),
        ).collect()
    }
    for i, value in rows:
        if value is None:
            assert (got[i].letters, got[i].light) == (None, None)
            continue
        letters = re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z\s]", " ", fold(value))).strip().lower()
        assert got[i].letters == (letters or None)
        assert got[i].light == re.sub(r"\s+", " ", fold(value)).strip()
        assert got[i].words == len(value.split())
        assert got[i].stripped == value.strip()


def test_folding_covers_every_character(spark):
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    step = 64
    rows = [(i, "".join(map(chr, codes[i : i + step]))) for i in range(0, len(codes), step)]
    rows = [(i, t.replace("&", "")) for i, t in rows]
    df = spark.createDataFrame(rows, "i int, t string").repartition(8)
    got = {r.i: r.a for r in df.select("i", X.to_ascii(F.col("t")).alias("a")).collect()}
    for i, value in rows:
        assert got[i] == unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()


def test_silver_text(spark):
    value = "  Visit HTTPS://x.com/a?b now!  ÁRBOL #5 €10 (www.y.org) 50%  "
    got = spark.createDataFrame([(value,)], "t string").select(X.clean_silver(F.col("t"))).first()[0]
    # The site in brackets takes its closing bracket along, the sign and hash go, the digits stay.
    assert got == "visit now! árbol 5 10 50%"


def test_labels(spark):
    df = spark.createDataFrame(
        [(1, " Bullish\t"), (2, "1"), (3, "0"), (4, "-1"), (5, "2"), (6, "Other"), (7, None), (8, "strong negative")],
        "i int, l string",
    )
    got = {
        p: [r[0] for r in df.orderBy("i").select(L.normalize_label(F.col("l"), p)).collect()]
        for p in ("signed", "ordinal", "words")
    }
    assert got["signed"] == ["positive", "positive", "neutral", "negative", "2", "other", None, "negative"]
    assert got["ordinal"] == ["positive", "neutral", "negative", "-1", "positive", "other", None, "negative"]
    assert got["words"] == ["bullish", "1", "0", "-1", "2", "other", None, "negative"]
    silver = [r[0] for r in df.orderBy("i").select(L.normalize_label(F.trim("l"), "silver", "null")).collect()]
    assert silver[1:] == ["positive", "neutral", "negative", None, None, None, None]


def test_class_names_and_probabilities(spark):
    df = spark.createDataFrame([("1",), ("7",), ("-1",), ("x",), (None,)], "v string")
    names = [r[0] for r in df.select(L.label_index_to_name(F.col("v"), ["negative", "neutral"])).collect()]
    assert names == ["neutral", "7", "-1", "x", None]
    scores = spark.createDataFrame(
        [({"positive": 0.4, "neutral": 0.4},), ({"negative": 0.9},), ({},)], "p map<string,double>"
    )
    best = [r[0] for r in scores.select(L.canonical_prediction(F.col("p"))).collect()]
    assert [(b.label, b.score) for b in best] == [("neutral", 0.4), ("negative", 0.9), ("negative", 0.0)]
    assert best[0].probabilities == {"negative": 0.0, "neutral": 0.4, "positive": 0.4}


def test_training_rows_get_label_ids(spark):
    from ledgertone.operators.medallion import training_frame

    rows = [("bad", "negative", "train"), ("ok", "neutral", "validation"), ("good", "positive", "test")]
    df = spark.createDataFrame(rows, "text string, label_normalized string, split string")
    assert {r.text: r.label_id for r in training_frame(df).collect()} == {"bad": 0, "ok": 1, "good": 2}
    try:
        training_frame(df.where("split <> 'test'"))
    except ValueError as error:
        assert "test" in str(error)
    else:
        raise AssertionError("a missing split must fail")


def test_names_and_columns(spark):
    import pytest

    from ledgertone.sources import columns as C

    assert C.safe_column_names(["A b", "a-b", "a_b", "??", "A b"]) == ["a_b", "a_b_2", "a_b_3", "column_3", "a_b_4"]
    assert C.find_column(["Text", "x"], ["text"]) is None
    assert C.find_column(["Text", "text"], ["text"], ignore_case=True) == "text"
    with pytest.raises(ValueError, match="missing"):
        C.require_columns(spark.range(1), ["id", "missing"])
    with pytest.raises(ValueError, match="none of"):
        C.resolve_column(spark.range(1), ["text"], required=True)
