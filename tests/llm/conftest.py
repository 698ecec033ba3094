import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with more columns whose names clash with those of the operators."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        if not extra:
            return df
        return df.selectExpr(
            "doc_id", "text", "'x' AS row", "1 AS key", "2 AS chunk", "'k' AS kept", "3 AS removed", "4 AS n_words",
            "'en' AS lang", "5 AS ids", "6 AS sequence_id", "7 AS digest", "8 AS component_id", "9 AS new_text",
        )

    return make


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a null id"), (4, "same\ntext here"), (4, "same\ntext here"),
    (5, "Éa" * 40_000), (6, "x\n" * 5_000), (7, "   \x1c\x85 ퟿😀"), (8, "same\ntext here"),
]


@pytest.fixture(scope="session")
def odd(frame):
    """Nulls, empty and very long texts, repeated rows and ids, odd white space."""
    return frame(ODD)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
