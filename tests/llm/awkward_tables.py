"""Tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing names."""

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} token{i}" for i in range(60_000))
CLASHING = ("spans", "score", "n", "size", "target", "copies", "copy", "component", "component_id", "kept", "head", "sig",
            "y", "x", "part", "h", "g", "at", "start", "stop", "leader", "item_id", "held_out", "source_size", "verdict")


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(1, "plain words only here", "en", "a", 21), (2, None, None, None, None), (3, "", "en", "", 0),
            (4, "   \t\n ", "en", "a", 6), (5, LONG, "en", "b", len(LONG)), (6, "one", "en", None, 3),
            (7, "repeated text of some words for the test", "en", "a", 40),
            (7, "repeated text of some words for the test", "en", "a", 40),
            (8, "repeated text of some words for the test", "en", "a", 40),
            (None, "no number on this row but words", None, "a", 10), (9, "naïve ünïcödé 日本語 \x00 𝔘", "xx", "b", 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
