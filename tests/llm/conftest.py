from __future__ import annotations

import os

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Columns whose names the operators use inside, for tables with clashing extra columns.
CLASHING = ["fp", "key", "u", "n", "item", "length", "shard", "kept", "row", "_id", "_text", "_t", "_words", "root", "low", "keys", "weight"]


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_library(spark):
    spark.sparkContext.environment["PYTHONPATH"] = REPO


def edge_documents(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing columns."""
    long = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))
    texts = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, "a", 0),
        (4, "one", "en", None, 3),
        (5, long, "de", "b", None),
        (6, "the same text twice in this table is a tie to break", "en", "b", 1),
        (7, "the same text twice in this table is a tie to break", "fr", "b", 1),
        (8, "a row that is repeated with all of its columns, word for word", "en", "c", 2),
        (8, "a row that is repeated with all of its columns, word for word", "en", "c", 2),
        (None, "a row without an id, which has words enough to be a text", "en", "c", 2),
        (9, "1234 5678 !!! ### 99", "es", "d", 9),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
