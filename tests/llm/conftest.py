import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 700} passes" for i in range(30_000))
SENTENCE = "the quick brown fox jumps over the lazy dog and runs away from it all today"

# Nulls in every column, empty and blank texts, a very long one, repeated rows, ties.
ODD_ROWS = [
    (1, SENTENCE, "en", "a", 10),
    (2, SENTENCE, "en", None, None),
    (2, SENTENCE, "en", None, None),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", None, "a", 4),
    (6, LONG, "en", "b", len(LONG)),
    (None, "a text without an id but with words", "en", "b", 35),
    (None, None, None, None, None),
    (7, "12345 !!! ###", "en", "b", 13),
    (8, "x", "de", "b", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, DOCUMENTS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (5, None, None), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
