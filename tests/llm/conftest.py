import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use inside."""

    def make(rows):
        full = [(i, t, "en", "row", 1, 2, "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, row string, size int, measures int, ids string")

    return make


LONG = " ".join(f"w{k % 7919}x{k % 13}" for k in range(60_000))

#: Null, empty, blank, short, long and repeated texts, ties, and ids that are null or repeated.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "one two three four"),
    (6, "ONE two three four"),
    (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (9, LONG),
    (10, LONG + " tail"),
    (None, "a row without an id but with words in it"),
    (12, "é ñ 日本語 🎉 ▁   x​y"),
]


@pytest.fixture(scope="session")
def odd():
    return ODD
