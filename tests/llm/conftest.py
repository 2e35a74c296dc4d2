import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    words = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    return " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and white texts, a very long one, ties, repeated rows, repeated and null ids, a null source."""
    rng = random.Random(4)
    shared = prose(rng, 80)
    long = "\n".join(prose(rng, 40) for _ in range(900))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "b", None), (4, "one", "en", None, 3),
        (5, shared, "en", "a", 9), (5, shared, "en", "a", 9), (6, shared, "en", "b", 9), (None, shared, "en", "a", 9),
        (None, None, None, None, None), (7, long, "en", "a", 1), (8, "x\n" + shared + "\nÄ ö ﬁ É 日本", "de", "é", 2),
        (9, "the " * 500, "en", "b", 2), (9, "other text of the same id", "en", "b", 2), (10, "a b", "en", "a", 3),
        (11, "A B", "en", "a", 3), (12, "\x00\x7f \x0b\x0c\r", "en", "a", 3),
        (13, "l1 a\nl2 b\n\nl3 c\nl4 d", "en", "a", 3), (14, "z\nl1 a \nl2 b\nl3 c\ny", "en", "a", 3),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(edge):
    """The same rows with columns named like results and inner columns."""
    names = ["score", "n_words", "found", "secrets", "judged", "size", "target", "copies", "taken", "copy", "key", "label",
             "n_lines", "n_deleted", "win", "tid", "fp", "name", "start", "end", "host", "path", "rule", "verdict", "item_id"]
    return edge.withColumns({n: F.lit("mine") for n in names})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
