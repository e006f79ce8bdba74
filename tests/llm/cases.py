"""Tables for the tests of this folder. The fixtures are imported where they are used."""

import pytest
from pyspark.sql import functions as F

from edgeflow.llm.common import fold

SF = "/root/testdata/sf0.001"
#: Every name that an operator uses inside, as extra columns of the input.
CLASHING = "id body fp score row key lines part start number component_id first _doc _gone _bytes units terms ids".split()

LONG_WORDS = " ".join(f"word{i % 977}" for i in range(60_000))
EDGE = [
    (1, "", "en", "a"), (2, None, "en", "a"), (3, " \n\t \r\n", None, None), (4, "one", "en", None),
    (5, "Same words in a row of text.\nSecond line of the same text.", "en", "a"),
    (6, "Same words in a row of text.\nSecond line of the same text.", "de", "b"),
    (6, "Same words in a row of text.\nSecond line of the same text.", "de", "b"),
    (None, "No id but a few words of text here", "fr", "b"), (None, None, None, None),
    (7, LONG_WORDS, "en", "a"), (8, "x" * 200_000, "en", "a"), (9, "Ünï çödé ß Σ ς İ ı 漢字 🎉 <|endoftext|> \x1c\x85​", "de", "c"),
    (9, "another text under the same id", "en", "c"), (50, LONG_WORDS, "en", "a"), (100, "", "en", "a"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns of clashing names."""
    rows = [(*row, len(row[1] or ""), *range(len(CLASHING))) for row in EDGE]
    columns = ", ".join(f"{name} int" for name in CLASHING)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {columns}")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


def learnable():
    return fold(F.col("doc_id")) != 2
