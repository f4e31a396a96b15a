"""Small tables with every awkward case: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import pytest

from martloom.llm.support import prepared

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, shard int, taken int, row string, "
    "passes string, spot int, queue string, node int, grade string, assign string, random string"
)
LONG = " ".join(f"w{i % 977} common" for i in range(15_000))
TEXTS = [
    (7, "The quick brown fox jumps over the lazy dog. password=hunter2secret99 and more words follow here", "a"),
    (7, "The quick brown fox jumps over the lazy dog. password=hunter2secret99 and more words follow here", "a"),
    (3, None, None),
    (None, "a row without an id but with words", "b"),
    (1, "", "b"),
    (2, " \t\n ", "b"),
    (4, LONG, "a"),
    (5, LONG + " tail", "c"),
    (9, "one", None),
    (10, "ONE", "a"),
    (11, "The quick brown fox jumps over the lazy dog. password=hunter2secret99 and more words follow here", None),
    (12, "écrit déjà vu, naïve café — “quoted”  double space\r\ntabs\tand <|endoftext|> 𝒳𝒴", "é"),
    (-5, "AKIA234567890ABCDEF and deadbeefdeadbeefdeadbeefdeadbeef00 token: abc", "z"),
]


def rows(texts=TEXTS):
    return [(d, t, None, s, None if t is None else len(t), "x", 1, 2, "r", "p", 3, "q", 4, "g", "as", "rn") for d, t, s in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    prepared(spark)
    return spark.createDataFrame(rows(), SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def empty_docs(spark):
    prepared(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain_docs(spark):
    return prepared(spark).read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def sized_docs(spark):
    return prepared(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
