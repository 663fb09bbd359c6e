import pytest

from courtline.llm.storage import importable


@pytest.fixture(scope="session", autouse=True)
def workers_import_the_package(spark):
    importable(spark)


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


LONG = "word " * 60_000 + "end"
ODD_ROWS = [
    (None, None, None, None),
    (None, "a text without an id", "en", None),
    (1, None, "en", "s"),
    (2, "", "en", "s"),
    (3, LONG, "en", "s"),
    (4, "the same text twice, word for word, in two rows of the table", "en", "s"),
    (4, "the same text twice, word for word, in two rows of the table", "en", "s"),
    (5, " \t\n ", None, "s"),
    (6, "<|endoftext|> 's Å İ. 中文 \U0001f600", "zh", "t"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture()
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows."""
    return spark.createDataFrame(ODD_ROWS, SCHEMA)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)
