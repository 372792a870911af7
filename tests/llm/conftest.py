"""Small frames for the operators of the llm subpackage."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of ``documents`` from texts, or from (doc_id, text, lang, source)."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            row = (i, row, "en", f"src{i % 3}") if row is None or isinstance(row, str) else row
            full.append((*row, None if row[1] is None else len(row[1])))
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


#: Null and empty texts and ids, repeated rows, a very long text and one very long word.
ODD = [
    (None, None, None, None),
    (None, "a null id\nwith text", "en", "src1"),
    (1, "", "en", "src1"),
    (1, "", "en", "src1"),
    (2, " \t\n\r\n ", None, "src2"),
    (3, "word " * 30_000, "en", None),
    (4, "x" * 20_000, "de", "src2"),
    (5, "😀 naïve\x00 text with odd spaces", "fr", ""),
    (6, "1234 5678 !!", "es", "src1"),
]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
