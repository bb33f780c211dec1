import pytest
from pyspark.sql import Row

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Null columns, empty and blank texts, a long text, ties and repeated rows.
EDGE_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t\n ", "en", "a", 5),
    (4, "one two three four five six seven eight nine ten", "en", "b", 48),
    (4, "one two three four five six seven eight nine ten", "en", "b", 48),
    (5, "One two THREE four five six seven eight nine ten", None, "b", 48),
    (6, "word " * 30_000, "en", None, 150_000),
    (7, "x" * 5_000, "en", "a", 5_000),
    (None, "a row without an id, but with some words in it", "en", "a", 46),
    (8, "Ünïcode — ſtrange wörds ١٢٣ 漢字 \u0085   end", "de", "ü", 40),
    (9, "Released under the MIT License. Released under the MIT license", "en", "b", 61),
]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows, with further columns whose names clash with inner ones."""
    df = spark.createDataFrame(EDGE_ROWS, DOCS)
    return df.selectExpr("*", "1 AS id", "'x' AS row", "2 AS th", "3 AS size", "4 AS u", "5 AS rep", "6 AS label", "7 AS word")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture()
def docs(spark):
    def make(*texts, ids=None, source="s", lang="en"):
        rows = [Row(doc_id=i, text=t, lang=lang, source=source, n_chars=None if t is None else len(t))
                for i, t in zip(ids or range(len(texts)), texts)]
        return spark.createDataFrame(rows, DOCS)
    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
