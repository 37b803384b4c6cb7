"""Small tables with every awkward row: nulls, blanks, a long text, repeated rows, and columns named as operators name theirs."""

import pytest
from pyspark.sql import functions as F

LONG = "Der lange Text hat viele Wörter und " * 4000


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text) rows with clashing extra columns."""

    def make(rows):
        docs = spark.createDataFrame([(doc_id, text, "en", "src0", len(text or "")) for doc_id, text in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long")
        extra = {name: F.lit("own") for name in ("key", "k", "row", "text_hash", "node", "score", "secrets", "words", "ids", "item")}
        return docs.withColumns(extra)

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs([(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "short"), (5, "short"), (None, "no id at all"), (7, None),
                      (8, "日本 text with é\x0bspaces"), (9, "short"), (10, "One two three. One two three.")])
