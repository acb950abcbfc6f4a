import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) pairs, with more columns whose names may clash."""

    def build(rows, lang="en"):
        data = [(i, t, lang, "s", None if t is None else len(t), "x", 1) for i, t in rows]
        return spark.createDataFrame(data, DOCUMENTS + ", row string, words int")

    return build
