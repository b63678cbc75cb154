import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns that clash with outputs."""
    def make(rows, **extra):
        schema = "doc_id long, text string, lang string, source string, n_chars long, score double, start string, n string"
        return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), 0.5, "x", None) for i, t in rows], schema)
    return make


ODD = [(1, None), (2, ""), (3, "   \n"), (4, "a"), (4, "a"), (None, "some words in a row here"), (5, "ſ İ ß Σας  x\x1cy z 漢字 \U0001f600 it's we'll <|endoftext|> end"),
       (6, "word " * 30000), (7, "Some words in a row here"), (8, "x" * 5000)]
