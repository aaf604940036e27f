import pytest

DOCS = [
    (1, "The cat sat on the mat and looked at the dog that sat on the rug near the door.", "en", "a"),
    (2, "The cat sat on the mat and looked at the dog that sat on the rug near the door.", "en", "a"),
    (3, None, None, None), (4, "", "en", "b"), (5, " \n\t ", None, "b"), (6, "a" * 30_000, "en", "a"), (7, "Der Hund läuft über die Straße.", "de", "a"),
    (8, "Le chat est là.\nLe chat est là.", "fr", "b"), (None, "no id at all here", "en", "a"), (1, "The cat sat on the mat.", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and very long texts, repeated ids and texts, and a column that clashes with results."""
    rows = [(*r, "x") for r in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string")


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.limit(0)
