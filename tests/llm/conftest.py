import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row string, size int"


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) or (id, text, source), beside columns whose names operators use themselves."""

    def make(rows):
        full = [(i, t, "en", rest[0] if rest else "s", 0, 0.5, "r", 1) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd_docs(make_docs):
    """NULL and repeated ids, NULL, empty and blank texts, equal rows, and a very long text."""
    return make_docs(
        [
            (1, "a plain text of a few words here"), (1, "a plain text of a few words here"), (2, None, None),
            (3, "", ""), (4, " \n\t ", None), (None, "no id but quite a few words"), (5, "word " * 40_000), (6, "x"),
        ]
    )
