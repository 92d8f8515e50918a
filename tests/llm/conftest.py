import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A frame of documents from (doc_id, text) pairs, with further columns whose names the operators use themselves."""

    def make(pairs):
        rows = [(i, t, "en", "web", len(t) if t is not None else None, "x", 1, 2, b"z") for i, t in pairs]
        schema = (
            "doc_id bigint, text string, lang string, source string, n_chars bigint, "
            "`_key` string, `hash` bigint, `root` int, `ids` binary"
        )
        return spark.createDataFrame(rows, schema)

    return make


#: Nulls, empty texts, white space, ties and repeated rows.
EDGE = [(None, None), (None, "a b"), (3, None), (4, ""), (5, " \n\t"), (6, "a b"), (6, "a b"), (7, "a b"), (8, "é" * 5000), (9, "$$$ ###")]


@pytest.fixture
def edge(docs_of):
    return docs_of(EDGE)
