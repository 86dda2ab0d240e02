import pytest


@pytest.fixture
def table(spark):
    """A documents table of (doc_id, text) rows, with extra columns whose names operators use themselves."""

    def make(rows):
        schema = "doc_id long, text string, n_words string, statistics int, score string"
        return spark.createDataFrame([(i, t, "x", None, None) for i, t in rows], schema)

    return make


EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "Ab b c  d\r\n e <|endoftext|> it's"),
    (5, "x" * 50_000),
    (6, "The same words again"),
    (6, "The same words again"),
    (None, "no id here 日本"),
    (7, "the SAME words again"),
    (8, " ".join(f"w{i}" for i in range(3000))),
]
