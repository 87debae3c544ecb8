import pytest

# Columns of documents besides id and text; the last ones clash with names used inside the operators.
DOC_DDL = "doc_id bigint, text string, source string, print bigint, keep string, high bigint, n_words int"


@pytest.fixture
def docs(spark):
    def make(*rows):
        """Documents of (doc_id, text) with columns that clash."""
        return spark.createDataFrame([(i, t, "s", 1, "k", 2, 3) for i, t in rows], DOC_DDL)

    return make


LONG = "word " * 60_000 + "end."


@pytest.fixture
def odd_rows():
    """Nulls, empties, repeated rows, one id with two texts, and a very long text."""
    return [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "x\n\ny"), (4, "other text"), (None, "no id"), (None, None), (5, LONG), (6, "   \n \t"), (7, "é中😀 ß")]
