import pytest
from pyspark.sql import functions as F

#: Texts that every operator must get through: null, empty, blank, one word, no blanks at all, very long, other scripts.
ODD = [None, "", " \n\t", "a", "x" * 70_000, "word " * 30_000, "é́ 　ß 漢字 \U0001f600 \x1c\x85", "\x00nul\x7f", "a\r\nb\x0bc\x0cd"]


@pytest.fixture()
def table(spark):
    """Documents of (doc_id, text) pairs, with further columns whose names operators use inside."""

    def make(rows):
        df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        clash = {c: F.lit("other") for c in ("copy", "node", "row", "words", "y", "x", "spans", "score", "first", "hash", "component", "ids", "n")}
        return df.withColumns(clash)

    return make


@pytest.fixture()
def odd_rows():
    """Odd texts, one of them repeated as a row, one under a null id."""
    return [*enumerate(ODD), (3, "a"), (None, "no id " * 30), (None, None)]
