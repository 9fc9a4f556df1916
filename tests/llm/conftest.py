import pytest

TEXT = "doc_id long, text string"


@pytest.fixture()
def frame(spark):
    """A frame of (doc_id, text) rows with extra columns whose names clash
    with those that operators use inside."""
    from pyspark.sql import functions as F

    def make(rows, clash=True):
        df = spark.createDataFrame(rows, TEXT)
        if clash:
            for name in ("words", "n", "items", "sig", "rep", "root", "kind", "next", "_text", "rejected", "score", "spans", "key"):
                df = df.withColumn(name, F.lit(name))
        return df

    return make


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "ümlaut ñandú 中文 words " * 3), (6, "x" * 5000), (7, "a b " * 4000), (None, "a row without an id and some words")]


@pytest.fixture()
def odd(frame):
    """Nulls, empty, wordless, tiny, repeated, non-ASCII and long texts."""
    return frame(ODD)


@pytest.fixture()
def nothing(frame):
    return frame([])
