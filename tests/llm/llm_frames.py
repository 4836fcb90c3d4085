import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Rows (doc_id, text, extra columns) as documents with columns that clash with names the operators use."""
    def make(rows, more=""):
        names = "doc_id long, text string, score string, keys int, n int, u int, v int, mark string, spans int, start int" + more
        return spark.createDataFrame([(*r[:2], "x", 1, 2, 3, 4, "m", 5, 6, *r[2:]) for r in rows], names)
    return make
