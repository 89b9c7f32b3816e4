import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Documents (doc_id, text) with columns whose names clash with those that operators make."""
    def make(rows, partitions=3):
        rows = [(i, t, "en", "src", "x", 0, 1.5) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, kept string, n long, score double"
        return spark.createDataFrame(rows, schema).repartition(partitions)
    return make
