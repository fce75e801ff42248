import pytest

CLASH = ["text ", "score", "id", "n", "key"]  # names that operators use inside


@pytest.fixture()
def documents(spark):
    """Documents from texts (ids 0, 1, ... or given), with columns of clashing names."""
    def make(texts, ids=None, langs=None, sources=None):
        n = len(texts)
        rows = list(zip(ids or range(n), texts, langs or ["en"] * n, sources or ["a"] * n, [7] * n, [1.5] * n, ["x"] * n,
                        [None] * n))
        schema = "doc_id bigint, text string, lang string, source string, n int, score double, key string, id string"
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001"
