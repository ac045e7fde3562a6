import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) pairs."""

    def make(rows):
        full = [(i, t, "en", f"src{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
