import pytest

from tests.conftest import small, spark  # noqa: F401


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with a column whose name could clash."""
    def build(pairs):
        rows = [(i, t, "en", None if k % 3 == 0 else f"s{k}", k) for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, chunk long")
    return build
