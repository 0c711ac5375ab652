import pytest

CHECKED = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return CHECKED


@pytest.fixture(scope="session")
def texts(spark, sf):
    """(doc_id, text) of the smallest documents table."""
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
