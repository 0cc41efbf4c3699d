import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import odd as fixtures  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return fixtures.documents(spark)


@pytest.fixture(scope="session")
def none(spark):
    return fixtures.empty(spark)


@pytest.fixture(scope="session")
def texts(spark, small):
    """Text by id of the smallest documents."""
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
