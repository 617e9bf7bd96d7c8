import pytest

from .helpers import DOCS, awkward_rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
