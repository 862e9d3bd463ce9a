import pytest

from . import messy


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(messy.rows(), messy.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def pairs():
    """(doc_id, text) of the same rows."""
    return [(r[0], r[1]) for r in messy.rows()]


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], messy.SCHEMA)
