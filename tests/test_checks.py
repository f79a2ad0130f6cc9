"""Every registered query against DuckDB, on the smallest driver tables."""

import pytest

from checks import CHECKS
from checks.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(CHECKS))
def test_agrees(spark, duck, name):
    assert difference(spark, duck, FOLDER, name) is None


def test_every_query_has_sql():
    assert all(check.sql for check in CHECKS.values())
