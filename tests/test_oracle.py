import pytest

import __spark_entry__
from tests.conftest import SF
from workload.check import compare, oracle_connection
from workload.oracle import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert compare(spark, duck, SF, name) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["ticker", "currency", "calendar_month", "price"]
