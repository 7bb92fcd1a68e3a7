"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SMALL



@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert len(QUERIES) >= 83 and set(QUERIES) == set(ORACLES)


def test_the_entry_lists_all_of_them():
    assert QUERIES.items() <= __spark_entry__.queries().items()
    assert ORACLES.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_oracle(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, ORACLES[name]) is None


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert len(rows) == 10 and rows[0].frequency >= rows[-1].frequency > 0
