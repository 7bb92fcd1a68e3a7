"""Registered corpus queries against their SQL on the smallest tables, and what is registered."""

import pytest

from checks.compare import connect, difference
from tests.conftest import SMALL
from wardflow.llm.oracles import ORACLES
from wardflow.llm.queries import QUERIES


def test_every_operator_is_registered_once():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_oracle(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None
