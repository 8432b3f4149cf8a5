import pytest
from oracle_compare import compare, duck

from grantsieve.contract.oracles import oracles
from grantsieve.contract.queries import QUERIES

ORACLES = oracles()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_duckdb(spark, con, small, name):
    assert compare(spark, con, small, QUERIES[name], ORACLES[name]) is None
