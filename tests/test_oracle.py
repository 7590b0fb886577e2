"""Every registered query against its oracle, on the smallest tables."""

import pytest

import check
import __spark_entry__ as contract
from terraloom.suite import all_oracles, all_queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = dict(all_queries()), dict(all_oracles())
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    return check.oracle(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, duck, name):
    assert check.compare(QUERIES[name](spark, SF), duck, ORACLES[name]) == ""


def test_only_known_queries_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["x", "y", "vegetation"] and df.count() == 8000
