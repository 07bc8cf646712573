"""Every core driver query against its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__ as E
from hypeline.plans.compare import compare, duck
from hypeline.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLES, "every query has an oracle"
    ok, msg = compare(E.queries()[name](spark, SF), con, ORACLES[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "post_count" in df.columns
