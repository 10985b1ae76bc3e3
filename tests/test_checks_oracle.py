"""Every registered check against its DuckDB oracle on the smallest driver
data set (the driver repeats this at sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from oracle import compare, duck_connect

SF = os.environ.get("BV_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {name: fn for name, (fn, _sql) in E.CHECKS.items()}
ORACLES = {name: sql for name, (_fn, sql) in E.CHECKS.items()}


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip(f"no test data at {SF}")
    return duck_connect(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_check_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 76
    assert df.count() > 0
