"""Every registered query with an oracle, against DuckDB on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(name, E.queries()[name](spark, SMALL), con, ORACLES[name])
    assert res["ok"], res
    assert "type_diff" not in res or all("list" in a for a, _ in res["type_diff"].values()), res


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())
