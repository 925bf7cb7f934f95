"""Registered training-data queries with SQL, against DuckDB on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from oracle_check import compare, duck  # noqa: E402

from ridewise.llm.catalog import REGISTRY  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_query_matches_oracle(spark, name):
    fn, sql = REGISTRY[name]
    res = compare(name, fn(spark, SMALL), duck(SMALL), sql)
    assert res["ok"], res


def test_names_and_entry():
    import __spark_entry__ as E

    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in REGISTRY}
    assert set(REGISTRY) | {"pipeline"} <= set(E.queries())
