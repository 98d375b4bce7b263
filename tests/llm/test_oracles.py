"""Queries with SQL against DuckDB, on the smallest tables."""

import pytest

from rankdelta.llm.queries import ORACLES, QUERIES

from .helpers import sys  # noqa: F401  (puts tools on the path)
from oracle_check import compare, duck  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    r = compare(spark, duck(sf_dir), sf_dir, name, QUERIES[name], ORACLES[name])
    assert r["ok"], r


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_decontamination_plan_is_native(spark, sf_dir):
    plan = QUERIES["op8_decontaminate"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if x in plan]
