"""Every registered query against its DuckDB oracle at sf0.001, plus plan checks."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import compare, duck  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from rankdelta.plans.registry import load_all  # noqa: E402

QUERIES = {k: q.fn for k, q in load_all().items()}
ORACLE = {k: q.oracle for k, q in load_all().items() if q.oracle}
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    r = compare(spark, con, sf_dir, name, QUERIES[name], ORACLE.get(name))
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_or_cross_join(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "status_week" in df.columns
