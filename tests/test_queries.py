"""Every query with a SQL counterpart gives the same rows, whole tables, smallest scale."""

from __future__ import annotations

import pytest
from compare import canonical, connect

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, database, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    expected = database.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry_returns_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_scans_are_pruned_and_filtered(spark):
    plan = contract.queries()["q_e08"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan and "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


@pytest.mark.parametrize("name, most", [("fact_purchase", 1), ("fact_increment", 2), ("dim_period", 0)])
def test_lines_are_scanned_no_more_than_needed(spark, name, most):
    """The months of the lines are taken once, before; products and prices are met by number."""
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linestatus#") >= (most > 0) and sum("Relation [l_orderkey" in line for line in plan.split("\n")) == most
