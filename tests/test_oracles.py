"""Every registered query against its DuckDB oracle."""

import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from tablecraft.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, data, name):
    assert differences(QUERIES[name](spark, data), con, ORACLES[name]) == []


SPLIT = [
    "running_balance", "rank_family", "nav_family", "surrogate_sequence", "first_value_region",
    "asof_join", "scd2_backfill", "dv_sat_from_log", "txn_derivations", "daily_snapshot",
    "build_dim_customer", "build_fact_sales", "measures_semi_additive", "opening_closing",
    "dq_scd2_invariants", "cross_score",
]


@pytest.mark.parametrize("name", SPLIT)
def test_query_matches_oracle_with_split_groups(spark, con, data, small_groups, name):
    assert differences(QUERIES[name](spark, data), con, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
