"""Queries against their SQL counterparts at the smallest scale.

By default one query per chain of operators; all of them with CHECK_ALL=1 (several minutes).
"""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import differences, duck
from checks.duckdb_sql import ORACLES
from checks.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"
CHAIN_ENDS = [
    "date_calendar",
    "reference_windows",
    "run_periods",
    "window_totals",
    "outlier_v2",
    "split_membership",
    "coef_multiplier_floor",
    "report_three_types",
    "report_three_types_v2",
    "margin_share_36",
    "ledger_match_by_date",
    "ledger_full_scope",
    "ledger_overdraft",
    "ledger_resume",
    "ledger_three_runs",
    "sink_round_trip",
]
CHOSEN = sorted(QUERIES) if os.environ.get("CHECK_ALL") else CHAIN_ENDS


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, connection, name):
    assert differences(entry.queries()[name](spark, SF), connection, entry.oracle_sql()[name]) == []


def test_entry_returns_the_report(spark):
    report = entry.entry(spark)
    assert len(report.columns) == 28 and report.columns[0] == "channel" and report.columns[-1] == "ds"
