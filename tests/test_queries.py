"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from tripguard.plans.oracles import ORACLES
from tripguard.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF), connection, ORACLES[name]) is None


RISK_QUERIES = {
    "reid_risk": 13, "suppress_outliers": 13, "consent_joined": 13, "generalisation_impact": 10,
    "consent_table_joined": 4, "mart_ml_safe": 28, "mart_analytics_safe": 28, "release_candidates": 13,
    "trip_identity": 28,
}


@pytest.mark.parametrize("name", sorted(RISK_QUERIES))
def test_trips_are_joined_once_and_few_columns_of_them_moved(spark, name):
    """The trips are read as a table, and those that are ranked have no more columns than ids and result need."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan()
    assert "l_orderkey" not in plan.toString()
    windows, nodes = [], [plan]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Window" and "source_file" in node.toString():
            windows.append(node.children().head().output().size())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert windows and max(windows) <= RISK_QUERIES[name]


def test_checks_read_stored_trips(spark):
    """Six sides of the report look at the trips; none of them joins order lines again."""
    plan = QUERIES["checks_report"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "source_file" in plan


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 81


def test_payloads_hold_every_month_once(spark):
    import json

    rows = QUERIES["report_payloads"](spark, SF).collect()
    by_key = {(r["pain_point"], r["data_year"]): json.loads(r["payload_json"]) for r in rows}
    assert len(by_key) == len(rows)
    trend = by_key["volume_trends", None]
    assert [(m["year"], m["month"]) for m in trend] == sorted({(m["year"], m["month"]) for m in trend})
    assert len(trend) == 81
    assert len(by_key["business_context", 2019]) == 10
    assert len(by_key["covid_impact", 2020]) == 12
