"""The plans the queries are meant to have."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry


@pytest.fixture
def plan(spark, small, capsys):
    def text(name):
        entry.queries()[name](spark, small).explain("formatted")
        return capsys.readouterr().out

    return text


def columns_read(plan_text, table):
    found = re.findall(rf"Location: InMemoryFileIndex \[[^\]]*{table}\.parquet\].*?ReadSchema: struct<([^>]*)>",
                       plan_text, re.S)
    return {column.split(":")[0] for schema in found for column in schema.split(",") if column}


def test_indicators_read_only_their_columns(plan):
    assert columns_read(plan("kpi_category"), "lineitem") == {"l_partkey", "l_extendedprice"}
    assert columns_read(plan("kpi_store"), "lineitem") == {"l_suppkey", "l_extendedprice"}
    assert columns_read(plan("store_counts"), "lineitem") == {"l_suppkey"}
    assert columns_read(plan("event_type_counts"), "events") == {"event_type"}


def test_indicators_join_only_what_they_need(plan):
    for name, joins in {"kpi_category": 1, "kpi_store": 1, "kpi_segment": 2, "kpi_city": 3,
                        "low_stock": 0, "event_type_counts": 0}.items():
        operators = plan(name).split("\n\n")[0]
        assert operators.count("Join") == joins, name


def test_facts_are_reduced_before_they_are_joined(plan):
    operators = plan("kpi_city").split("\n\n")[0].splitlines()
    depth = {row: line for row, line in enumerate(operators)}
    scan = next(row for row, line in depth.items() if "Scan parquet" in line)
    first_join = max(row for row, line in depth.items() if "Join" in line and row < scan)
    assert any("HashAggregate" in depth[row] for row in range(first_join, scan))


def test_filters_reach_the_scan(plan):
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,R))]" in plan("courier_ranking")


def test_top_reports_keep_only_their_rows(plan):
    assert "TakeOrderedAndProject" in plan("top_cities")
    assert "TakeOrderedAndProject" in plan("top_low_stock")


def test_no_query_runs_python_per_row_or_a_cross_join(plan):
    for name in ("kpi_category", "kpi_city", "kpi_segment", "kpi_store", "sale_amount", "events_to_json",
                 "risk_score", "avg_delivery_time", "delayed_orders", "courier_ranking",
                 "revenue_share_by_segment", "campaigns_by_segment"):
        text = plan(name)
        for operator in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in text, (name, operator)
