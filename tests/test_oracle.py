"""Every registered query against its SQL; no cross joins in any plan."""

from __future__ import annotations

import os

import pytest

import oracle
from palisade.catalog import ORACLES, QUERIES

DIRECTORY = os.environ.get("PALISADE_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    difference, rows, _, _ = oracle.compare(spark, DIRECTORY, QUERIES[name], ORACLES[name], duck)
    assert difference is None, difference


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize(
    "name",
    [
        "labelled_user_day", "prepared_flows", "d30_separation", "f15_two_stage_detector", "g03_alert_rows", "c03_user_day_features",
        "d28_class_medians", "d39_error_summary", "f16_thresholds", "f17_threshold_sweep", "g08_gate_results",
    ],
)
def test_plan_has_no_cross_join(spark, name):
    plan = QUERIES[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["d12_imbalance"](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string>" in plan

