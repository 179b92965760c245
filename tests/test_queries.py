"""Every registered query against its SQL, and the shape of the plans."""

import os

import pytest

import __spark_entry__ as contract
from oracle import all_oracles
from paylake.registry import gold_queries
from paylake.registry_layers import layer_queries
from paylake.plans.metrics import METRICS
from paylake import fixed_values as fv
from tests.compare import difference, duck, run_spark, run_sql

FOLDER = os.environ.get("PAYLAKE_TEST_TABLES", "/root/testdata/sf0.001")
QUERIES, SQL = {**gold_queries(), **layer_queries()}, all_oracles()
# The catalogue is one operator with 96 parameter pairs: every metric and every dimension once here,
# all pairs in tests/compare.py.
_pairs = {f"metric_{m}__{list(fv.DIMENSIONS)[i % 6]}" for i, m in enumerate(METRICS)}
CHECKED = [n for n in QUERIES if not n.startswith("metric_") or "__" not in n or n in _pairs]
PLANNED = (
    "gold_user_360", "gold_daily_metrics", "gold_event_summary", "gold_run_summary", "q_merchant", "q_channel",
    "q_daily", "dash_leaders", "alerts", "alert_concentration", "period_compare", "period_deltas", "report_kpi_status",
    "bronze_flatten", "bronze_first_seen", "bronze_duplicates", "bronze_repair", "silver_final", "silver_run_summary",
    "generic_flatten", "envelope_validate", "profile_columns", "metric_extremes", "dq_invariants", "text_dim_metric",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql_and_the_catalogue_is_complete():
    assert set(QUERIES) == set(SQL)
    assert sum(n.startswith("metric_") and "__" in n for n in QUERIES) == len(METRICS) * len(fv.DIMENSIONS) == 96


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert difference(run_spark(QUERIES[name](spark, FOLDER)), run_sql(con, SQL[name])) is None


def test_the_entry_module_registers_all_of_them():
    assert QUERIES.keys() <= contract.queries().keys() and SQL.keys() <= contract.oracle_sql().keys()


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in plan


def test_unused_parts_of_the_user_table_are_pruned(spark):
    """A count by segment reads neither line items nor amounts and builds no modes."""
    plan = plan_of(QUERIES["metric_usuarios__segmento"](spark, FOLDER))
    assert "lineitem" not in plan and "o_totalprice" not in plan and "slot" not in plan


def test_filters_and_columns_reach_the_scan(spark, folder):
    from paylake.sources import files
    from tests.events import silver_frame

    files.write_silver(silver_frame(spark, [{}]), f"{folder}/silver")
    recent = files.read_silver(spark, f"{folder}/silver").filter("date >= '2026-01-01' AND event = 'PAYMENT_MADE'")
    plan = recent.groupBy("event").sum("amount_cop")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "EqualTo(event,PAYMENT_MADE)" in plan
    assert "ReadSchema: struct<event:string,amount_cop:double>" in plan
