"""Registered queries against their SQL on the smallest tables, and the shape of their plans."""

import os
import re
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from shopledger import session
from tools.compare import TABLES, compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# One query of each kind; tools/compare.py runs all of them.
CHECKED = [
    "priority_urgency", "late_orders_impact", "machine_utilization", "pending_deliveries", "delivery_shipping_status",
    "midnight_merge", "vacation_runs", "vacation_filtered", "schedule_update", "change_log", "output_rollup",
    "other_process_bonus", "sheeting_bonus", "holiday_pay", "payroll_summary", "load_timesheets", "load_schedules",
    "payrate_clean", "sales_dense", "sales_by_dimension", "ols_gram", "forecast_metrics", "inventory_balance",
    "stream_monitor", "forward_fill", "stream_intake", "route_files", "safe_read", "load_union", "die_price_explode",
    "revenue_lookup", "sheeting_clean", "silver_rules", "gold_rules", "performance_union", "bonus_report", "total_compensation",
    "inventory_reconcile", "sales_measures_dense", "forecast_align", "forecast_quality", "customer_analysis", "work_order_status",
    "rejected_records", "landed_files", "stream_balance", "stream_current_balance", "ols_total", "ols_by_category", "ols_forecast",
    "sarima_fit", "sarima_by_series", "adf_statistic", "model_align", "model_metrics", "model_quality", "model_vs_actual",
    "rolling_errors", "delivery_status_lines", "make_ready", "make_ready_group_rule", "holiday_dim", "holiday_observed",
    "holiday_pay_calendar", "payroll_periods", "salary", "train_test_split", "seasonal_difference", "ols_balance",
]
PLANNED = [
    "priority_urgency", "late_orders_impact", "work_order_status", "machine_utilization", "pending_deliveries",
    "delivery_shipping_status", "midnight_merge", "vacation_filtered", "other_process_bonus", "sales_dense",
    "sales_by_dimension", "inventory_balance", "ols_forecast",
]


@pytest.fixture(scope="module")
def con(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tiny}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, con, tiny, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], tiny).startswith("ok")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "p_num"


@pytest.mark.parametrize("name", PLANNED)
def test_plan(spark, tiny, name):
    plan = QUERIES[name](spark, tiny)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    if name != "ols_forecast":
        assert "MapInPandas" not in plan and "FlatMapGroupsInPandas" not in plan
    for columns in re.findall(r"FileScan parquet \[(.*?)\]", plan):
        assert len(columns.split(",")) <= 7  # no scan reads a whole table


def test_tasks_find_the_package_from_another_folder(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {os.path.dirname(os.path.abspath(entry.__file__))!r})\n"
        "from pyspark.sql import SparkSession\nimport __spark_entry__ as e\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('rows', e.queries()['ols_by_category'](spark, e.SMOKE_DIR).count())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 5" in done.stdout


SOURCES = {"midnight_merge": 4, "vacation_filtered": 8, "sales_dense": 4, "late_orders_impact": 16, "safe_read": 6}


@pytest.mark.parametrize("name", SOURCES)
def test_written_plans_read_the_tables_few_times(spark, tiny, name, monkeypatch):
    """Scans of the given tables, in all that a query writes on its way and in what it returns."""
    plans = []

    def watched(df, label):
        plans.append(df)
        return session.store(df, label)

    for module in list(sys.modules.values()):
        if getattr(module, "__name__", "").startswith("shopledger.") and getattr(module, "store", None) is session.store and module is not session:
            monkeypatch.setattr(module, "store", watched)
    plans.append(QUERIES[name](spark, tiny))
    text = [df._jdf.queryExecution().executedPlan().toString() for df in plans]
    scans = sum(len(re.findall(rf"FileScan parquet .*{re.escape(tiny)}", t)) for t in text)
    assert scans <= SOURCES[name], (name, scans)


def test_a_missing_package_is_no_missing_part(tmp_path):
    """Without the training-data part the other queries are there; without a package that it needs, importing fails."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    base = "import sys\n" + f"sys.path.insert(0, {root!r})\n"
    run = lambda code: subprocess.run([sys.executable, "-c", base + code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    done = run("sys.modules['shopledger.llm.registry'] = None\nimport __spark_entry__ as e\nprint(len(e.queries()) > 100, 'pipeline' in e.queries())")
    assert done.stdout.split() == ["True", "False"]
    if entry.llm_registry:
        done = run("sys.modules['pyarrow'] = None\nimport __spark_entry__")
        assert done.returncode and "pyarrow" in done.stderr
