"""Every registered query: equal to its SQL, no Python in the plan, no hidden single task."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check import compare, connect
from workload import catalog, oracle
from workload.bindings import Tables

SQL = oracle.all_sql()
NAMES = list(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(NAMES) == set(SQL)


@pytest.mark.parametrize("name", NAMES)
def test_equal_to_its_sql(spark, con, name):
    assert compare(spark, con, name, SMALL) == ""


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and "avg_order_value" in frame.columns


#: These have done their work in streams or runs when they return; what is left reads a file.
READ_ONLY = ("run_warehouse", "run_stopped_and_resumed", "stream_log_lines", "stream_log_records", "stream_log_routes", "stream_sketch_rollup")


@pytest.mark.parametrize("name", [n for n in NAMES if n not in READ_ONLY])
def test_plans(spark, name):
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct"):
        assert node not in plan
    # a window without keys may only run over the one-row-per-slice summary, whose order is the slice
    for spec in re.findall(r"windowspecdefinition\(((?:[^()]|\([^()]*\))*)specifiedwindowframe", plan):
        if len(re.findall(r"#\d+L?", spec.split(" ASC")[0].split(" DESC")[0])) <= 1:
            assert re.match(r"_slice#\d+L? ASC", spec)


def test_column_pruning_reaches_the_scan(spark):
    frame = entry.queries()["gold_customer_top_city"](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" not in plan and "c_name" not in plan


def test_sketches_are_one_per_key(spark):
    """A sketch of some 3 KB for every pair of key and value is what the count of distinct values must not move."""
    plan = entry.queries()["agg_approx_distinct"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"keys=\[subsidiary_id#\d+L?, product_id#\d+L?\], functions=\[[^\]]*approx_count_distinct", plan)


@pytest.mark.parametrize("name", ["silver_orders", "silver_payments"])
def test_order_items_are_not_written_for_one_reader(spark, name):
    t = Tables(spark, SMALL)
    catalog.QUERIES[name](t)
    assert not {"silver_order_items", "silver_orders"} & set(t.made)


def test_numbered_items_stay_with_their_order(spark):
    """The rows of b_order_items, also where a part is unknown; sums per branch and order don't move them again."""
    t = Tables(spark, SMALL)
    t.made["part"] = t["part"].filter("p_partkey % 5 <> 0")
    one, two = t["b_order_items"], t["b_numbered_items"]
    assert one.columns == two.columns and one.count() == two.count()
    assert one.exceptAll(two).isEmpty()
    plan = catalog.QUERIES["gold_subsidiary_shipping_performance"](Tables(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(subsidiary_id#\d+L?, order_id", plan)
