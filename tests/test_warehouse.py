"""One run over the layers: what is built, what a failure stops, what a second start keeps."""

from __future__ import annotations

import threading
import time
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quaymark.plans import gold, silver, warehouse
from quaymark.plans.layers import LayerFailed
from quaymark.plans.warehouse import Run, Table
from quaymark.session import new_folder, stage, workspace
from quaymark.sources import files, readers
from tests.conftest import SMALL
from workload import catalog
from workload.bindings import Tables


def simple(layer, name, *needs, rows=3, log=None):
    def build(run):
        if log is not None:
            log.append(f"{layer}.{name}")
        found = run.spark.range(rows)
        for n in needs:
            found = found.join(run.read(n), "id")
        return found

    return Table(layer, name, build, needs)


def failing(layer, name, *needs):
    def build(run):
        raise ValueError("broken")

    return Table(layer, name, build, needs)


def statuses(summary):
    return {f"{r.layer}.{r.table_name}": r.status for r in summary.collect()}


def test_needs_must_be_met(spark):
    run = Run(spark, new_folder(spark, "w"), "one")
    for bad in (
        [simple("silver", "a", "silver.b"), simple("silver", "b", "silver.a")],
        [simple("silver", "a", "bronze.x")],
        [simple("bronze", "a", "silver.b"), simple("silver", "b")],
        [simple("bronze", "a"), simple("bronze", "a")],
    ):
        with pytest.raises(ValueError):
            warehouse.run_layers(run, bad)
    with pytest.raises(LookupError):
        run.read("bronze.a")


def test_what_a_table_staged_is_deleted_when_it_is_committed(spark):
    def build(run):
        return stage(run.spark.range(5), "kept")

    def broken(run):
        stage(run.spark.range(5), "kept")
        raise ValueError("broken")

    run, outside = Run(spark, new_folder(spark, "w"), "one"), stage(spark.range(2), "kept")
    before = files.children(spark, workspace(spark))
    warehouse.run_layers(run, [Table("bronze", "a", build), Table("bronze", "b", broken)], raise_at_end=False)
    assert run.read("bronze.a").count() == 5 and outside.count() == 2
    assert [n for n in files.children(spark, workspace(spark)) if n not in before and n.startswith("kept")] == []


def test_every_table_is_built_once_in_order_of_need(spark):
    log = []
    tables = [simple("silver", "c", "silver.b", "silver.a", log=log), simple("silver", "b", "silver.a", log=log), simple("silver", "a", log=log)]
    run = Run(spark, new_folder(spark, "w"), "one")
    summary = warehouse.run_layers(run, tables).collect()
    assert log == ["silver.a", "silver.b", "silver.c"]
    assert [(r.table_name, r.status, r.row_count, r.resumed) for r in summary] == [("c", "SUCCESS", 3, False), ("b", "SUCCESS", 3, False), ("a", "SUCCESS", 3, False)]
    again = warehouse.run_layers(run, tables).collect()
    assert len(log) == 3 and all(r.resumed and r.row_count == 3 for r in again)
    warehouse.run_layers(Run(spark, run.base, "two"), tables)
    assert len(log) == 6


def test_tables_without_needs_run_side_by_side(spark):
    together = threading.Barrier(2, timeout=60)

    def build(run):
        together.wait()
        assert run.spark.sparkContext.getLocalProperty("spark.scheduler.pool") in ("bronze.a", "bronze.b")
        return run.spark.range(1)

    tables = [Table("bronze", "a", build), Table("bronze", "b", build)]
    assert set(statuses(warehouse.run_layers(Run(spark, new_folder(spark, "w"), "one"), tables, workers=2)).values()) == {"SUCCESS"}


def test_layers_that_go_on_skip_only_what_needs_the_failed_table(spark):
    tables = [simple("gold", "a"), failing("gold", "b", "gold.a"), simple("gold", "c", "gold.b"), simple("gold", "d", "gold.a"), simple("late", "e")]
    run = Run(spark, new_folder(spark, "w"), "one")
    with pytest.raises(LayerFailed) as failure:
        warehouse.run_layers(run, tables)
    assert statuses(failure.value.summary) == {"gold.a": "SUCCESS", "gold.b": "FAILED", "gold.c": "SKIPPED", "gold.d": "SUCCESS", "late.e": "NOT RUN"}


def test_silver_stops_at_the_first_failure_and_resumes(spark):
    log = []
    tables = [simple("silver", "a", log=log), simple("silver", "b", "silver.a", log=log), simple("silver", "c", log=log), simple("gold", "d", "silver.b", log=log)]
    broken = [replace(t, build=failing("x", "y").build) if t.name == "b" else t for t in tables]
    run = Run(spark, new_folder(spark, "w"), "one")
    first = warehouse.run_layers(run, broken, workers=1, raise_at_end=False)
    assert statuses(first) == {"silver.a": "SUCCESS", "silver.b": "FAILED", "silver.c": "SUCCESS", "gold.d": "NOT RUN"} or statuses(first)["silver.c"] == "NOT RUN"
    assert "gold.d" not in log and first.where("status = 'FAILED'").first().error == "broken"
    second = warehouse.run_layers(run, tables)
    assert set(statuses(second).values()) == {"SUCCESS"} and log.count("silver.a") == 1 and log.count("silver.b") == 1


def test_a_table_without_manifest_is_not_there(spark):
    """A build that dies after writing leaves files but no table."""
    run = Run(spark, new_folder(spark, "w"), "one")
    spark.range(5).write.parquet(f"{run.base}/silver/a/one-dead")
    assert run.committed("silver.a") is None
    warehouse.run_layers(run, [simple("silver", "a")])
    assert run.read("silver.a").count() == 3


def test_rejected_rows_are_kept_aside(spark):
    judged = spark.range(10).withColumn("reasons", F.when(F.col("id") > 6, F.array(F.lit("too large"))).otherwise(F.array().cast("array<string>")))

    def build(run):
        return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)

    run = Run(spark, new_folder(spark, "w"), "one")
    (row,) = warehouse.run_layers(run, [Table("silver", "a", build)]).collect()
    assert (row.row_count, row.quarantined) == (7, 3)
    assert {r.id for r in run.quarantine("silver.a").collect()} == {7, 8, 9} and run.quarantine("silver.b") is None


@pytest.fixture(scope="module")
def whole(spark):
    """Two runs over all layers into one catalog database."""
    t = Tables(spark, SMALL)
    with catalog._database(t) as database:
        base = new_folder(spark, "warehouse")
        runs = [Run(spark, base, name, "spark_catalog", database) for name in ("monday", "tuesday")]
        summaries = [warehouse.run_layers(run, catalog.warehouse_tables(t)).collect() for run in runs]
        yield t, runs, summaries


def test_all_tables_of_three_layers_are_committed(whole):
    _, runs, summaries = whole
    for rows in summaries:
        assert Counter(r.layer for r in rows) == {"bronze": 15, "silver": 19, "gold": 20}
        assert {r.status for r in rows} == {"SUCCESS"} and all(r.row_count > 0 for r in rows)
    assert len(runs[1].listed()) == 39


def test_silver_of_a_run_is_what_each_transform_gives(spark, whole):
    t, (run, _), _ = whole
    for name in ("products", "orders", "behaviors"):
        have, want = run.read(f"silver.{name}"), catalog.SILVER[name](t)
        assert have.schema.simpleString() == want.schema.simpleString()
        assert have.exceptAll(want).isEmpty() and want.exceptAll(have).isEmpty(), name


def test_gold_of_a_run_reads_what_silver_wrote(spark, whole):
    _, (run, _), _ = whole
    s = lambda n: run.read(f"silver.{n}")
    want = {
        "order_performance": gold.order_performance(s("orders")),
        "customer_360": gold.customer_360(s("customers"), s("orders"), s("order_items")),
        "payments_analysis": gold.payments_analysis(s("payments"), s("orders"), s("order_items")),
        "customer_rfm": gold.customer_rfm(run.read("gold.customer_360"), run.read("gold.customer_reviews")),
    }
    for name, frame in want.items():
        have = run.read(f"gold.{name}")
        assert have.count() == frame.count() and have.exceptAll(frame).isEmpty(), name
    # 1500 orders of which some have no items; every one that silver kept is counted once
    assert run.read("gold.order_performance").agg(F.sum("total_orders")).first()[0] == s("orders").count()


def test_customers_read_the_orders_of_the_run_before(whole):
    _, (first, second), _ = whole
    assert {r[0] for r in first.read("silver.customers").select("customer_rank").distinct().collect()} == {"COPPER"}
    want = silver.customers(second.read("bronze.users"), catalog.as_of(), first.read("silver.orders"))
    have = second.read("silver.customers")
    assert have.count() == want.count() and have.exceptAll(want).isEmpty()
    assert readers.table_exists(first.spark, "spark_catalog", first.database, "silver_orders")


def test_quarantine_and_table_lose_no_event(whole):
    t, (run, _), summaries = whole
    row = next(r for r in summaries[0] if r.table_name == "behaviors")
    assert row.row_count + row.quarantined == t["r_user_behaviors"].count() and row.quarantined > 0
    assert run.quarantine("silver.behaviors").where(F.size("reasons") == 0).isEmpty()


def test_a_slow_table_does_not_hold_up_others(spark):
    """The summary's durations are of the tables, not of the wait for a worker."""

    def slow(run):
        time.sleep(2)
        return run.spark.range(1)

    tables = [Table("bronze", "slow", slow), Table("bronze", "fast", lambda run: run.spark.range(1))]
    rows = {r.table_name: r.duration for r in warehouse.run_layers(Run(spark, new_folder(spark, "w"), "one"), tables, workers=1).collect()}
    assert rows["slow"] >= 2 > rows["fast"]
