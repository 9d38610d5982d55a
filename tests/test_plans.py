"""Physical-plan properties of the registered queries (scale guards), checked on the sf0.001 tables."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from upkeep.plans import catalog_ops, refresh
from upkeep.sources import testdata as td
from upkeep.sources.tables import YEAR_COL, read_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

STREAMING = {"stream_close_previous", "stream_late_arrivals", "stream_auto_detail"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in entry.queries().items():
        if name in STREAMING:
            continue
        df = fn(spark, SF)
        df.write.format("noop").mode("overwrite").save()  # final adaptive plan
        out[name] = plan(df)
    return out


def test_no_cartesian_or_nested_loop_join(plans):
    bad = {n: p for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad, sorted(bad)


def _unpartitioned_windows(p: str) -> list[str]:
    out = []
    for line in p.splitlines():
        if "windowspecdefinition(" not in line:
            continue
        first_arg = line.split("windowspecdefinition(", 1)[1].split(",", 1)[0]
        if "ASC NULLS" in first_arg or "DESC NULLS" in first_arg:  # ORDER BY only, no PARTITION BY
            out.append(line)
    return out


def test_no_unbounded_single_partition_window(plans):
    # the only window without PARTITION BY allowed is the per-partition offset sum of with_sequence,
    # whose input has one row per shuffle partition
    for name, p in plans.items():
        bad = [w for w in _unpartitioned_windows(p) if "_seq_n" not in w]
        assert not bad, (name, bad)


def test_pick_and_last_log_join_share_one_clustering(spark):
    t = td.load(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = refresh.due_values(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "WindowGroupLimit" in p
    # the window and the last_log join reuse the (equipment_id, task_id) clustering: no (e, t, frequency) exchange
    assert "hashpartitioning(equipment_id" in p
    assert not any("frequency_type" in line for line in p.splitlines() if "Exchange hashpartitioning" in line)


def test_keep_first_is_pre_limited_before_shuffle(spark):
    from upkeep.operators import load

    logs = td.load(spark, SF).maintenance_log.select("id", "equipment_id", "task_id")
    df = load.insert_if_absent(logs.limit(0), logs, ["equipment_id", "task_id"])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_year_bounded_log_read_prunes_partitions(spark):
    logs = read_table(spark, td.materialize(spark, SF), "maintenance_log", keep_year=True)
    df = catalog_ops._logs_between(logs, hi=catalog_ops.ARCHIVE_BEFORE).select("id")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(performed_year" in text and f"({YEAR_COL}" in text


def test_scan_reads_only_needed_columns(spark):
    t = td.load(spark, SF)
    df = t.maintenance_log.groupBy("equipment_id", "task_id").agg(F.max("performed_on"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<equipment_id:bigint,task_id:bigint,performed_on:date>" in text


def test_single_unit_lookup_pushes_the_key_into_the_scans(spark):
    from upkeep.plans import views

    t = td.load(spark, SF)
    text = views.maintenance_timeline(t, 7)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(equipment_id), EqualTo(equipment_id,7)" in text
    text = views.current_components(t, 7)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(equipment_id,7)" in text and "IsNull(removed_at)" in text


def test_ordered_queries_come_back_in_order(spark):
    rows = entry.queries()["due_ordered"](spark, SF).collect()
    far = dt.date.max

    def key(r):
        big = Decimal("1e30")
        return (r.severity, r.next_due_date or far, r.hours_remaining if r.hours_remaining is not None else big,
                r.km_remaining if r.km_remaining is not None else big)

    assert rows and [key(r) for r in rows] == sorted(key(r) for r in rows)
    dates = [r.performed_on for r in entry.queries()["maintenance_timeline"](spark, SF).collect()]
    assert dates and all(a >= b for a, b in zip(dates, dates[1:]))
