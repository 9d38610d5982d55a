"""Deletes at rest, quarantine, key index, co-located storage, and rules met by month of creation."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from upkeep.operators import colocated, due, key_index, load, quarantine, snapshot, stored, versions
from upkeep.plans import refresh, views
from upkeep.sources.schemas import COMPANY, EQUIPMENT, MAINTENANCE_RULE
from upkeep.sources.seed import seed_tables
from upkeep.sources.tables import YEAR_COL, read_tables, write_tables

DAY = dt.date(2026, 2, 10)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(version, name):
    return {n: sorted(os.listdir(p)) for n, p in version.parts.items() if n.startswith(f"{name}/")}


@pytest.fixture
def published(spark, tmp_path):
    t = seed_tables(spark, DAY)
    old = t.maintenance_log.withColumns({"id": F.col("id") + 10, "performed_on": F.add_months("performed_on", -36)})
    lines = t.maintenance_log_detail.withColumns({"id": F.col("id") + 10, "maintenance_log_id": F.col("maintenance_log_id") + 10})
    t = t.with_(maintenance_log=t.maintenance_log.unionByName(old), maintenance_log_detail=t.maintenance_log_detail.unionByName(lines))
    write_tables(t, str(tmp_path / "tables"))
    p = refresh.RefreshParams(DAY, dt.datetime(2026, 2, 10, 2, 5), 30, Decimal(25), Decimal(500))
    snap = refresh.refresh_due(t, None, p).checkpoint()
    root = str(tmp_path / "stored")
    return read_tables(spark, str(tmp_path / "tables")), snap, root, stored.publish(spark, root, str(tmp_path / "tables"), snap, n=8)


def test_deletes_rewrite_the_years_and_buckets_they_touch(spark, published):
    t, snap, root, before = published
    assert len(stored.years(before, "maintenance_log")) >= 2
    kept_files = {k: files(before, k) for k in (*stored.HEADER, "due_soon")}
    gone = stored.read_years(spark, before, "maintenance_log").where(F.col(YEAR_COL) < 2024).select("id", YEAR_COL)
    units = spark.createDataFrame([(3,)], "id bigint")
    after = stored.delete(spark, root, logs=gone, units=units)
    assert after.number == before.number + 1  # logs with lines and units with due rows: one commit
    ids = [r.id for r in gone.collect()]
    assert rows(stored.read_years(spark, after, "maintenance_log").drop(YEAR_COL)) == rows(t.maintenance_log.where(~F.col("id").isin(ids)))
    want = snapshot.cascade_delete(t.maintenance_log_detail, "maintenance_log_id", gone.select("id")).select(*t.maintenance_log_detail.columns)
    assert rows(stored.read_years(spark, after, "maintenance_log_detail").drop(YEAR_COL)) == rows(want) and want.count() > 0
    assert rows(stored.read_due(spark, after)) == rows(snap.where("equipment_id != 3"))
    for name in stored.HEADER:
        young = [y for y in stored.years(before, name) if int(y) >= 2024]
        assert young and all(after.parts[f"{name}/{y}"] == before.parts[f"{name}/{y}"] for y in young)
        assert all(files(after, name)[f"{name}/{y}"] == kept_files[name][f"{name}/{y}"] for y in young)
    moved = [n for n, p in before.parts.items() if n.startswith("due_soon/") and after.parts.get(n) != p]
    assert len(moved) == 1


def test_set_null_at_rest_and_nothing_to_delete(spark, published):
    t, snap, root, before = published
    same = stored.delete(spark, root, logs=spark.createDataFrame([], f"id bigint, {YEAR_COL} int"), units=spark.createDataFrame([], "id bigint"))
    assert same.parts == before.parts
    after = stored.delete(spark, root, companies=t.company.where("id = 1").select("id"), tasks=spark.createDataFrame([(1,)], "id bigint"))
    want = snapshot.set_null_on_delete(snap.where("task_id != 1"), "company_id", t.company.where("id = 1").select("id"))
    assert rows(stored.read_due(spark, after)) == rows(want) and want.where("company_id is null").count() > 0
    versions.clean(spark, root, keep=1)  # never touches the tables that the first version took by reference
    assert t.maintenance_log.count() == 8


def test_quarantine(spark, tmp_path):
    t = seed_tables(spark, DAY)
    parents = t.as_dict()
    bad = spark.createDataFrame(
        [(1, "Acme", dt.datetime(2026, 1, 1)), (1, "x" * 101, dt.datetime(2026, 1, 1)), (2, None, dt.datetime(2026, 1, 1)), (None, "ok", None), (3, "fine", dt.datetime(2026, 1, 1))],
        "id bigint, name string, created_at timestamp_ntz",
    )
    seen = quarantine.screen(spark, str(tmp_path), "company", bad, parents)
    assert [r.name for r in seen.clean.collect()] == ["fine"] and seen.clean.columns == COMPANY.fieldNames()
    got = sorted(((r.rule, r.column_name, r.key) for r in seen.offenders.collect()), key=str)
    want = [("not_null", "created_at", None), ("not_null", "id", None), ("not_null", "name", 2), ("repeated_id", "id", 1), ("repeated_id", "id", 1), ("varchar", "name", 1)]
    assert got == sorted(want, key=str)
    assert {k: n for k, n in seen.counts.items() if n} == {("not_null", "created_at"): 1, ("not_null", "id"): 1, ("not_null", "name"): 1, ("repeated_id", "id"): 2, ("varchar", "name"): 1}
    assert json.loads(seen.offenders.where("rule = 'varchar'").first().row)["name"] == "x" * 101
    lost = t.equipment.withColumn("farm_id", F.when(F.col("id") == 2, 99).otherwise(F.col("farm_id")))
    seen = quarantine.screen(spark, str(tmp_path), "equipment", lost, parents)
    assert [(r.rule, r.column_name, r.key) for r in seen.offenders.collect()] == [("foreign_key", "farm_id", 2)] and seen.clean.count() == 2
    assert quarantine.screen(spark, str(tmp_path), "farm", t.farm.limit(0), parents).counts[("not_null", "id")] == 0


def test_quarantine_scans_the_whole_rows_once(spark, tmp_path):
    t = seed_tables(spark, DAY)
    write_tables(t, str(tmp_path))
    t = read_tables(spark, str(tmp_path))
    plan = quarantine.tagged("equipment", t.equipment, t.as_dict())._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.splitlines() if "Relation" in line]
    scans = quarantine.tagged("equipment", t.equipment, t.as_dict())._jdf.queryExecution().sparkPlan().toString()
    assert wide and sum("display_name:string" in s for s in scans.split("ReadSchema:")[1:]) == 1


def test_quarantine_deals_frequent_and_missing_keys(spark):
    """Values that many rows share, lost, repeated or right, and nulls: the same tags, and no task gets them all."""
    t = seed_tables(spark, DAY)
    farms = [1, 1, 99, None]  # right, lost, missing
    units = [(i if i % 5 else (7 if i % 2 else None), f"u{i}", None, 1, farms[i % 4], None, True, None, None, dt.datetime(2025, 3, 1)) for i in range(1, 2001)]
    loose = StructType([StructField(f.name, f.dataType, True) for f in EQUIPMENT.fields])
    df = spark.createDataFrame(units, loose).repartition(8)
    parents = t.as_dict()
    plain = rows(quarantine.tagged("equipment", df, parents))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = quarantine.tagged("equipment", df, parents, hot_rows=50, broadcast_keys=0)
        assert rows(dealt) == plain
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * 2000 / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r.display_name: sorted(r._broken) for r in dealt.collect()}
    assert got["u1"] == [] and got["u2"] == ["foreign_key:farm_id"] and got["u3"] == ["not_null:farm_id"]
    assert got["u5"] == ["repeated_id:id"] and got["u10"] == ["foreign_key:farm_id", "not_null:id"]


def test_quarantine_moves_only_rows_that_may_be_bad(spark, monkeypatch):
    """Long lists of bad values: the same tags, rows that pass no sieve stay where they are; also with sieves that let all pass."""
    t = seed_tables(spark, DAY)
    parents = t.as_dict()
    units = [(i if i % 7 else 3, f"u{i}", None, 1 if i % 11 else -i, (1, 2, None, -i)[(i % 13 == 0) + 2 * (i % 17 == 0)], None, True, None, None, dt.datetime(2025, 3, 1)) for i in range(1, 2001)]
    loose = StructType([StructField(f.name, f.dataType, True) for f in EQUIPMENT.fields])
    df = spark.createDataFrame(units, loose).repartition(8).localCheckpoint()
    plain = rows(quarantine.tagged("equipment", df, parents))
    assert {len(r[-1]) for r in quarantine.tagged("equipment", df, parents).collect()} == {0, 1, 2, 3}
    where = {r[0]: r[1] for r in df.select("display_name", F.spark_partition_id()).collect()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for most, unmoved in ((quarantine.SIEVE_WORDS, 0.95), (16, 0), (1 << 12, 0.95)):
            monkeypatch.setattr(quarantine, "SIEVE_WORDS", most)
            for hot_rows in (50, 100_000):
                dealt = quarantine.tagged("equipment", df, parents, hot_rows=hot_rows, broadcast_keys=0)
                assert rows(dealt) == plain
                found = dealt.select("display_name", F.spark_partition_id(), "_broken").collect()
                clean = [where[r[0]] == r[1] for r in found if not any("foreign" in b or "repeated" in b for b in r[2])]
                assert len(clean) > 1000 and sum(clean) >= unmoved * len(clean)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_key_index_reads_the_buckets_of_the_batch(spark, tmp_path):
    root = str(tmp_path)
    models = spark.createDataFrame([(i, "m", f"n{i}", "t", None) for i in range(300)], "id long, manufacturer string, model_name string, equipment_type string, description string")
    assert key_index.load_indexed(spark, root, "equipment_model", models, n=16).count() == 300
    before = versions.current(spark, root)
    batch = spark.createDataFrame([(900, "m", "n5", "t", None), (901, "m", "new", "t", None), (902, "m", "new", "t", None), (903, None, "x", "t", None)], models.schema)
    key = load.NATURAL_KEYS["equipment_model"]
    from upkeep.operators import buckets

    touched = buckets.touched(batch.select(*key), key, 16)
    known = key_index.known_keys(spark, before, "equipment_model", batch.select(*key).schema, touched)
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in known.inputFiles()} <= set(touched) and len(touched) < 16
    assert sorted(r.id for r in key_index.load_indexed(spark, root, "equipment_model", batch).collect()) == [901, 903]
    after = versions.current(spark, root)
    assert all(after.parts[n] == p for n, p in before.parts.items())
    assert key_index.load_indexed(spark, root, "equipment_model", batch.where("id = 902")).count() == 0


def test_key_index_with_many_loads(spark, tmp_path, monkeypatch):
    """Pieces are rewritten as one, keys survive; a writer on an old version conflicts; removed components go by their id."""
    monkeypatch.setattr(key_index, "PIECES", 2)
    root = str(tmp_path / "parts")
    parts = [spark.createDataFrame([(i, f"p{i}", "c", None, None, None)], "id long, name string, category string, manufacturer string, model_code string, description string") for i in range(5)]
    for p in parts:
        assert key_index.load_indexed(spark, root, "part_type", p, n=1).count() == 1
    assert len(versions.current(spark, root).parts) <= 2
    assert all(key_index.load_indexed(spark, root, "part_type", p).count() == 0 for p in parts)
    t = seed_tables(spark, DAY)
    comps = t.equipment_component.unionByName(t.equipment_component.withColumns({"id": F.col("id") + 10, "removed_at": F.col("installed_at")}))
    root = str(tmp_path / "components")
    first = key_index.load_indexed(spark, root, "equipment_component", comps, n=4)
    assert rows(first) == rows(load.load_table("equipment_component", comps.limit(0), comps)) and first.count() == 10
    assert key_index.load_indexed(spark, root, "equipment_component", comps).count() == 0


def test_due_values_from_co_located_tables_need_no_exchange(spark, tmp_path):
    t = seed_tables(spark, DAY)
    picked = colocated.store(refresh.picked(t), str(tmp_path), "picked", 4)
    last = colocated.store(due.last_log(t.maintenance_log), str(tmp_path), "last_log", 4)
    want = rows(refresh.due_values(t))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        values = refresh.due_values(t, picked, last)
        plan = values._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows(values) == want


def test_rules_of_one_month_of_creation_are_dealt_to_tasks(spark):
    """All units created at once: the same rows with one unit a task as with all in one."""
    t = seed_tables(spark, DAY)
    units = [(i, f"u{i}", None, 1, 1, None, True, None, None, dt.datetime(2025, 3, 1 + i % 5)) for i in range(1, 201)]
    rules = []
    for i in range(1, 6):
        r = dict.fromkeys(MAINTENANCE_RULE.fieldNames()) | {"id": i, "task_id": 1 + i % 3, "frequency_type": "MONTHS", "value_numeric": Decimal(3 * i), "active": True, "is_default": True}
        rules.append(tuple(r[c] for c in MAINTENANCE_RULE.fieldNames()))
    t = t.with_(equipment=spark.createDataFrame(units, EQUIPMENT), maintenance_rule=spark.createDataFrame(rules, MAINTENANCE_RULE))
    one = views.month_rules_due(t, DAY, 30)
    many = views.month_rules_due(t, DAY, 30, units_per_task=10)
    assert rows(one) == rows(many) and one.count() > 200
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.month_rules_due(t, DAY, 30, units_per_task=10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(created_month" in plan and "salt" in plan.split("hashpartitioning(created_month")[1][:60]


def test_copies_of_equal_rules_are_made_by_all_tasks(spark, monkeypatch):
    """Few units under many equal rules: the whole result, in blocks that no task has most of."""
    t = seed_tables(spark, DAY)
    units = [(i, f"u{i}", None, 1, 1, None, True, None, None, dt.datetime(2025, 3, 1)) for i in range(1, 5)]
    r = dict.fromkeys(MAINTENANCE_RULE.fieldNames()) | {"task_id": 1, "frequency_type": "MONTHS", "value_numeric": Decimal(3), "active": True, "is_default": True}
    rules = [tuple((r | {"id": i})[c] for c in MAINTENANCE_RULE.fieldNames()) for i in range(1, 1001)]
    t = t.with_(equipment=spark.createDataFrame(units, EQUIPMENT), maintenance_rule=spark.createDataFrame(rules, MAINTENANCE_RULE))
    monkeypatch.setattr(views, "COPIES_PER_ROW", 10)
    due_rows = views.month_rules_due(t, DAY, 30)
    sizes = [n["count"] for n in due_rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000
    assert {tuple(n) for n in due_rows.groupBy("equipment").count().collect()} == {(f"u{i}", 1000) for i in range(1, 5)}


def test_first_arrivals_are_taken_before_known_keys(spark):
    """A key with many rows is dealt once, whether it is known or not."""
    batch = spark.createDataFrame([(i, f"k{i % 3}" if i % 10 else None) for i in range(1, 1001)], "id long, name string").repartition(4)
    known = spark.createDataFrame([("k1",)], "name string")
    fresh = load.new_rows(known, batch, ["name"])
    assert sorted(r.id for r in fresh.where("name is not null").collect()) == [2, 3] and fresh.count() == 102
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("WindowGroupLimit")  # the limit stands below the join
