"""Versioned and bucketed tables: crashes, two writers, what a refresh rewrites, change-driven refresh = full refresh."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from upkeep.operators import buckets, due, snapshot, versions
from upkeep.plans import due_store, refresh
from upkeep.sources.schemas import DUE_SOON, EQUIPMENT, EQUIPMENT_COMPONENT, MAINTENANCE_LOG, MAINTENANCE_RULE, MAINTENANCE_TASK
from upkeep.sources.seed import seed_tables

DAY = dt.date(2026, 2, 10)


def params(day, purge=True, ahead=30):
    return refresh.RefreshParams(day, dt.datetime.combine(day, dt.time(2, 5)), ahead, Decimal(25), Decimal(500), purge)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(os.path.join(root, "data")) for f in names if f.endswith(".parquet"))


def test_commits_survive_crashes(spark, tmp_path):
    root = str(tmp_path / "table")

    def count():
        return spark.read.parquet(versions.current(spark, root).parts["rows"]).count()

    assert versions.current(spark, root) == versions.Version()
    assert versions.commit(spark, root, 0, {"rows": spark.range(1)}).number == 1
    spark.range(2).write.parquet(f"{root}/data/left-by-a-crash")  # died before its commit
    assert count() == 1
    begun = tmp_path / "table" / "commits" / "000002.json"
    begun.write_text('{"parts"')  # died within its commit
    (tmp_path / "table" / "commits" / ".000002.json.crc").unlink(missing_ok=True)
    assert count() == 1
    with pytest.raises(versions.Conflict):  # it may still be alive
        versions.commit(spark, root, 1, {"rows": spark.range(2)})
    os.utime(begun, (0, 0))
    reader = spark.read.parquet(versions.current(spark, root).parts["rows"])
    assert versions.commit(spark, root, 1, {"rows": spark.range(2)}).number == 2
    assert reader.count() == 1 and count() == 2  # a reader of the old version is not disturbed
    versions.commit(spark, root, 2, {"rows": spark.range(3), "same": versions.current(spark, root).parts["rows"]})
    assert versions.clean(spark, root, keep=1) == [1, 2]
    now = versions.current(spark, root)
    assert count() == 3 and spark.read.parquet(now.parts["same"]).count() == 2  # still named by the version kept


def test_two_writers(spark, tmp_path):
    """The second of two writers on one version fails; doing its work again keeps both updates."""
    root = str(tmp_path / "table")
    versions.commit(spark, root, 0, {"a": spark.range(1)})
    one, two = versions.current(spark, root), versions.current(spark, root)
    versions.commit(spark, root, one.number, {**one.parts, "b": spark.range(2)})
    with pytest.raises(versions.Conflict):
        versions.commit(spark, root, two.number, {**two.parts, "c": spark.range(3)})
    two = versions.current(spark, root)
    assert set(versions.commit(spark, root, two.number, {**two.parts, "c": spark.range(3)}).parts) == {"a", "b", "c"}


def log(i, unit, task, day, hours=None):
    return (i, unit, task, day, None if hours is None else Decimal(hours), None, None, None, None, None)


def test_two_writers_of_last_log(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "last_log")
    first, second, third = (spark.createDataFrame([log(k, k, 1, DAY)], MAINTENANCE_LOG) for k in (1, 2, 3))
    due.update_last_log_store(spark, "first", first, root)
    stale = versions.current(spark, root)
    due.update_last_log_store(spark, "second", second, root)
    current = versions.current
    with monkeypatch.context() as m:
        m.setattr(versions, "current", lambda *a: stale)
        with pytest.raises(versions.Conflict):
            due.update_last_log_store(spark, "third", third, root)
    assert versions.current is current
    assert sorted(r.equipment_id for r in due.update_last_log_store(spark, "third", third, root).collect()) == [1, 2, 3]


def test_last_log_rewrites_only_touched_buckets(spark, tmp_path):
    root = str(tmp_path / "last_log")
    many = spark.createDataFrame([log(k, k, 1, DAY) for k in range(200)], MAINTENANCE_LOG)
    due.update_last_log_store(spark, "all", many, root, n=16)
    before = versions.current(spark, root)
    due.update_last_log_store(spark, "one", spark.createDataFrame([log(999, 7, 1, DAY + dt.timedelta(3))], MAINTENANCE_LOG), root)
    after = versions.current(spark, root)
    assert len(due_store.kept_buckets(before, after, "last_log")) == len(before.parts) - 1 == 15


def test_refreshing_twice_writes_no_data(spark, tmp_path):
    t, root = seed_tables(spark, DAY), str(tmp_path / "due")
    one = due_store.refresh_store(spark, root, t, params(DAY))
    listed = rows(due_store.read_due(spark, root))
    assert len(listed) == 5
    # with a feed of no changes nothing but the commit is written; a full one writes its values, never the due list
    nothing = spark.createDataFrame([], "equipment_id bigint")
    written = [f for f in files(root) if "/_bucket=" in f]
    two = due_store.refresh_store(spark, root, t, params(DAY), nothing)
    assert [f for f in files(root) if "/_bucket=" in f] == written and two.parts == one.parts
    three = due_store.refresh_store(spark, root, t, params(DAY))
    due_parts = {n: p for n, p in one.parts.items() if n.startswith("due/")}
    assert {n: p for n, p in three.parts.items() if n.startswith("due/")} == due_parts
    assert rows(due_store.read_due(spark, root)) == listed
    # the next day rows have a new computed_at and days_until_due, but no file changes while no row enters or turns overdue
    four = due_store.refresh_store(spark, root, t, params(DAY + dt.timedelta(1)), nothing)
    later = due_store.read_due(spark, root).collect()
    assert {r.computed_at for r in later} == {dt.datetime(2026, 2, 11, 2, 5)}
    assert len([n for n, p in four.parts.items() if due_parts.get(n) == p]) >= len(due_parts) - 2


def test_conflicting_refreshes(spark, tmp_path, monkeypatch):
    t, root = seed_tables(spark, DAY), str(tmp_path / "due")
    due_store.refresh_store(spark, root, t, params(DAY))
    stale = versions.current(spark, root)
    due_store.refresh_store(spark, root, t, params(DAY + dt.timedelta(1)))
    with monkeypatch.context() as m:
        m.setattr(versions, "current", lambda *a: stale)
        with pytest.raises(versions.Conflict):
            due_store.refresh_store(spark, root, t, params(DAY + dt.timedelta(2)))
    assert versions.current(spark, root).number == 2


def stored_chain(spark, root, steps):
    for t, p, changed in steps:
        due_store.refresh_store(spark, root, t, p, changed, n=8)
    return rows(due_store.read_due(spark, root))


def test_keep_mode_equals_the_whole_frame(spark, tmp_path):
    """Rows that are no longer staged keep the time and days of the last refresh that did."""
    days = [DAY, DAY + dt.timedelta(40), DAY + dt.timedelta(45)]
    t = seed_tables(spark, DAY)
    later = t.with_(maintenance_log=t.maintenance_log.unionByName(t.maintenance_log.withColumns({"id": F.col("id") + 50, "performed_on": F.lit(days[1])})))
    whole = None
    for k, day in enumerate(days):
        whole = refresh.refresh_due(t if k == 0 else later, whole, params(day, purge=False)).checkpoint()
    got = stored_chain(spark, str(tmp_path / "due"), [(t if k == 0 else later, params(day, purge=False), None) for k, day in enumerate(days)])
    assert got == rows(whole) and len({r[1] for r in got}) > 1
    assert DUE_SOON.fieldNames()[1] == "computed_at"


def big_tables(spark, random_):
    """The seed scaled to 60 units with rules of every kind."""
    t = seed_tables(spark, DAY)
    units = [
        (i, f"u{i}", None, random_.choice([1, 2]), random_.choice([1, 2]), None, True, Decimal(random_.randint(0, 900)), None, dt.datetime(2025, 1, 1) + dt.timedelta(days=random_.randint(0, 300)))
        for i in range(1, 61)
    ]
    tasks = spark.createDataFrame([(i, f"t{i}", None, None) for i in range(1, 7)], MAINTENANCE_TASK)
    return t.with_(equipment=spark.createDataFrame(units, EQUIPMENT), maintenance_task=tasks)


def rule(i, task, kind, value, model=None, unit=None, part=None, active=True):
    r = dict.fromkeys(MAINTENANCE_RULE.fieldNames())
    r |= {"id": i, "task_id": task, "frequency_type": kind, "value_numeric": Decimal(value), "active": active}
    r |= {"equipment_model_id": model, "equipment_id": unit, "part_type_id": part, "is_default": False}
    return tuple(r[c] for c in MAINTENANCE_RULE.fieldNames())


def component(i, unit, part, removed=None):
    return (i, unit, part, f"s{i}", None, dt.datetime(2025, 1, 1), removed, None)


def test_change_driven_equals_full(spark, tmp_path):
    """Days with new logs, meters, components, rules and gone rules; units that nothing happens to turn due by the calendar."""
    random_ = random.Random(11)
    t = big_tables(spark, random_)
    rules = [
        rule(1, 1, "DAYS", 45, model=1), rule(2, 1, "WEEKS", 9, model=2), rule(3, 2, "MONTHS", 3, model=1), rule(4, 2, "HOURS", 300, model=2),
        rule(5, 3, "DAYS", 20, part=1), rule(6, 1, "DAYS", 10, unit=7), rule(7, 4, "HOURS", 100, model=1),
    ]
    comps = [component(i, random_.randint(1, 60), random_.choice([1, 2]), random_.choice([None, None, dt.datetime(2025, 6, 1)])) for i in range(1, 40)]
    logs = [log(i, random_.randint(1, 60), random_.randint(1, 4), dt.date(2025, 6, 1) + dt.timedelta(days=random_.randint(0, 200)), random_.randint(0, 500)) for i in range(1, 150)]
    units = {r.id: r for r in t.equipment.collect()}
    root, whole, last_id = str(tmp_path / "due"), None, 0
    day = dt.date(2026, 1, 1)
    touched = []
    for step in range(6):
        feed = {}
        if step:
            day += dt.timedelta(days=random_.choice([1, 1, 17]))
            new_logs = [log(1000 * step + i, random_.randint(1, 60), random_.randint(1, 4), day, random_.randint(0, 900)) for i in range(3)]
            logs += new_logs
            feed["logs"] = spark.createDataFrame(new_logs, MAINTENANCE_LOG)
            if step == 2:
                units[5] = units[5].__class__(**{**units[5].asDict(), "engine_hours": Decimal(2000)})
                feed["equipment"] = spark.createDataFrame([units[5]], EQUIPMENT)
            if step == 3:
                comps.append(component(500, 9, 1))
                feed["components"] = spark.createDataFrame(comps[-1:], EQUIPMENT_COMPONENT)
            if step == 4:
                changed = [rules[5], rule(6, 1, "DAYS", 10, unit=7, active=False), rule(20, 3, "DAYS", 5, part=2)]
                rules[5] = changed[1]
                rules.append(changed[2])
                feed["rules"] = spark.createDataFrame(changed, MAINTENANCE_RULE)
        now = t.with_(
            equipment=spark.createDataFrame(list(units.values()), EQUIPMENT),
            maintenance_rule=spark.createDataFrame(rules, MAINTENANCE_RULE),
            equipment_component=spark.createDataFrame(comps, EQUIPMENT_COMPONENT),
            maintenance_log=spark.createDataFrame(logs, MAINTENANCE_LOG),
        )
        p = params(day, ahead=7)
        before = versions.current(spark, root)
        after = due_store.refresh_store(spark, root, now, p, due_store.changed_units(now, **feed) if step else None, n=32)
        touched.append(len([n for n in after.parts if n.startswith("values/")]) - len(due_store.kept_buckets(before, after, "values")))
        stage = due.stage(refresh.due_values(now), p.as_of, p.computed_at, p.days_ahead, p.hours_ahead, p.km_ahead)
        whole = snapshot.initial_snapshot(stage) if whole is None else snapshot.upsert(whole, stage, True, last_id)
        whole = whole.checkpoint()
        last_id = max(last_id, snapshot.max_id(whole))
        assert rows(due_store.read_due(spark, root)) == rows(whole), step
    assert touched[1] < touched[0] and min(touched[1:]) <= 4


def test_reading_some_buckets_lists_only_their_files(spark, tmp_path):
    root = str(tmp_path / "table")
    df = spark.range(500).select(F.col("id").alias("equipment_id"))
    parts = buckets.write(df, root, "x", ["equipment_id"], 16)
    some = buckets.read(spark, parts, "x", df.schema, [3, 5])
    assert {f.split("_bucket=")[1].split("/")[0] for f in some.inputFiles()} == {"3", "5"}
    assert some.count() == df.where(buckets.bucket(["equipment_id"], 16).isin(3, 5)).count()
    assert buckets.read(spark, parts, "x", df.schema).count() == 500
    assert buckets.read(spark, parts, "x", df.schema, [99]).count() == 0
