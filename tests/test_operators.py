"""Edge cases (FIXTURES.md section 4) and operator properties."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from upkeep.functions.intervals import add_frequency
from upkeep.operators import due, history, load, snapshot
from upkeep.operators.ids import with_offsets, with_sequence
from upkeep.plans import refresh
from upkeep.sources.schemas import EQUIPMENT_COMPONENT, MAINTENANCE_RULE
from upkeep.sources.seed import seed_tables

T0 = dt.datetime(2026, 1, 1)


def ts(day):
    return T0 + dt.timedelta(days=day)


def comp_rows(rows):
    return [(i, e, 1, slot, None, ts(inst), None if rem is None else ts(rem), None) for i, e, slot, inst, rem in rows]


def test_slot_closing_arrival_order(spark):
    df = spark.createDataFrame(comp_rows([(1, 1, "S", 10, None), (2, 1, "S", 20, 15), (3, 1, "S", 5, None), (4, 1, "S", 40, None)]),
                               EQUIPMENT_COMPONENT)
    got = {r.id: r.removed_at for r in history.close_previous(df).collect()}
    assert got == {1: ts(20), 2: ts(15), 3: ts(40), 4: None}


def test_null_slot_never_closed(spark):
    df = spark.createDataFrame(comp_rows([(1, 1, None, 10, None), (2, 1, None, 20, None)]), EQUIPMENT_COMPONENT)
    assert [r.removed_at for r in history.close_previous(df).collect()] == [None, None]


def _sequential(rows):
    """The trigger, one row at a time."""
    table = []
    for i, e, slot, inst, rem in sorted(rows):
        if slot is not None:
            for r in table:
                if r[1] == e and r[2] == slot and r[4] is None:
                    r[4] = inst
        table.append([i, e, slot, inst, rem])
    return {r[0]: r[4] for r in table}


def test_slot_closing_matches_sequential_loop(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1, 400):
        rem = rng.randint(0, 99) if rng.random() < 0.2 else None
        rows.append((i, rng.randint(1, 6), rng.choice(["A", "B", None]), rng.randint(0, 99), rem))
    df = spark.createDataFrame(comp_rows(rows), EQUIPMENT_COMPONENT)
    got = {r.id: r.removed_at for r in history.close_previous(df).collect()}
    want = {k: None if v is None else ts(v) for k, v in _sequential(rows).items()}
    assert got == want


def test_hot_slot_split_path_is_exact(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1, 600):
        hot = rng.random() < 0.6
        rem = rng.randint(0, 99) if rng.random() < 0.15 else None
        rows.append((i, 1 if hot else rng.randint(2, 6), "H" if hot else rng.choice(["A", None]), rng.randint(0, 99), rem))
    df = spark.createDataFrame(comp_rows(rows), EQUIPMENT_COMPONENT)
    got = {r.id: r.removed_at for r in history.close_previous(df, bucket_ids=50).collect()}
    want = {k: None if v is None else ts(v) for k, v in _sequential(rows).items()}
    assert got == want


def test_incremental_closing_equals_batch(spark):
    rows = [(1, 1, "S", 10, None), (2, 1, "S", 20, None), (3, 2, "S", 5, None), (4, 1, "S", 40, None), (5, 2, "S", 9, None)]
    full = history.close_previous(spark.createDataFrame(comp_rows(rows), EQUIPMENT_COMPONENT))
    first = history.close_previous(spark.createDataFrame(comp_rows(rows[:3]), EQUIPMENT_COMPONENT))
    batch = spark.createDataFrame(comp_rows(rows[3:]), EQUIPMENT_COMPONENT)
    touched = history.close_previous_incremental(first, batch)
    merged = {r.id: r.removed_at for r in first.collect()}
    merged.update({r.id: r.removed_at for r in touched.collect()})
    assert merged == {r.id: r.removed_at for r in full.collect()}


def test_with_sequence_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("v"))
    got = with_sequence(df, ["k"], "seq", start_after=100, num_partitions=7)
    want = df.withColumn("seq", F.row_number().over(Window.orderBy("k")) + 100)
    assert sorted(map(tuple, got.select("k", "seq").collect())) == sorted(map(tuple, want.select("k", "seq").collect()))


def test_with_sequence_leaves_no_cache(spark):
    jsc = spark.sparkContext._jsc
    before = jsc.getPersistentRDDs().size()
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).alias("k"))
    got = with_sequence(df, ["k"], "seq", start_after=5)
    want = df.withColumn("seq", F.row_number().over(Window.orderBy("k")) + 5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert jsc.getPersistentRDDs().size() == before


def test_rows_without_a_slot_bypass_the_window(spark):
    rows = [(i, 1, None, i, None) for i in range(1, 40)] + [(50, 1, "A", 1, None), (51, 1, "A", 2, None)]
    closed = history.close_previous(spark.createDataFrame(comp_rows(rows), EQUIPMENT_COMPONENT))
    assert [r.id for r in closed.where("removed_at is not null").collect()] == [50]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1.50", ["2026-02-01", "2026-02-10", "2026-03-15", "2027-07-31"]),
        ("0.25", ["2026-01-31", "2026-02-01", "2026-02-07", "2026-04-30"]),
        ("-1.50", ["2026-01-29", "2026-01-20", "2025-12-16", "2024-07-31"]),
        ("1.99", ["2026-02-01", "2026-02-13", "2026-03-29", "2028-01-31"]),
    ],
)
def test_fractional_intervals(spark, value, expected):
    df = spark.createDataFrame(
        [(f, Decimal(value)) for f in ("DAYS", "WEEKS", "MONTHS", "YEARS")], "f string, v decimal(10,2)"
    )
    got = [r.d.isoformat() for r in df.select(add_frequency(F.lit(dt.date(2026, 1, 31)), F.col("f"), F.col("v")).alias("d")).collect()]
    assert got == expected


def _stage(spark, t, as_of, **kw):
    p = refresh.RefreshParams(as_of, dt.datetime.combine(as_of, dt.time(2, 5)), **kw)
    return {(r.equipment_id, r.rule_id): r for r in refresh.due_stage(t, p).collect()}


def test_boundaries(spark):
    d = dt.date(2026, 2, 10)
    t = seed_tables(spark, d)
    # tractor oil: 15 h left; threshold exactly 15 -> DUE_SOON, 14.99 -> not staged
    assert _stage(spark, t, d, hours_ahead=15)[(1, 1)].severity == "DUE_SOON"
    assert (1, 1) not in _stage(spark, t, d, hours_ahead=Decimal("14.99"))
    # next date == as_of -> DUE_SOON (truck tires due 2026-03-10)
    assert _stage(spark, t, dt.date(2026, 3, 10))[(3, 4)].severity == "DUE_SOON"
    # remaining 0 -> OVERDUE
    assert _stage(spark, t, d)[(3, 5)].severity == "OVERDUE"


def test_null_and_negative_thresholds(spark):
    d = dt.date(2026, 2, 10)
    t = seed_tables(spark, d)
    no_days = _stage(spark, t, d, days_ahead=None, hours_ahead=None, km_ahead=None)
    assert all(r.next_due_date is None for r in no_days.values())  # NULL days drops every time row
    assert no_days[(1, 1)].severity == "DUE_SOON"  # NULL hours -> 25
    neg = _stage(spark, t, d, days_ahead=-30, hours_ahead=-5, km_ahead=-5)
    assert {r.severity for r in neg.values()} == {"OVERDUE"}
    assert (1, 4) in neg and (3, 5) in neg


def _with_rules(spark, t, extra):
    rules = t.maintenance_rule.unionByName(spark.createDataFrame(extra, MAINTENANCE_RULE))
    return t.with_(maintenance_rule=rules)


def test_cron_rule_and_tie_break_and_inactive(spark):
    d = dt.date(2026, 2, 10)
    t = seed_tables(spark, d)
    extra = [
        (9, 3, 1, None, None, "DAYS", Decimal("10"), None, None, None, True, False),
        (7, 3, 1, None, None, "DAYS", Decimal("20"), None, None, None, True, False),
        (8, 3, 2, None, None, "CRON", None, None, "0 0 * * *", None, True, False),
        (6, 3, 3, None, None, "DAYS", Decimal("1"), None, None, None, False, False),
    ]
    t = _with_rules(spark, t, extra)
    picked = {(r.equipment_id, r.task_id, r.frequency_type): r.rule_id for r in refresh.picked(t).collect()}
    assert picked[(1, 3, "DAYS")] == 7  # tie on precedence -> lowest rule id
    assert picked[(2, 3, "CRON")] == 8  # CRON wins its slot ...
    staged = _stage(spark, t, d)
    assert (2, 8) not in staged  # ... but never becomes due
    assert (3, 6) not in staged  # inactive rule ignored
    assert staged[(1, 7)].severity == "OVERDUE"


def test_inactive_equipment_still_due(spark):
    d = dt.date(2026, 2, 10)
    t = seed_tables(spark, d)
    t = t.with_(equipment=t.equipment.withColumn("active", F.lit(False)))
    assert len(_stage(spark, t, d)) == 5


def test_insert_if_absent_keep_first(spark):
    existing = spark.createDataFrame([(1, 10, 1)], "id long, equipment_id long, task_id long")
    batch = spark.createDataFrame([(3, 10, 1), (5, 11, 1), (4, 11, 1), (6, 12, 2)], "id long, equipment_id long, task_id long")
    got = sorted(r.id for r in load.insert_if_absent(existing, batch, ["equipment_id", "task_id"]).collect())
    assert got == [1, 4, 6]
    nulls = spark.createDataFrame([(7, None, 1), (8, None, 1)], "id long, equipment_id long, task_id long")
    got = sorted(r.id for r in load.insert_if_absent(existing, nulls, ["equipment_id", "task_id"]).collect())
    assert got == [1, 7, 8]  # NULL keys never match, so both pass the guard


def test_lookup_rejects_duplicate_natural_key(spark):
    rows = spark.createDataFrame([("a",)], "name string")
    dim = spark.createDataFrame([(1, "a"), (2, "a")], "id long, name string")
    with pytest.raises(ValueError):
        load.lookup_id(rows, dim, {"name": "name"})


@pytest.mark.parametrize("trigger_on, expected", [(True, [(2, "INSPECT")]), (False, [(2, "REPLACE")])])
def test_seed_detail_lines_follow_trigger_and_guard(spark, trigger_on, expected):
    from upkeep.sources.schemas import MAINTENANCE_LOG_DETAIL

    t = seed_tables(spark, dt.date(2026, 2, 10))
    empty = spark.createDataFrame([], MAINTENANCE_LOG_DETAIL)
    details = history.insert_logs_with_trigger(empty, t.maintenance_log) if trigger_on else empty
    start = details.count()
    replace_line = spark.createDataFrame(
        [(start + 1, 2, 1, "REPLACE", 1, 2, Decimal("1"), "Upgraded to Type B")], MAINTENANCE_LOG_DETAIL
    )
    out = load.insert_if_absent(details, replace_line, load.NATURAL_KEYS["maintenance_log_detail"])
    assert sorted((r.maintenance_log_id, r.action) for r in out.collect()) == expected


def test_scope_resolution_and_per_frequency_precedence(spark):
    """G-13: a unit rule ignores its model/part columns; a model rule ignores its part column.
    G-14: a unit MONTHS rule does not hide a model HOURS rule of the same task."""
    d = dt.date(2026, 2, 10)
    t = seed_tables(spark, d)
    extra = [
        (20, 1, 2, 1, 3, "MONTHS", Decimal("1"), None, None, None, True, False),  # unit 1, names model 2 / part 3
        (21, 3, 1, None, 5, "DAYS", Decimal("1"), None, None, None, True, False),  # model 1, part 5 never installed
    ]
    t = _with_rules(spark, t, extra)
    matched = {(r.equipment_id, r.rule_id): r.precedence for r in refresh.matched_rules(t).collect()}
    assert matched[(1, 20)] == 1 and (2, 20) not in matched  # only its unit, whatever the model column says
    assert matched[(1, 21)] == 2  # model scope applies although part 5 is not installed
    picked = {(r.equipment_id, r.task_id, r.frequency_type): r.rule_id for r in refresh.picked(t).collect()}
    assert picked[(1, 1, "MONTHS")] == 20 and picked[(1, 1, "HOURS")] == 1


def test_views_use_current_farm_and_group_by_company_name(spark):
    """G-20: farm/company come from the unit's current farm. G-21: the summary groups by company *name*."""
    d = dt.date(2026, 2, 10)
    t = seed_tables(spark, d)
    p = refresh.RefreshParams(d, dt.datetime(2026, 2, 10, 2, 5), 30, 25, 500)
    snap = refresh.refresh_due(t, None, p)
    moved = t.with_(equipment=t.equipment.withColumn("farm_id", F.when(F.col("id") == 3, F.lit(3)).otherwise(F.col("farm_id"))))
    from upkeep.plans import views

    truck = {(r.farm, r.company) for r in views.due_view(moved, snap).collect() if r.equipment_id == 3}
    assert truck == {("Valley Farm", "GreenFields Co.")}  # stored snapshot ids say South Farm / Acme
    renamed = t.with_(company=t.company.withColumn("name", F.lit("Same Name")))
    summary = {(r.company, r.severity): r.total for r in views.due_summary(renamed, snap).collect()}
    assert summary == {("Same Name", "DUE_SOON"): 3, ("Same Name", "OVERDUE"): 2}


def test_unit_without_farm_matches_rules_but_is_never_due(spark):
    d = dt.date(2026, 2, 10)
    t = seed_tables(spark, d)
    t = t.with_(equipment=t.equipment.withColumn("farm_id", F.when(F.col("id") == 1, F.lit(99)).otherwise(F.col("farm_id"))))
    matched = {(r.equipment_id, r.rule_id) for r in refresh.matched_rules(t).collect()}
    assert {(1, 1), (1, 2), (1, 4)} <= matched  # rule matching reads equipment itself
    assert all(k[0] != 1 for k in _stage(spark, t, d))  # the due branches join base (farm required)


def test_last_log_store_takes_late_lower_ids_and_repeats(spark, tmp_path):
    from upkeep.sources.schemas import MAINTENANCE_LOG

    root = str(tmp_path / "last_log")

    def log(i, day, hours):
        return (i, 1, 1, day, Decimal(hours), None, None, None, None, None)

    first = spark.createDataFrame([log(1, dt.date(2020, 1, 1), "10"), log(3, dt.date(2020, 2, 1), "20")], MAINTENANCE_LOG)
    late = spark.createDataFrame([log(2, dt.date(2023, 1, 1), "5")], MAINTENANCE_LOG)
    due.update_last_log_store(spark, "a", first, root)
    got = due.update_last_log_store(spark, "b", late, root)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, due.last_log(first.unionByName(late)).collect()))
    again = due.update_last_log_store(spark, "a", first, root)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_loading_twice_inserts_nothing_and_reinstalls(spark):
    t = seed_tables(spark, dt.date(2026, 2, 10))
    for name, rows in t.as_dict().items():
        if name != "maintenance_log_detail":
            first = load.load_table(name, rows.where(F.lit(False)), rows)
            assert load.load_table(name, first, rows).count() == 0, name
    rules = t.maintenance_rule
    assert load.load_table("maintenance_rule", rules, rules.withColumn("id", F.col("id") + 100)).count() == 0
    old = spark.createDataFrame(comp_rows([(1, 1, "A", 1, 5)]), EQUIPMENT_COMPONENT)
    new = spark.createDataFrame(comp_rows([(2, 1, "A", 9, None)]), EQUIPMENT_COMPONENT)
    assert [r.id for r in load.load_table("equipment_component", old, new).collect()] == [2]


def test_lookup_ignores_duplicates_nobody_asks_for(spark):
    rows = spark.createDataFrame([("a",), (None,)], "name string")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None), (5, None)], "id long, name string")
    assert {(r.name, r.ref_id) for r in load.lookup_id(rows, dim, {"name": "name"}).collect()} == {("a", 1), (None, None)}


def test_defaults_replace_omitted_columns_only(spark):
    rows = spark.createDataFrame([(1, None)], "id long, day date")
    out = load.append_with_defaults(rows, {"day": F.lit(dt.date(2026, 1, 1)), "active": F.lit(True)}).first()
    assert out.day is None and out.active is True


def test_computed_at_keeps_its_fraction(spark):
    d = dt.date(2026, 2, 10)
    t = seed_tables(spark, d)
    at = dt.datetime(2026, 2, 10, 2, 5, 0, 123456)
    assert {r.computed_at for r in refresh.due_stage(t, refresh.RefreshParams(d, at, 30, 25, 500)).collect()} == {at}


def test_a_cluster_must_name_its_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from upkeep import session

    sc = SimpleNamespace(master="spark://x:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(fake)


def test_offsets_by_key_number_rows_like_a_sequence(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(k, rng.randint(1, 5)) for k in rng.sample(range(1000), 300)], "k long, n long").repartition(5)
    total, want = 0, {}
    for k, n in sorted(map(tuple, df.collect())):
        want[k], total = total, total + n
    assert {r.k: r.before for r in with_offsets(df, "k", "n", "before", num_partitions=7).collect()} == want
    assert with_offsets(df.limit(0), "k", "n", "before").collect() == []
