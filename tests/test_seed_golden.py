"""Golden results of the reference's seed scenario at pinned dates (values derived by hand in FIXTURES.md)."""

import datetime as dt
from decimal import Decimal

import pytest

from upkeep.plans import refresh, views
from upkeep.sources.seed import seed_tables

DEFAULTS = dict(days_ahead=30, hours_ahead=25, km_ahead=500)


def _refresh(spark, as_of, old=None, purge=True, **kw):
    t = seed_tables(spark, as_of)
    p = refresh.RefreshParams(as_of, dt.datetime.combine(as_of, dt.time(2, 5)), purge=purge, **{**DEFAULTS, **kw})
    return t, refresh.refresh_due(t, old, p)


def _rows(df):
    return sorted(
        (r.equipment_id, r.task_id, r.rule_id, r.next_due_date, r.days_until_due, r.next_due_at_hours,
         r.hours_remaining, r.next_due_at_km, r.km_remaining, r.severity)
        for r in df.collect()
    )


def test_matched_rules(spark):
    t = seed_tables(spark, dt.date(2026, 2, 10))
    got = sorted((r.equipment_id, r.rule_id, r.precedence) for r in refresh.matched_rules(t).collect())
    assert got == [(1, 1, 2), (1, 2, 2), (1, 4, 3), (2, 3, 2), (3, 4, 3), (3, 5, 2)]


def test_refresh_2026_02_10(spark):
    _, snap = _refresh(spark, dt.date(2026, 2, 10))
    D = Decimal
    assert _rows(snap) == sorted([
        (3, 4, 4, dt.date(2026, 3, 10), 28, None, None, None, None, "DUE_SOON"),
        (1, 2, 2, None, None, D("500.00"), D("5.00"), None, None, "DUE_SOON"),
        (1, 1, 1, None, None, D("510.00"), D("15.00"), None, None, "DUE_SOON"),
        (1, 4, 4, dt.date(2025, 7, 6), -219, None, None, None, None, "OVERDUE"),
        (3, 1, 5, None, None, None, None, D("10000.00"), D("0.00"), "OVERDUE"),
    ])


def test_refresh_2026_12_03_truck_tires_outside_window(spark):
    t, snap = _refresh(spark, dt.date(2026, 12, 3))
    got = _rows(snap)
    assert len(got) == 4
    assert (1, 4, 4, dt.date(2026, 4, 29), -218, None, None, None, None, "OVERDUE") in got
    assert all(r[0:3] != (3, 4, 4) for r in got)
    summary = {(r.company, r.severity): r.total for r in views.due_summary(t, snap).collect()}
    assert summary == {("Acme Farms", "DUE_SOON"): 2, ("Acme Farms", "OVERDUE"): 2}


def test_summary_and_ordered_view(spark):
    t, snap = _refresh(spark, dt.date(2026, 2, 10))
    summary = {(r.company, r.severity): r.total for r in views.due_summary(t, snap).collect()}
    assert summary == {("Acme Farms", "DUE_SOON"): 3, ("Acme Farms", "OVERDUE"): 2}
    ordered = [(r.equipment, r.task) for r in views.due_ordered(t, snap).collect()]
    assert ordered == [
        ("Truck TR-9", "Inspect Tires"),
        ("Tractor T-100", "Replace Oil Filter"),
        ("Tractor T-100", "Change Engine Oil"),
        ("Tractor T-100", "Inspect Tires"),
        ("Truck TR-9", "Change Engine Oil"),
    ]
    assert {r.severity for r in views.due_view(t, snap).collect()} <= {"OVERDUE", "DUE_SOON"}


def test_query_a_current_components(spark):
    t = seed_tables(spark, dt.date(2026, 2, 10))
    got = sorted((r.id, r.farm_name, r.company_name) for r in views.current_components(t, 1).collect())
    assert got == [(1, "North Farm", "Acme Farms"), (2, "North Farm", "Acme Farms"), (3, "North Farm", "Acme Farms")]


@pytest.mark.parametrize("auto, action", [(True, "INSPECT"), (False, "REPLACE")])
def test_query_b_timeline(spark, auto, action):
    d = dt.date(2026, 2, 10)
    t = seed_tables(spark, d, auto_detail=auto)
    got = [tuple(r) for r in views.maintenance_timeline(t, 1).collect()]
    assert got == [
        (d - dt.timedelta(days=150), "Replace Oil Filter", action, "FILTER_OIL", "North Farm", "Acme Farms"),
        (d - dt.timedelta(days=200), "Change Engine Oil", None, None, "North Farm", "Acme Farms"),
    ]


@pytest.mark.parametrize(
    "as_of, expected",
    [
        (dt.date(2026, 2, 10), {("Tractor T-100", dt.date(2025, 7, 6)), ("Combine C-200", dt.date(2025, 10, 16)),
                                ("Truck TR-9", dt.date(2026, 3, 10))}),
        (dt.date(2026, 12, 3), {("Tractor T-100", dt.date(2026, 4, 29)), ("Combine C-200", dt.date(2026, 8, 6))}),
    ],
)
def test_query_c_unscoped(spark, as_of, expected):
    t = seed_tables(spark, as_of)
    got = {(r.equipment, r.next_due) for r in views.month_rules_due(t, as_of).collect()}
    assert got == expected


def test_month_end_clamp(spark):
    _, snap = _refresh(spark, dt.date(2026, 7, 31))
    truck = [r for r in snap.collect() if r.equipment_id == 3 and r.rule_id == 4]
    assert [(r.next_due_date, r.days_until_due) for r in truck] == [(dt.date(2026, 8, 28), 28)]


def test_refresh_twice_is_stable(spark):
    d = dt.date(2026, 2, 10)
    _, first = _refresh(spark, d)
    _, second = _refresh(spark, d, old=first)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_purge_off_keeps_stale_rows(spark):
    _, old = _refresh(spark, dt.date(2026, 2, 10))
    _, purged = _refresh(spark, dt.date(2026, 12, 3), old=old, purge=True)
    _, kept = _refresh(spark, dt.date(2026, 12, 3), old=old, purge=False)
    pk = {(r.equipment_id, r.task_id, r.rule_id): r.id for r in purged.collect()}
    kk = {(r.equipment_id, r.task_id, r.rule_id): r.id for r in kept.collect()}
    assert (3, 4, 4) not in pk and (3, 4, 4) in kk
    old_ids = {(r.equipment_id, r.task_id, r.rule_id): r.id for r in old.collect()}
    assert all(kk[k] == old_ids[k] for k in old_ids)  # ids survive the upsert


def test_results_do_not_depend_on_the_session_time_zone(spark):
    d = dt.date(2026, 2, 10)

    def run():
        t, snap = _refresh(spark, d)
        return sorted(map(repr, snap.collect())), sorted(map(repr, views.current_components(t).collect()))

    utc = run()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert run() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
