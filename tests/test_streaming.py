"""Streaming triggers (T-01, T-02) fold to exactly the batch results."""

import datetime as dt
import os
import random

import pytest

from pyspark.sql.types import StructField, StructType

from upkeep.operators import buckets, history, versions
from upkeep.sources.schemas import EQUIPMENT_COMPONENT, MAINTENANCE_LOG, MAINTENANCE_LOG_DETAIL
from upkeep.streaming import history_stream
from upkeep.streaming.history_stream import close_batch, in_order, run_auto_detail_stream, run_close_previous_stream, shuffled

T0 = dt.datetime(2026, 1, 1)


def test_stream_slot_closing_equals_batch(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1, 301):
        slot = rng.choice(["A", "B", "C", None])
        rem = T0 + dt.timedelta(days=rng.randint(0, 50)) if rng.random() < 0.1 else None
        rows.append((i, rng.randint(1, 5), rng.randint(1, 9), slot, None, T0 + dt.timedelta(days=rng.randint(0, 99)), rem, None))
    comps = spark.createDataFrame(rows, EQUIPMENT_COMPONENT)
    streamed = {r.id: tuple(r) for r in run_close_previous_stream(spark, comps, batches=5).collect()}
    batch = {r.id: tuple(r) for r in history.close_previous(comps).collect()}
    assert streamed == batch


def component(i, unit, slot, day, removed=None):
    return (i, unit, 1, slot, None, T0 + dt.timedelta(days=day), removed, None)


def test_late_arrivals_are_linked_anew(spark, tmp_path, monkeypatch):
    """Ids in any order, several arrivals a slot, rows that arrive closed, and enough batches to rewrite the past."""
    monkeypatch.setattr(history_stream, "PIECES", 2)
    rng = random.Random(8)
    rows = [component(i, rng.randint(1, 3), rng.choice(["A", "B", None]), rng.randint(0, 99), T0 if rng.random() < 0.1 else None) for i in range(1, 201)]
    comps = spark.createDataFrame(rows, EQUIPMENT_COMPONENT)
    streamed = {r.id: tuple(r) for r in run_close_previous_stream(spark, comps, 6, shuffled, str(tmp_path / "s"), 2).collect()}
    assert streamed == {r.id: tuple(r) for r in history.close_previous(comps).collect()}
    parts = versions.current(spark, str(tmp_path / "s" / "state")).parts
    assert max(sum(n.startswith(f"past/{b}/") for n in parts) for b in range(2)) <= 2


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    state = str(tmp_path / "state")

    def frame(rows):
        return spark.createDataFrame(rows, EQUIPMENT_COMPONENT)

    close_batch(spark, state, str(tmp_path / "b0"), frame([component(i, i, "A", 0) for i in range(1, 101)]), 0, 16)
    before = versions.current(spark, state)
    listing = {p: sorted(os.listdir(p)) for p in before.parts.values()}
    batch = frame([component(500, 7, "A", 5), component(501, 8, None, 5)])
    close_batch(spark, state, str(tmp_path / "b1"), batch, 1)
    after = versions.current(spark, state)
    same = [n for n in before.parts if after.parts[n] == before.parts[n]]
    assert len(same) == len(before.parts) - 1 and all(sorted(os.listdir(after.parts[n])) == listing[before.parts[n]] for n in same)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "b1")).collect()) == [7, 500, 501]
    close_batch(spark, state, str(tmp_path / "b1"), batch, 1)  # replayed after its commit: nothing is done again
    assert versions.current(spark, state) == after


def test_replay_after_a_crash_before_the_commit(spark, tmp_path, monkeypatch):
    state, events = str(tmp_path / "state"), str(tmp_path / "b0")
    batch = spark.createDataFrame([component(1, 1, "A", 0), component(2, 1, "A", 3)], EQUIPMENT_COMPONENT)

    def crash(*args):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", crash)
        with pytest.raises(RuntimeError):
            close_batch(spark, state, events, batch, 0)
    first = sorted(map(tuple, spark.read.parquet(events).collect()), key=str)
    close_batch(spark, state, events, batch, 0)
    assert sorted(map(tuple, spark.read.parquet(events).collect()), key=str) == first and versions.current(spark, state).number == 1


def test_empty_input(spark):
    nothing = spark.createDataFrame([], EQUIPMENT_COMPONENT)
    for deal in (in_order, shuffled):
        assert run_close_previous_stream(spark, nothing, 2, deal).collect() == []
    details = spark.createDataFrame([(5, 1, 10, "REPLACE", None, None, None, None)], MAINTENANCE_LOG_DETAIL)
    kept = run_auto_detail_stream(spark, details, spark.createDataFrame([], MAINTENANCE_LOG))
    assert [tuple(r) for r in kept.collect()] == [tuple(r) for r in details.collect()]


def test_stream_auto_detail_equals_batch(spark):
    logs = spark.createDataFrame(
        [(i, 1, 1, dt.date(2026, 1, 1), None, None, None, i * 10 if i % 2 else None, None, None) for i in range(1, 41)],
        MAINTENANCE_LOG,
    )
    details = spark.createDataFrame([(5, 1, 10, "REPLACE", None, None, None, None)], MAINTENANCE_LOG_DETAIL)
    streamed = sorted(map(tuple, run_auto_detail_stream(spark, details, logs, batches=3).collect()))
    batch = sorted(map(tuple, history.insert_logs_with_trigger(details, logs).collect()))
    assert streamed == batch
    assert len(batch) == 21


def test_an_arrival_is_linked_in_one_pass(spark):
    """The same changes as by resolving the known rows and all rows apart, across id buckets; whole rows are dealt once."""
    rng = random.Random(5)
    rows = [component(i, rng.randint(1, 4), rng.choice(["A", "B", None]), rng.randint(0, 99), T0 if rng.random() < 0.2 else None) for i in range(1, 401)]
    rng.shuffle(rows)
    known, batch = (spark.createDataFrame(part, EQUIPMENT_COMPONENT).repartition(4) for part in (rows[:250], rows[250:]))
    before = {r.id: r.removed_at for r in history.close_previous(known).collect()}
    after = history.close_previous(known.unionByName(batch)).collect()
    want = sorted(tuple(r) for r in after if r.id not in before or before[r.id] != r.removed_at)
    for bucket_ids in (1000, 37, 1):
        assert sorted(map(tuple, history.relinked(known, batch, bucket_ids=bucket_ids).collect())) == want
    plan = history.relinked(known, batch)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("part_type_id") and "hashpartitioning(id" not in plan


def test_rows_meet_in_one_shuffle_and_the_state_is_written_from_there(spark, tmp_path, monkeypatch):
    """Late arrivals, rows without a unit and repeated slots: nothing is checkpointed, whole rows are dealt once, the state is whole."""
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda *a, **k: pytest.fail("rows were written a second time"))
    rng = random.Random(11)
    rows = [component(i, rng.choice([1, 2, 3, None]), rng.choice(["A", "B", None]), rng.randint(0, 99), T0 if rng.random() < 0.1 else None) for i in range(1, 121)]
    rng.shuffle(rows)
    loose = StructType([StructField(f.name, f.dataType, True) for f in EQUIPMENT_COMPONENT.fields])
    state, seen = str(tmp_path / "state"), []
    for k in range(3):
        part = rows[40 * k : 40 * k + 40]
        close_batch(spark, state, str(tmp_path / f"batch={k}"), spark.createDataFrame(part, loose), k, 4)
        seen += [r for r in part if r[3] is not None]
        parts = versions.current(spark, state).parts
        tail, past = (sorted((tuple(r) for n, p in parts.items() if n.startswith(kind) for r in spark.read.schema(loose).parquet(p).collect()), key=str) for kind in ("tail", "past"))
        slots = {r[1::2][:2] for r in seen if r[1] is not None}
        top = sorted((max(r for r in seen if (r[1], r[3]) == s) for s in slots), key=str)
        assert tail == top and sorted(tail + past, key=str) == sorted(seen, key=str)
    known, batch = (spark.createDataFrame(part, loose).repartition(4) for part in (rows[:60], rows[60:]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = history.linked(known.where("equipment_id IS NOT NULL"), batch, deal=[buckets.piece(history.SLOT, 4, 8)])
        plan = out.where("NOT _last")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning(_deal_0") == 1  # the others are of hot slots only


def test_slots_are_closed_alike_whether_hot_or_not(spark):
    rng = random.Random(4)
    rows = [component(i, rng.randint(1, 3), rng.choice(["A", "B", None]), rng.randint(0, 99), T0 if rng.random() < 0.1 else None) for i in range(1, 301)]
    comps = spark.createDataFrame(rows, EQUIPMENT_COMPONENT)
    want = sorted(map(tuple, history.close_previous(comps).collect()), key=str)
    for most in (60, 10, 1):
        assert sorted(map(tuple, history.close_previous(comps, bucket_ids=most).collect()), key=str) == want
    plan = history.close_previous(comps).where("id > 0")
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("min_by") == 0  # no first row per slot is gathered while no slot is hot
