"""Registered queries for history upkeep, loading, referential actions, data quality and date arithmetic.

Scenario values below pick *which* rows play which role (e.g. logs before 1999 are "already loaded"); every query
still reads its whole tables.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from upkeep.functions.intervals import add_days, add_months_frac, add_weeks, add_years_frac
from upkeep.operators import colocated, due, history, key_index, load, quality, quarantine, snapshot, stored
from upkeep.operators.ids import with_sequence
from upkeep.plans import oracle as O
from upkeep.plans import refresh, views
from upkeep.session import shared_path
from upkeep.sources import testdata as td
from upkeep.sources.schemas import METER, NOT_NULL, VARCHAR_LIMITS
from upkeep.sources.seed import seed_tables
from upkeep.sources.tables import YEAR_COL, read_table

# Fixed values of the scenarios.
ARCHIVE_BEFORE = dt.date(1996, 1, 1)  # logs before this are deleted (cascade / orphan scenarios)
LOADED_BEFORE = dt.date(1999, 1, 1)  # logs before this are "already in the table" for insert-if-absent
DELETED_COMPANY = "EUROPE"  # company removed in the ON DELETE SET NULL scenario
GONE_MODEL, GONE_TASK, GONE_FREQUENCY = 2, "3-MEDIUM", "KM"  # parents deleted in the snapshot cascades
PENDING_STATUS = "P"  # pending orders arrive without a performed_on date
COLOCATED_BUCKETS = 8  # of the stored sides of the due dates; large fleets take thousands
THRESHOLD_SETS = [("null", None, None, None), ("negative", -30, -5, -5), ("zero", 0, 0, 0)]


def _t(spark, sf_dir):
    return td.load(spark, sf_dir)


def _logs_between(logs, lo: dt.date | None = None, hi: dt.date | None = None):
    """Date-bounded log read; the redundant year bound lets Spark prune ``performed_year`` partitions."""
    out = logs
    if lo is not None:
        out = out.where((F.col("performed_on") >= F.lit(lo)) & (F.col(YEAR_COL) >= lo.year))
    if hi is not None:
        out = out.where((F.col("performed_on") < F.lit(hi)) & (F.col(YEAR_COL) <= hi.year))
    return out


def _logs_with_year(spark, sf_dir):
    return read_table(spark, td.materialize(spark, sf_dir), "maintenance_log", keep_year=True)


# --------------------------------------------------------------------------------------------------------------
# history


def q_close_previous(spark, sf_dir):
    t = _t(spark, sf_dir)
    as_inserted = t.equipment_component.withColumn("removed_at", F.lit(None).cast("timestamp_ntz"))
    return history.close_previous(as_inserted)


def _given_removed(t):
    lines = t.maintenance_log_detail.select("id", "action", "qty_used")
    given = F.when(
        F.col("action") == "REPLACE", F.expr("timestampadd(DAY, CAST(qty_used AS INT), installed_at)")
    )
    return t.equipment_component.drop("removed_at").join(lines, "id", "left").withColumn("removed_at", given)


def q_close_previous_history(spark, sf_dir):
    t = _t(spark, sf_dir)
    rows = _given_removed(t).select(*t.equipment_component.columns)
    return history.close_previous(rows)


def q_auto_detail(spark, sf_dir):
    t = _t(spark, sf_dir)
    return history.insert_logs_with_trigger(t.maintenance_log_detail, t.maintenance_log)


# --------------------------------------------------------------------------------------------------------------
# loading


def q_insert_if_absent(spark, sf_dir):
    logs = _logs_with_year(spark, sf_dir)
    cols = ["id", "equipment_id", "task_id", "performed_on"]
    existing = _logs_between(logs, hi=LOADED_BEFORE).select(*cols)
    batch = _logs_between(logs, lo=LOADED_BEFORE).select(*cols)
    return load.insert_if_absent(existing, batch, load.NATURAL_KEYS["maintenance_log"])


def _incoming_orders(spark, sf_dir):
    orders = spark.read.parquet(os.path.join(sf_dir, "orders.parquet"))
    tasks = _t(spark, sf_dir).maintenance_task.select(F.col("id").alias("task_id"), F.col("name").alias("o_orderpriority"))
    return orders.join(tasks, "o_orderpriority")


def q_append_defaults(spark, sf_dir):
    """Two inserts: pending orders leave performed_on out and get its default, the others name it."""
    rows = _incoming_orders(spark, sf_dir)
    cols = [F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("equipment_id"), "task_id"]
    pending = rows.where(F.col("o_orderstatus") == PENDING_STATUS).select(*cols)
    done = rows.where(F.col("o_orderstatus") != PENDING_STATUS).select(*cols, F.col("o_orderdate").cast("date").alias("performed_on"))
    return load.append_with_defaults(pending, {"performed_on": F.lit(td.AS_OF)}).unionByName(done)


def q_natural_key_lookup(spark, sf_dir):
    t = _t(spark, sf_dir)
    named = (
        t.maintenance_log.select(F.col("id").alias("log_id"), "equipment_id", "task_id")
        .join(t.equipment.select(F.col("id").alias("equipment_id"), F.col("display_name").alias("equipment_name"), "farm_id"), "equipment_id")
        .join(t.maintenance_task.select(F.col("id").alias("task_id"), F.col("name").alias("task_name")), "task_id")
        .join(t.farm.select(F.col("id").alias("farm_id"), F.col("name").alias("farm_name"), "company_id"), "farm_id")
        .join(t.company.select(F.col("id").alias("company_id"), F.col("name").alias("company_name")), "company_id")
        .select("log_id", "equipment_name", "task_name", "farm_name", "company_name")
    )
    farms = t.farm.join(t.company.select(F.col("id").alias("company_id"), F.col("name").alias("company_name")), "company_id")
    out = load.lookup_id(named, t.equipment, {"equipment_name": "display_name"}, as_name="equipment_id")
    out = load.lookup_id(out, t.maintenance_task, {"task_name": "name"}, as_name="task_id")
    out = load.lookup_id(out, farms, {"farm_name": "name", "company_name": "company_name"}, as_name="farm_id")
    return out.select("log_id", "equipment_id", "task_id", "farm_id")


# --------------------------------------------------------------------------------------------------------------
# referential actions


def q_cascade_delete(spark, sf_dir):
    t = _t(spark, sf_dir)
    deleted = _logs_between(_logs_with_year(spark, sf_dir), hi=ARCHIVE_BEFORE).select("id")
    return snapshot.cascade_delete(t.maintenance_log_detail, "maintenance_log_id", deleted)


def q_set_null_delete(spark, sf_dir):
    from upkeep.plans.catalog import stored_snapshot

    t, snap = stored_snapshot(spark, sf_dir)
    gone_company = t.company.where(F.col("name") == DELETED_COMPANY).select("id")
    gone_farms = t.farm.join(gone_company.select(F.col("id").alias("company_id")), "company_id", "left_semi").select("id")
    out = snapshot.set_null_on_delete(snap, "company_id", gone_company)
    return snapshot.set_null_on_delete(out, "farm_id", gone_farms)


# --------------------------------------------------------------------------------------------------------------
# data quality


def _all_tables(spark, sf_dir, purge: bool = True):
    """The ten tables and the snapshot computed from them."""
    from upkeep.plans.catalog import stored_snapshot

    t, snap = stored_snapshot(spark, sf_dir, purge)
    return {**t.as_dict(), "due_soon": snap}


def _spoilt(df, broken: dict):
    """Every row stays; of the n checked columns the j-th is broken where ``id % (n + 1) = j``."""
    turn = F.col("id") % F.lit(len(broken) + 1)
    return df.withColumns({c: F.when(turn == F.lit(j), bad).otherwise(F.col(c)) for j, (c, bad) in enumerate(broken.items())})


def q_dq_pk(spark, sf_dir):
    """Rows with even ids delivered twice, ids divisible by three lost."""

    def spoilt(df):
        twice = df.unionByName(df.where(F.col("id") % 2 == 0))
        return twice.withColumn("id", F.when(F.col("id") % 3 != 0, F.col("id")))

    return quality.pk_violations({n: spoilt(df) for n, df in _all_tables(spark, sf_dir).items()})


def q_dq_unique_model(spark, sf_dir):
    frames = _t(spark, sf_dir).as_dict()
    return quality._union(
        [quality.unique_violations(load.keyed(n, frames[n]), k, n) for n, k in load.NATURAL_KEYS.items()]
    )


def q_dq_unique_snapshot(spark, sf_dir):
    """Snapshot and stage with their overdue rows written twice."""
    from upkeep.plans.catalog import PARAMS, stored_snapshot

    def spoilt(df):
        return df.unionByName(df.where(F.col("severity") == due.OVERDUE))

    t, snap = stored_snapshot(spark, sf_dir, False)
    return quality.unique_violations(spoilt(snap), snapshot.KEY, "due_soon").unionByName(
        quality.unique_violations(spoilt(refresh.due_stage(t, PARAMS)), snapshot.KEY, "due_soon_stage")
    )


def q_dq_scope(spark, sf_dir):
    """Rules of the usage kinds without their scope."""
    scopes = ["equipment_model_id", "equipment_id", "part_type_id"]
    rules = _t(spark, sf_dir).maintenance_rule
    return quality.scope_violations(
        rules.withColumns({c: F.when(~F.col("frequency_type").isin("HOURS", "KM"), F.col(c)) for c in scopes})
    )


def q_dq_fk(spark, sf_dir):
    keys = [*quality.FOREIGN_KEYS, *quality.SNAPSHOT_FOREIGN_KEYS]
    whole = _all_tables(spark, sf_dir)
    children = dict.fromkeys(c for c, _, _ in keys)
    spoilt = {n: _spoilt(whole[n], {col: -1 - F.col("id") for c, col, _ in keys if c == n}) for n in children}
    return quality.fk_violations(spoilt, keys, whole)


def q_dq_not_null(spark, sf_dir):
    whole = _all_tables(spark, sf_dir)
    return quality.not_null_violations({n: _spoilt(df, dict.fromkeys(NOT_NULL[n], F.lit(None))) for n, df in whole.items()})


def q_dq_length(spark, sf_dir):
    tables = _t(spark, sf_dir).as_dict()
    return quality.length_violations(
        {n: _spoilt(df, {c: F.repeat(F.lit("x"), F.lit(k + 1)) for c, k in VARCHAR_LIMITS[n].items()}) for n, df in tables.items()}
    )


def q_dq_one_active(spark, sf_dir):
    t = _t(spark, sf_dir)
    raw = t.equipment_component.withColumn("removed_at", F.lit(None).cast("timestamp_ntz"))
    return quality.one_active_violations(raw, "as_inserted").unionByName(
        quality.one_active_violations(t.equipment_component, "after_trigger")
    )


# --------------------------------------------------------------------------------------------------------------
# partitions, date arithmetic, thresholds


def q_last_log_incremental(spark, sf_dir):
    """A stored last_log that takes the years in falling order, so lower ids and older dates come late, and one year
    twice; must equal the full aggregation."""
    import uuid

    from upkeep.session import shared_path

    logs = _logs_with_year(spark, sf_dir)
    root = shared_path(spark, "last_log", f"store-{uuid.uuid4().hex[:12]}")
    arrivals = [("recent", LOADED_BEFORE, None), ("archive", None, ARCHIVE_BEFORE), ("middle", ARCHIVE_BEFORE, LOADED_BEFORE)]
    for name, lo, hi in [*arrivals, arrivals[0]]:
        last = due.update_last_log_store(spark, name, _logs_between(logs, lo, hi).drop(YEAR_COL), root, n=16)
    return last


def q_natural_key_reload(spark, sf_dir):
    """Every table loaded into an empty one by its natural key, and loaded again: the second load inserts nothing."""
    frames = []
    for name, rows in _t(spark, sf_dir).as_dict().items():
        first = load.load_table(name, rows.where(F.lit(False)), rows)
        again = load.load_table(name, first, rows)
        frames += [
            df.agg(F.count(F.lit(1)).alias("inserted")).select(F.lit(name).alias("table_name"), F.lit(step).alias("load"), "inserted")
            for step, df in (("first", first), ("again", again))
        ]
    return quality._union(frames)


def q_natural_key_index(spark, sf_dir):
    """The same two loads against stored key indexes instead of the loaded tables."""
    frames = []
    for name, rows in _t(spark, sf_dir).as_dict().items():
        root = _scratch(spark, f"keys-{name}")
        for step in ("first", "again"):
            fresh = key_index.load_indexed(spark, root, name, rows, n=8)
            frames.append(
                fresh.agg(F.count(F.lit(1)).alias("inserted")).select(F.lit(name).alias("table_name"), F.lit(step).alias("load"), "inserted")
            )
    return quality._union(frames)


def q_seed_load(spark, sf_dir):
    """R-04: the seed's constant rows of the catalog tables inserted into the given ones, if absent by natural key; their ids
    continue, and parents are looked up by name. Returns what was inserted."""
    t, seed = _t(spark, sf_dir), seed_tables(spark, td.AS_OF)

    def inserted(name, rows):
        fresh = load.load_table(name, getattr(t, name), rows).drop("id").withColumnRenamed("_order", "order_")
        return with_sequence(fresh, ["order_"], "id", snapshot.max_id(getattr(t, name)))

    def ordered(name):
        return getattr(seed, name).withColumn("_order", F.col("id"))

    def found(name, rows):
        """Names and ids after the insert."""
        known = getattr(t, name).select("id", "name")
        return known.unionByName(rows.select("id", "name"))

    company, part = inserted("company", ordered("company")), inserted("part_type", ordered("part_type"))
    model = inserted("equipment_model", ordered("equipment_model"))
    farms = ordered("farm").join(seed.company.select(F.col("id").alias("company_id"), F.col("name").alias("company_name")), "company_id")
    farms = load.lookup_id(farms.drop("company_id"), found("company", company), {"company_name": "name"}, as_name="company_id")
    farm = inserted("farm", farms)
    tasks = ordered("maintenance_task").join(
        seed.part_type.select(F.col("id").alias("default_part_type_id"), F.col("name").alias("part_name")), "default_part_type_id", "left"
    )
    tasks = load.lookup_id(tasks.drop("default_part_type_id"), found("part_type", part), {"part_name": "name"}, as_name="default_part_type_id")
    task = inserted("maintenance_task", tasks)
    none = F.lit(None).cast("bigint")
    return quality._union(
        [
            rows.select(F.lit(name).alias("table_name"), "id", F.col(label).alias("name"), parent.alias("parent_id"))
            for name, rows, label, parent in (
                ("company", company, "name", none),
                ("farm", farm, "name", F.col("company_id")),
                ("equipment_model", model, "model_name", none),
                ("part_type", part, "name", none),
                ("maintenance_task", task, "name", F.col("default_part_type_id")),
            )
        ]
    )


def q_time_due_colocated(spark, sf_dir):
    """The due dates of the time rules from picked rules and last logs stored side by side."""
    t = _t(spark, sf_dir)
    path = _scratch(spark, "colocated")
    picked = colocated.store(refresh.picked(t), path, "picked", COLOCATED_BUCKETS)
    last = colocated.store(due.last_log(t.maintenance_log), path, "last_log", COLOCATED_BUCKETS)
    values = refresh.due_values(t, picked, last)
    return values.where(F.col("frequency_type").isin("DAYS", "WEEKS", "MONTHS", "YEARS")).select("equipment_id", "rule_id", "task_id", "next_due_date")


def q_stored_deletes(spark, sf_dir):
    """Old logs, the units of a model and a company deleted from the stored tables in one commit; what is left per table and
    year."""
    from upkeep.plans.catalog import stored_snapshot

    t, snap = stored_snapshot(spark, sf_dir)
    root = _scratch(spark, "stored")
    version = stored.publish(spark, root, td.materialize(spark, sf_dir), snap, n=16)
    old = _logs_between(stored.read_years(spark, version, "maintenance_log"), hi=ARCHIVE_BEFORE).select("id", YEAR_COL)
    units = t.equipment.where(F.col("equipment_model_id") == GONE_MODEL).select("id")
    companies = t.company.where(F.col("name") == DELETED_COMPANY).select("id")
    version = stored.delete(spark, root, logs=old, units=units, companies=companies)
    due_rows = stored.read_due(spark, version).withColumn(YEAR_COL, F.lit(None).cast("int"))
    frames = [(n, stored.read_years(spark, version, n)) for n in stored.HEADER]
    frames += [("due_soon", due_rows), ("due_soon without company", due_rows.where(F.col("company_id").isNull()))]
    return quality._union(
        [
            rows.groupBy(YEAR_COL).agg(F.count(F.lit(1)).alias("rows_left"), F.sum("id").cast("bigint").alias("id_sum")).withColumn("table_name", F.lit(name))
            for name, rows in frames
        ]
    )


def _broken_copies(name, df):
    """``df`` with the j-th of its k rules broken where ``id % (k + 1) = j``."""
    rules = quarantine.rules_of(name)
    turn = F.col("id") % F.lit(len(rules) + 1)
    changes: dict = {}
    for j, (rule, column) in enumerate(rules):
        bad = {"not_null": F.lit(None), "varchar": F.repeat(F.lit("x"), F.lit(VARCHAR_LIMITS.get(name, {}).get(column, 0) + 1)), "foreign_key": -1 - F.col("id"), "scope": F.lit(None)}
        for c in quarantine.SCOPES if rule == "scope" else [column]:
            if rule != "repeated_id":
                changes.setdefault(c, []).append((turn == F.lit(j), bad[rule]))
    twice = df.unionByName(df.where(turn == F.lit(len(rules) - 1)))  # the last rule: repeated ids

    def changed(c):
        out = F.col(c)
        for cond, value in changes[c]:
            out = F.when(cond, value).otherwise(out)
        return out

    return twice.select(*[changed(c).alias(c) if c in changes else F.col(c) for c in df.columns])


def q_dq_quarantine(spark, sf_dir):
    """Every rule broken in every table, screened in one pass per table: rows counted by the pass and rows listed."""
    whole = _all_tables(spark, sf_dir)
    root = _scratch(spark, "quarantine")
    frames = []
    for name, df in whole.items():
        seen = quarantine.screen(spark, root, name, _broken_copies(name, df), whole)
        counts = [(name, r, c, n) for (r, c), n in seen.counts.items()]
        every = spark.createDataFrame(counts, "table_name string, rule string, column_name string, violations bigint")
        listed = seen.offenders.groupBy("rule", "column_name").agg(F.count(F.lit(1)).alias("listed"))
        frames.append(every.join(listed, ["rule", "column_name"], "left").select(*every.columns, F.coalesce("listed", F.lit(0)).alias("listed")))
    return quality._union(frames)


def _scratch(spark, name: str) -> str:
    return shared_path(spark, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def _busiest_unit(t):
    """The unit with the most logs (lowest id of several): one scalar, the ``:eq_id`` of the reference's queries."""
    busiest = t.maintenance_log.groupBy("equipment_id").count().orderBy(F.desc("count"), "equipment_id").first()
    return busiest["equipment_id"] if busiest else -1


def q_unit_components(spark, sf_dir):
    t = _t(spark, sf_dir)
    return views.current_components(t, _busiest_unit(t))


def q_unit_timeline(spark, sf_dir):
    t = _t(spark, sf_dir)
    return views.maintenance_timeline(t, _busiest_unit(t))


def q_snapshot_cascades(spark, sf_dir):
    """Deleting a model's units, a task and the rules of a kind takes their snapshot rows along."""
    from upkeep.plans.catalog import stored_snapshot

    t, snap = stored_snapshot(spark, sf_dir)
    for fk, gone in (
        ("equipment_id", t.equipment.where(F.col("equipment_model_id") == GONE_MODEL)),
        ("task_id", t.maintenance_task.where(F.col("name") == GONE_TASK)),
        ("rule_id", t.maintenance_rule.where(F.col("frequency_type") == GONE_FREQUENCY)),
    ):
        snap = snapshot.cascade_delete(snap, fk, gone.select("id"))
    return snap


def q_named_views(spark, sf_dir):
    """The dashboard views asked for by name in SQL."""
    from upkeep.plans.catalog import stored_snapshot

    views.create_views(*stored_snapshot(spark, sf_dir))
    return spark.sql(
        "SELECT s.company, s.severity, s.total, count(v.rule_id) AS listed FROM vw_due_soon_summary s "
        "JOIN vw_due_soon v ON v.company = s.company AND v.severity = s.severity GROUP BY ALL"
    )


def q_date_minus_interval(spark, sf_dir):
    """X-17: dates and timestamps some time before each log."""
    return _t(spark, sf_dir).maintenance_log.select(
        "id",
        F.expr("cast(performed_on - interval 6 months as date)").alias("half_a_year_before"),
        F.expr("cast(performed_on - interval 10 days as date)").alias("ten_days_before"),
        F.expr("cast(performed_on as timestamp_ntz) - interval 36 hours").alias("a_day_and_a_half_before"),
    )


def q_yearly_log_counts(spark, sf_dir):
    root = td.materialize(spark, sf_dir)
    logs = read_table(spark, root, "maintenance_log", keep_year=True).groupBy(YEAR_COL).agg(F.count(F.lit(1)).alias("logs"))
    lines = read_table(spark, root, "maintenance_log_detail", keep_year=True).groupBy(YEAR_COL).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return logs.join(lines, YEAR_COL, "full").select(
        YEAR_COL, F.coalesce("logs", F.lit(0)).alias("logs"), F.coalesce("lines", F.lit(0)).alias("lines")
    )


def fraction_value(key):
    """A signed 2-decimal frequency value derived from a key: -5.00 ... 4.99."""
    return ((key % 1000) - 500).cast(METER) / F.lit(100)


def q_date_rule_fractions(spark, sf_dir):
    logs = _t(spark, sf_dir).maintenance_log
    v = fraction_value(F.col("id")).cast(METER)
    d = F.col("performed_on")
    return logs.select(
        "id",
        v.alias("value_numeric"),
        add_days(d, v).alias("next_days"),
        add_weeks(d, v).alias("next_weeks"),
        add_months_frac(d, v).alias("next_months"),
        add_years_frac(d, v).alias("next_years"),
    )


def q_thresholds_null_negative(spark, sf_dir):
    t = _t(spark, sf_dir)
    values = refresh.due_values(t).checkpoint()  # matched, picked and joined once for all parameter sets
    frames = [
        due.stage(values, td.AS_OF, td.COMPUTED_AT, days, hours, km).withColumn("param_set", F.lit(name))
        for name, days, hours, km in THRESHOLD_SETS
    ]
    return quality._union(frames)


def q_stream_close_previous(spark, sf_dir):
    from upkeep.streaming.history_stream import run_close_previous_stream

    t = _t(spark, sf_dir)
    as_inserted = t.equipment_component.withColumn("removed_at", F.lit(None).cast("timestamp_ntz"))
    return run_close_previous_stream(spark, as_inserted, state_buckets=16)


def q_stream_late_arrivals(spark, sf_dir):
    """The same arrivals, each with ids from everywhere: lower ids come after higher ones of their slot."""
    from upkeep.streaming.history_stream import run_close_previous_stream, shuffled

    t = _t(spark, sf_dir)
    as_inserted = t.equipment_component.withColumn("removed_at", F.lit(None).cast("timestamp_ntz"))
    return run_close_previous_stream(spark, as_inserted, deal=shuffled, state_buckets=16)


def q_stream_auto_detail(spark, sf_dir):
    from upkeep.streaming.history_stream import run_auto_detail_stream

    t = _t(spark, sf_dir)
    return run_auto_detail_stream(spark, t.maintenance_log_detail, t.maintenance_log)


SPARK = {
    "close_previous": q_close_previous,
    "stream_close_previous": q_stream_close_previous,
    "stream_late_arrivals": q_stream_late_arrivals,
    "stream_auto_detail": q_stream_auto_detail,
    "close_previous_history": q_close_previous_history,
    "auto_detail": q_auto_detail,
    "insert_if_absent": q_insert_if_absent,
    "append_defaults": q_append_defaults,
    "natural_key_lookup": q_natural_key_lookup,
    "cascade_delete": q_cascade_delete,
    "set_null_delete": q_set_null_delete,
    "dq_pk": q_dq_pk,
    "dq_unique_model": q_dq_unique_model,
    "dq_unique_snapshot": q_dq_unique_snapshot,
    "dq_scope": q_dq_scope,
    "dq_fk": q_dq_fk,
    "dq_not_null": q_dq_not_null,
    "dq_length": q_dq_length,
    "dq_one_active": q_dq_one_active,
    "yearly_log_counts": q_yearly_log_counts,
    "last_log_incremental": q_last_log_incremental,
    "natural_key_reload": q_natural_key_reload,
    "natural_key_index": q_natural_key_index,
    "seed_load": q_seed_load,
    "time_due_colocated": q_time_due_colocated,
    "stored_deletes": q_stored_deletes,
    "dq_quarantine": q_dq_quarantine,
    "unit_components": q_unit_components,
    "unit_timeline": q_unit_timeline,
    "snapshot_cascades": q_snapshot_cascades,
    "named_views": q_named_views,
    "date_minus_interval": q_date_minus_interval,
    "date_rule_fractions": q_date_rule_fractions,
    "thresholds_null_negative": q_thresholds_null_negative,
}


# --------------------------------------------------------------------------------------------------------------
# oracles

_COMP_COLS = "id, equipment_id, part_type_id, slot_label, serial_number, installed_at, removed_at, notes"
_DETAIL_COLS = "id, maintenance_log_id, equipment_component_id, action, old_part_type_id, new_part_type_id, qty_used, notes"
_TABLE_CTES = {
    "company": "a_company", "farm": "a_farm", "equipment_model": "a_model", "equipment": "a_equipment",
    "part_type": "a_part", "equipment_component": "a_component", "maintenance_task": "a_task",
    "maintenance_rule": "a_rule", "maintenance_log": "a_log", "maintenance_log_detail": "a_detail",
}


def _a(*blocks: str, select: str) -> str:
    return O.with_(O.adapter_ctes(), *blocks) + "\n" + select


def _next_closing(src: str) -> str:
    """Correlated form of the trigger: the next arrival in the same slot closes an open row."""
    return f"""nxt AS (
  SELECT c.id, MIN(n.id) AS next_id FROM {src} c JOIN {src} n
    ON n.equipment_id = c.equipment_id AND n.slot_label = c.slot_label AND n.id > c.id
  GROUP BY c.id)"""


def _closed_select(src: str) -> str:
    return f"""SELECT c.id, c.equipment_id, c.part_type_id, c.slot_label, c.serial_number, c.installed_at,
  CASE WHEN c.slot_label IS NULL THEN c.removed_at ELSE COALESCE(c.removed_at, n.installed_at) END AS removed_at, c.notes
FROM {src} c LEFT JOIN nxt ON nxt.id = c.id LEFT JOIN {src} n ON n.id = nxt.next_id"""


# The rules of the schema as the oracle knows them, written out apart from the library's lists (fixed values).
_REQUIRED = {
    "company": "id name created_at",
    "farm": "id name company_id created_at",
    "equipment_model": "id manufacturer model_name equipment_type",
    "equipment": "id display_name equipment_model_id farm_id active created_at",
    "part_type": "id name category",
    "equipment_component": "id equipment_id part_type_id installed_at",
    "maintenance_task": "id name",
    "maintenance_rule": "id task_id frequency_type active is_default",
    "maintenance_log": "id equipment_id task_id performed_on",
    "maintenance_log_detail": "id maintenance_log_id action",
    "due_soon": "id computed_at equipment_id task_id rule_id",
}
_LONGEST = {
    "company": "name 100",
    "farm": "name 100",
    "equipment_model": "manufacturer 100 model_name 100 equipment_type 50",
    "equipment": "display_name 100 serial_number 100",
    "part_type": "name 100 category 100 manufacturer 100 model_code 100",
    "equipment_component": "slot_label 50 serial_number 100",
    "maintenance_task": "name 100",
    "maintenance_rule": "frequency_type 20 interval_text 50 pattern 200",
    "maintenance_log": "performed_by 100",
    "maintenance_log_detail": "action 20",
}
_PARENTS = {
    "farm": "company_id company",
    "equipment": "equipment_model_id equipment_model farm_id farm",
    "equipment_component": "equipment_id equipment part_type_id part_type",
    "maintenance_task": "default_part_type_id part_type",
    "maintenance_rule": "task_id maintenance_task equipment_model_id equipment_model equipment_id equipment part_type_id part_type",
    "maintenance_log": "equipment_id equipment task_id maintenance_task equipment_component_id equipment_component part_type_id part_type",
    "maintenance_log_detail": "maintenance_log_id maintenance_log equipment_component_id equipment_component "
    "old_part_type_id part_type new_part_type_id part_type",
    "due_soon": "company_id company farm_id farm equipment_id equipment task_id maintenance_task rule_id maintenance_rule",
}


def _turns(columns: list) -> list[tuple[str, object]]:
    """(condition under which the column is broken, column)."""
    return [(f"id % {len(columns) + 1} = {j}", c) for j, c in enumerate(columns)]


def _pairs(text: str) -> list[tuple[str, str]]:
    words = text.split()
    return list(zip(words[::2], words[1::2]))


def _dq_selects(kind: str) -> str:
    sources = dict(_TABLE_CTES, due_soon="snap_new")
    parts = []
    if kind == "not_null":
        for name, columns in _REQUIRED.items():
            for turn, c in _turns(columns.split()):
                parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'not_null' AS rule, count(*) FILTER (WHERE {turn} OR {c} IS NULL) AS violations FROM {sources[name]}")
    elif kind == "length":
        for name, columns in _LONGEST.items():
            for turn, (c, n) in _turns(_pairs(columns)):
                parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'varchar' AS rule, count(*) FILTER (WHERE {turn} OR length({c}) > {n}) AS violations FROM {sources[name]}")
    else:
        for name, columns in _PARENTS.items():
            for turn, (c, parent) in _turns(_pairs(columns)):
                lost = f"{c} IS NOT NULL AND {c} NOT IN (SELECT p.id FROM {sources[parent]} p)"
                parts.append(f"SELECT '{name}' AS child_table, '{c}' AS column_name, '{parent}' AS parent_table, count(*) AS violations FROM {sources[name]} WHERE {turn} OR ({lost})")
    return "\nUNION ALL\n".join(parts)


def _quarantine_select() -> str:
    """Each rule is broken by every (k + 1)-th row of its table, the last one (ids that repeat) by rows that come twice."""
    sources = dict(_TABLE_CTES, due_soon="snap_new")
    parts = []
    for name, required in _REQUIRED.items():
        rules = [("not_null", c) for c in required.split()]
        rules += [("varchar", c) for c, _ in _pairs(_LONGEST.get(name, ""))]
        rules += [("foreign_key", c) for c, _ in _pairs(_PARENTS.get(name, ""))]
        rules += [("scope", "")] if name == "maintenance_rule" else []
        rules.append(("repeated_id", "id"))
        for j, (rule, column) in enumerate(rules):
            rows = f"count(*) FILTER (WHERE id % {len(rules) + 1} = {j})" + (" * 2" if rule == "repeated_id" else "")
            parts.append(f"SELECT '{name}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, {rows} AS violations, {rows} AS listed FROM {sources[name]}")
    return "\nUNION ALL\n".join(parts)


def _seed_load_oracle() -> str:
    """The seed's catalog rows (fixed values) numbered after the given ones."""
    return _a(
        """s_company(n, name) AS (VALUES (1, 'Acme Farms'), (2, 'GreenFields Co.')),
s_farm(n, name, company) AS (VALUES (1, 'North Farm', 'Acme Farms'), (2, 'South Farm', 'Acme Farms'), (3, 'Valley Farm', 'GreenFields Co.')),
s_model(n, manufacturer, name) AS (VALUES (1, 'John Deere', '6110'), (2, 'Case IH', 'Axial-Flow 8250'), (3, 'Ford', 'F-250')),
s_part(n, name) AS (VALUES (1, 'Oil Filter Type A'), (2, 'Oil Filter Type B'), (3, 'Hydraulic Filter H100'), (4, 'Front Tire 18"'), (5, 'Engine Oil 15W-40')),
s_task(n, name, part) AS (VALUES (1, 'Change Engine Oil', 'Engine Oil 15W-40'), (2, 'Replace Oil Filter', 'Oil Filter Type A'), (3, 'Grease Fittings', NULL),
  (4, 'Inspect Tires', NULL), (5, 'Replace Hydraulic Filter', NULL)),
n_company AS (SELECT (SELECT coalesce(max(id), 0) FROM a_company) + row_number() OVER (ORDER BY n) AS id, name FROM s_company WHERE name NOT IN (SELECT name FROM a_company)),
n_part AS (SELECT (SELECT coalesce(max(id), 0) FROM a_part) + row_number() OVER (ORDER BY n) AS id, name FROM s_part WHERE name NOT IN (SELECT name FROM a_part)),
every_company AS (SELECT id, name FROM a_company UNION ALL SELECT id, name FROM n_company),
every_part AS (SELECT id, name FROM a_part UNION ALL SELECT id, name FROM n_part),
p_farm AS (SELECT n, s.name, c.id AS parent_id FROM s_farm s JOIN every_company c ON c.name = s.company),
n_farm AS (
  SELECT (SELECT coalesce(max(id), 0) FROM a_farm) + row_number() OVER (ORDER BY n) AS id, name, parent_id FROM p_farm p
  WHERE NOT EXISTS (SELECT 1 FROM a_farm f WHERE f.name = p.name AND f.company_id = p.parent_id)),
n_model AS (
  SELECT (SELECT coalesce(max(id), 0) FROM a_model) + row_number() OVER (ORDER BY n) AS id, name FROM s_model s
  WHERE NOT EXISTS (SELECT 1 FROM a_model m WHERE m.manufacturer = s.manufacturer AND m.model_name = s.name)),
n_task AS (
  SELECT (SELECT coalesce(max(id), 0) FROM a_task) + row_number() OVER (ORDER BY n) AS id, name, (SELECT p.id FROM every_part p WHERE p.name = s.part) AS parent_id
  FROM s_task s WHERE name NOT IN (SELECT name FROM a_task))""",
        select="""SELECT 'company' AS table_name, id, name, NULL::BIGINT AS parent_id FROM n_company
UNION ALL SELECT 'farm', id, name, parent_id FROM n_farm
UNION ALL SELECT 'equipment_model', id, name, NULL FROM n_model
UNION ALL SELECT 'part_type', id, name, NULL FROM n_part
UNION ALL SELECT 'maintenance_task', id, name, parent_id FROM n_task""",
    )


def _oracles() -> dict[str, str]:
    from upkeep.plans.catalog import PARAMS, PREVIOUS_GAP_DAYS, _STAGE_COLS

    prev = refresh.shifted(PARAMS, PREVIOUS_GAP_DAYS)
    snap_blocks = [
        f"a_log_old AS (SELECT * FROM a_log WHERE performed_on <= DATE '{prev.as_of.isoformat()}')",
        O.procedure_ctes("_old", prev.as_of, prev.computed_at, log="a_log_old"),
        O.procedure_ctes("_new", PARAMS.as_of, PARAMS.computed_at),
    ]
    v = "CAST(((id % 1000) - 500) AS DECIMAL(10,2)) / 100"
    vv = f"CAST({v} AS DECIMAL(10,2))"
    out = {
        "close_previous": _a(_next_closing("a_component_raw"), select=_closed_select("a_component_raw")),
        "close_previous_history": _a(
            f"""given AS (
  SELECT c.id, c.equipment_id, c.part_type_id, c.slot_label, c.serial_number, c.installed_at,
    CASE WHEN d.action = 'REPLACE' THEN c.installed_at + to_days(CAST(d.qty_used AS INTEGER)) END AS removed_at, c.notes
  FROM a_component_raw c LEFT JOIN a_detail d ON d.id = c.id)""",
            _next_closing("given"),
            select=_closed_select("given"),
        ),
        "auto_detail": _a(
            select=f"""SELECT {_DETAIL_COLS} FROM a_detail
UNION ALL
SELECT (SELECT MAX(id) FROM a_detail) + row_number() OVER (ORDER BY id), id, equipment_component_id,
       '{history.AUTO_DETAIL_ACTION}', NULL, NULL, NULL, '{history.AUTO_DETAIL_NOTE}'
FROM a_log WHERE equipment_component_id IS NOT NULL"""
        ),
        "insert_if_absent": _a(
            f"""ex AS (SELECT id, equipment_id, task_id, performed_on FROM a_log WHERE performed_on < DATE '{LOADED_BEFORE.isoformat()}'),
bt AS (SELECT id, equipment_id, task_id, performed_on FROM a_log WHERE performed_on >= DATE '{LOADED_BEFORE.isoformat()}'),
ins AS (
  SELECT * FROM bt
  WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.equipment_id = bt.equipment_id AND ex.task_id = bt.task_id)
  QUALIFY row_number() OVER (PARTITION BY equipment_id, task_id ORDER BY id) = 1)""",
            select="SELECT * FROM ex UNION ALL SELECT * FROM ins",
        ),
        "append_defaults": _a(
            select=f"""SELECT o.o_orderkey AS id, o.o_custkey AS equipment_id, t.id AS task_id,
  COALESCE(CASE WHEN o.o_orderstatus <> '{PENDING_STATUS}' THEN CAST(o.o_orderdate AS DATE) END, DATE '{td.AS_OF.isoformat()}') AS performed_on
FROM orders o JOIN a_task t ON t.name = o.o_orderpriority"""
        ),
        "natural_key_lookup": _a(
            """nm AS (
  SELECT ml.id AS log_id, e.display_name AS equipment_name, t.name AS task_name, f.name AS farm_name, c.name AS company_name
  FROM a_log ml JOIN a_equipment e ON e.id = ml.equipment_id JOIN a_task t ON t.id = ml.task_id
  JOIN a_farm f ON f.id = e.farm_id JOIN a_company c ON c.id = f.company_id)""",
            select="""SELECT nm.log_id,
  (SELECT e.id FROM a_equipment e WHERE e.display_name = nm.equipment_name) AS equipment_id,
  (SELECT t.id FROM a_task t WHERE t.name = nm.task_name) AS task_id,
  (SELECT f.id FROM a_farm f JOIN a_company c ON c.id = f.company_id
    WHERE f.name = nm.farm_name AND c.name = nm.company_name) AS farm_id
FROM nm""",
        ),
        "cascade_delete": _a(
            select=f"""SELECT {_DETAIL_COLS} FROM a_detail d
WHERE d.maintenance_log_id NOT IN (SELECT id FROM a_log WHERE performed_on < DATE '{ARCHIVE_BEFORE.isoformat()}')"""
        ),
        "set_null_delete": _a(
            *snap_blocks,
            O.snapshot_ctes(True),
            f"""gone_c AS (SELECT id FROM a_company WHERE name = '{DELETED_COMPANY}'),
gone_f AS (SELECT id FROM a_farm WHERE company_id IN (SELECT id FROM gone_c))""",
            select=f"""SELECT id, computed_at,
  CASE WHEN company_id IN (SELECT id FROM gone_c) THEN NULL ELSE company_id END AS company_id,
  CASE WHEN farm_id IN (SELECT id FROM gone_f) THEN NULL ELSE farm_id END AS farm_id,
  equipment_id, task_id, rule_id, next_due_date, days_until_due, next_due_at_hours, hours_remaining,
  next_due_at_km, km_remaining, severity
FROM snap_new""",
        ),
        "dq_pk": _a(
            *snap_blocks,
            O.snapshot_ctes(True),
            select="\nUNION ALL\n".join(
                f"SELECT '{n}' AS table_name, count(*) + count(*) FILTER (WHERE id % 2 = 0) AS row_count, "
                f"count(*) FILTER (WHERE id % 3 = 0) + count(*) FILTER (WHERE id % 6 = 0) AS null_ids, "
                f"count(*) FILTER (WHERE id % 2 = 0 AND id % 3 <> 0) AS duplicate_ids FROM {c}"
                for n, c in {**_TABLE_CTES, "due_soon": "snap_new"}.items()
            ),
        ),
        "dq_unique_model": _a(
            """scoped_rule AS (
  SELECT *, CASE WHEN equipment_id IS NOT NULL THEN 'equipment_id' WHEN equipment_model_id IS NOT NULL THEN 'equipment_model_id' ELSE 'part_type_id' END AS scope,
         CASE WHEN equipment_id IS NOT NULL THEN equipment_id WHEN equipment_model_id IS NOT NULL THEN equipment_model_id ELSE part_type_id END AS scope_id
  FROM a_rule),
installed AS (SELECT * FROM a_component WHERE removed_at IS NULL)""",
            select="\nUNION ALL\n".join(
                f"""SELECT '{n}' AS table_name, '{k}' AS key_columns, count(*) AS duplicate_keys, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT count(*) AS c FROM {src} GROUP BY {k} HAVING count(*) > 1)"""
                for n, src, k in (
                    ("company", "a_company", "name"),
                    ("farm", "a_farm", "name,company_id"),
                    ("equipment_model", "a_model", "manufacturer,model_name"),
                    ("part_type", "a_part", "name"),
                    ("equipment", "a_equipment", "display_name"),
                    ("equipment_component", "installed", "equipment_id,slot_label"),
                    ("maintenance_task", "a_task", "name"),
                    ("maintenance_rule", "scoped_rule", "task_id,scope,scope_id,frequency_type"),
                    ("maintenance_log", "a_log", "equipment_id,task_id"),
                    ("maintenance_log_detail", "a_detail", "maintenance_log_id"),
                )
            ),
        ),
        "dq_unique_snapshot": _a(
            *snap_blocks,
            O.snapshot_ctes(False),
            select="\nUNION ALL\n".join(
                f"""SELECT '{n}' AS table_name, 'equipment_id,task_id,rule_id' AS key_columns,
  count(*) FILTER (WHERE severity = 'OVERDUE') AS duplicate_keys, count(*) FILTER (WHERE severity = 'OVERDUE') AS surplus_rows FROM {src}"""
                for n, src in (("due_soon", "snap_new"), ("due_soon_stage", "stage_new"))
            ),
        ),
        "dq_scope": _a(select="SELECT count(*) AS rules, count(*) FILTER (WHERE frequency_type IN ('HOURS', 'KM')) AS violations FROM a_rule"),
        "dq_fk": _a(*snap_blocks, O.snapshot_ctes(True), select=_dq_selects("fk")),
        "dq_not_null": _a(*snap_blocks, O.snapshot_ctes(True), select=_dq_selects("not_null")),
        "dq_length": _a(select=_dq_selects("length")),
        "dq_one_active": _a(
            select="\nUNION ALL\n".join(
                f"""SELECT '{state}' AS state, measure, CAST(value AS BIGINT) AS value FROM (
  SELECT COUNT(*) AS slots_with_many_open, COALESCE(SUM(n), 0) AS open_rows_in_them FROM (
    SELECT equipment_id, slot_label, COUNT(*) AS n FROM {src}
    WHERE removed_at IS NULL AND slot_label IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) > 1)
) UNPIVOT (value FOR measure IN (slots_with_many_open, open_rows_in_them))
UNION ALL
SELECT '{state}', 'negative_spans', CAST(SUM(CASE WHEN removed_at < installed_at THEN 1 ELSE 0 END) AS BIGINT) FROM {src}"""
                for state, src in (("as_inserted", "a_component_raw"), ("after_trigger", "a_component"))
            )
        ),
        "yearly_log_counts": _a(
            select=f"""SELECT COALESCE(l.y, d.y) AS {YEAR_COL}, COALESCE(l.n, 0) AS logs, COALESCE(d.n, 0) AS lines
FROM (SELECT CAST(year(performed_on) AS INTEGER) AS y, COUNT(*) AS n FROM a_log GROUP BY 1) l
FULL JOIN (SELECT CAST(year(ml.performed_on) AS INTEGER) AS y, COUNT(*) AS n
           FROM a_detail d JOIN a_log ml ON ml.id = d.maintenance_log_id GROUP BY 1) d ON d.y = l.y"""
        ),
        "date_rule_fractions": _a(
            select=f"""SELECT id, {vv} AS value_numeric,
  {O.add_frequency_sql("performed_on", "'DAYS'", vv)} AS next_days,
  {O.add_frequency_sql("performed_on", "'WEEKS'", vv)} AS next_weeks,
  {O.add_frequency_sql("performed_on", "'MONTHS'", vv)} AS next_months,
  {O.add_frequency_sql("performed_on", "'YEARS'", vv)} AS next_years
FROM a_log"""
        ),
        "thresholds_null_negative": _a(
            *[
                O.procedure_ctes(f"_{name}", PARAMS.as_of, PARAMS.computed_at, days, hours, km)
                for name, days, hours, km in THRESHOLD_SETS
            ],
            select="\nUNION ALL\n".join(
                f"SELECT {_STAGE_COLS}, '{name}' AS param_set FROM stage_{name}" for name, *_ in THRESHOLD_SETS
            ),
        ),
    }
    busiest = """busiest AS (
  SELECT equipment_id FROM a_log GROUP BY equipment_id ORDER BY count(*) DESC, equipment_id LIMIT 1)"""
    from upkeep.plans.catalog import _oracles as view_oracles
    from upkeep.plans.catalog import _snap

    of_views = view_oracles()
    log_ids = "SELECT id FROM a_log SEMI JOIN busiest USING (equipment_id)"
    out["unit_components"] = of_views["current_components"].replace(
        "WHERE removed_at IS NULL", "WHERE removed_at IS NULL AND a_component.equipment_id = (SELECT equipment_id FROM a_log "
        "GROUP BY equipment_id ORDER BY count(*) DESC, equipment_id LIMIT 1)"
    )
    out["unit_timeline"] = of_views["maintenance_timeline"].replace(
        "ORDER BY performed_on", f"WHERE id IN (WITH {busiest} {log_ids}) ORDER BY performed_on"
    )
    out["snapshot_cascades"] = _snap(
        f"""SELECT id, {_STAGE_COLS} FROM snap_new
ANTI JOIN (SELECT id AS equipment_id FROM a_equipment WHERE equipment_model_id = {GONE_MODEL}) USING (equipment_id)
ANTI JOIN (SELECT id AS task_id FROM a_task WHERE name = '{GONE_TASK}') USING (task_id)
ANTI JOIN (SELECT id AS rule_id FROM a_rule WHERE frequency_type = '{GONE_FREQUENCY}') USING (rule_id)"""
    )
    out["named_views"] = _snap(
        "SELECT company, severity, count(*) AS total, count(*) AS listed FROM snap_new JOIN place USING (equipment_id) GROUP BY ALL"
    )
    out["date_minus_interval"] = _a(
        select="""SELECT id, CAST(performed_on - INTERVAL 6 MONTH AS DATE) AS half_a_year_before, performed_on - 10 AS ten_days_before,
  CAST(performed_on AS TIMESTAMP) - INTERVAL 36 HOUR AS a_day_and_a_half_before FROM a_log"""
    )
    # what the guards of the seed compare, written out here
    identities = {
        "company": "SELECT DISTINCT name FROM a_company",
        "farm": "SELECT DISTINCT name, company_id FROM a_farm",
        "equipment_model": "SELECT DISTINCT manufacturer, model_name FROM a_model",
        "part_type": "SELECT DISTINCT name FROM a_part",
        "equipment": "SELECT DISTINCT display_name FROM a_equipment",
        "equipment_component": "SELECT DISTINCT equipment_id, slot_label FROM a_component WHERE removed_at IS NULL "
        "UNION ALL SELECT id, 'removed' FROM a_component WHERE removed_at IS NOT NULL",
        "maintenance_task": "SELECT DISTINCT name FROM a_task",
        "maintenance_rule": "SELECT DISTINCT task_id, frequency_type, CASE WHEN equipment_id IS NOT NULL THEN 'u' || equipment_id "
        "WHEN equipment_model_id IS NOT NULL THEN 'm' || equipment_model_id ELSE 'p' || part_type_id END FROM a_rule",
        "maintenance_log": "SELECT DISTINCT equipment_id, task_id FROM a_log",
        "maintenance_log_detail": "SELECT DISTINCT maintenance_log_id FROM a_detail",
    }
    out["natural_key_reload"] = _a(
        select="\nUNION ALL\n".join(
            f"SELECT '{n}' AS table_name, 'first' AS load, count(*) AS inserted FROM ({q}) UNION ALL SELECT '{n}', 'again', 0"
            for n, q in identities.items()
        )
    )
    out["natural_key_index"] = out["natural_key_reload"]
    out["seed_load"] = _seed_load_oracle()
    out["stored_deletes"] = _a(
        *snap_blocks,
        O.snapshot_ctes(True),
        f"""left_log AS (SELECT *, CAST(year(performed_on) AS INTEGER) AS performed_year FROM a_log WHERE performed_on >= DATE '{ARCHIVE_BEFORE.isoformat()}'),
left_line AS (SELECT d.id, l.performed_year FROM a_detail d JOIN left_log l ON l.id = d.maintenance_log_id),
left_due AS (SELECT * FROM snap_new WHERE equipment_id NOT IN (SELECT id FROM a_equipment WHERE equipment_model_id = {GONE_MODEL})),
left_rows AS (
  SELECT 'maintenance_log' AS table_name, performed_year, id FROM left_log
  UNION ALL SELECT 'maintenance_log_detail', performed_year, id FROM left_line
  UNION ALL SELECT 'due_soon', NULL, id FROM left_due
  UNION ALL SELECT 'due_soon without company', NULL, id FROM left_due
  WHERE company_id IS NULL OR company_id IN (SELECT id FROM a_company WHERE name = '{DELETED_COMPANY}'))""",
        select="SELECT table_name, performed_year, count(*) AS rows_left, CAST(sum(id) AS BIGINT) AS id_sum FROM left_rows GROUP BY ALL",
    )
    out["dq_quarantine"] = _a(*snap_blocks, O.snapshot_ctes(True), select=_quarantine_select())
    # incremental maintenance must equal the full recomputation
    from upkeep.plans.catalog import _proc

    out["last_log_incremental"] = _proc("SELECT * FROM last_log")
    out["time_due_colocated"] = _proc("SELECT * FROM time_due")
    # the folded streams must equal the batch triggers
    out["stream_close_previous"] = out["stream_late_arrivals"] = out["close_previous"]
    out["stream_auto_detail"] = out["auto_detail"]
    return out


def oracles() -> dict[str, str]:
    return _oracles()
