"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and name -> DuckDB oracle SQL.

All queries run over the whole adapted tables of ``sf_dir`` with the scenario parameters of ``sources.testdata``
(as_of 2001-08-01, 30 days / 25,000 hours / 25,000 km). Output columns are aliased identically in both forms.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.operators import due, versions
from upkeep.plans import due_store, refresh, views
from upkeep.plans import oracle as O
from upkeep.session import shared_path
from upkeep.sources import testdata as td

QueryFn = Callable[[SparkSession, str], DataFrame]

PARAMS = refresh.RefreshParams(td.AS_OF, td.COMPUTED_AT, td.DAYS_AHEAD, td.HOURS_AHEAD, td.KM_AHEAD, True)
PREVIOUS_GAP_DAYS = 60  # the previous snapshot is the refresh of 60 days earlier
CHANGE_DAYS = (60, 40, 20, 0)  # days before as_of on which the change-driven store is refreshed
STORE_BUCKETS = 16  # of the stored due lists of the given tables; large fleets take thousands


def _t(spark: SparkSession, sf_dir: str):
    return td.load(spark, sf_dir)


# --------------------------------------------------------------------------------------------------------------
# Spark side


def q_last_log(spark, sf_dir):
    return due.last_log(_t(spark, sf_dir).maintenance_log)


def q_equipment_base(spark, sf_dir):
    t = _t(spark, sf_dir)
    return due.base(t.equipment, t.farm)


def q_equipment_rules(spark, sf_dir):
    return refresh.matched_rules(_t(spark, sf_dir)).select(*due.RULE_COLS)


def q_picked_rules(spark, sf_dir):
    return refresh.picked(_t(spark, sf_dir)).select(*due.RULE_COLS)


def _values(spark, sf_dir):
    return refresh.due_values(_t(spark, sf_dir))


def q_time_due(spark, sf_dir):
    v = _values(spark, sf_dir)
    return v.where(F.col("frequency_type").isin("DAYS", "WEEKS", "MONTHS", "YEARS")).select(
        "equipment_id", "rule_id", "task_id", "next_due_date"
    )


def q_hours_due(spark, sf_dir):
    v = _values(spark, sf_dir)
    return v.where(F.col("frequency_type") == "HOURS").select(
        "equipment_id", "rule_id", "task_id", "next_due_at_hours", "hours_remaining"
    )


def q_km_due(spark, sf_dir):
    v = _values(spark, sf_dir)
    return v.where(F.col("frequency_type") == "KM").select(
        "equipment_id", "rule_id", "task_id", "next_due_at_km", "km_remaining"
    )


def q_due_stage(spark, sf_dir):
    return refresh.due_stage(_t(spark, sf_dir), PARAMS)


def _snapshot(spark, sf_dir, purge: bool):
    t = _t(spark, sf_dir)
    prev = refresh.shifted(PARAMS, PREVIOUS_GAP_DAYS)
    # the previous refresh saw only the log history up to its own date
    then = t.with_(maintenance_log=t.maintenance_log.where(F.col("performed_on") <= F.lit(prev.as_of)))
    # both dates share the date-independent rule matching and pick; upserts are checkpointed, so the cache is no longer
    # needed once both snapshots exist
    picked = refresh.picked(t).persist()
    old = refresh.refresh_due(then, None, prev, picked)
    p = refresh.RefreshParams(PARAMS.as_of, PARAMS.computed_at, PARAMS.days_ahead, PARAMS.hours_ahead, PARAMS.km_ahead, purge)
    new = refresh.refresh_due(t, old, p, picked)
    picked.unpersist()
    return t, new


def _refreshed_store(spark, sf_dir, root: str, purge: bool) -> None:
    """Two scheduled runs against a stored due list: the earlier date, then today."""
    t = _t(spark, sf_dir)
    prev = refresh.shifted(PARAMS, PREVIOUS_GAP_DAYS)
    then = t.with_(maintenance_log=t.maintenance_log.where(F.col("performed_on") <= F.lit(prev.as_of)))
    due_store.refresh_store(spark, root, then, prev, n=STORE_BUCKETS)
    due_store.refresh_store(spark, root, t, replace(PARAMS, purge=purge), n=STORE_BUCKETS)


def stored_snapshot(spark, sf_dir, purge: bool = True):
    """The tables and the committed due list of this input, refreshed once and read by every query after that."""
    base = f"{td.domain_root(spark, sf_dir)}-due-{'purge' if purge else 'keep'}"
    version = versions.current(spark, base)
    if not version.number:
        store = versions.new_folder(base)
        _refreshed_store(spark, sf_dir, store, purge)
        try:
            version = versions.commit(spark, base, 0, {"due": store})
        except versions.Conflict:  # another application was first with the same input
            version = versions.current(spark, base)
    return _t(spark, sf_dir), due_store.read_due(spark, version.parts["due"])


def _new_store(spark, name: str) -> str:
    return shared_path(spark, "snapshots", f"{name}-{uuid.uuid4().hex[:12]}")


def q_due_snapshot_versioned(spark, sf_dir):
    """Two scheduled runs against a stored snapshot, read back from storage."""
    root = _new_store(spark, "due_soon")
    _refreshed_store(spark, sf_dir, root, True)
    return due_store.read_due(spark, root)


def q_due_refresh_changes(spark, sf_dir):
    """A full refresh 60 days ago, then one every 20 days that looks only at units with new logs and at the calendar."""
    t = _t(spark, sf_dir)
    root = _new_store(spark, "due_changes")
    last = None
    for days in CHANGE_DAYS:
        p = refresh.shifted(PARAMS, days)
        logs = t.maintenance_log.where(F.col("performed_on") <= F.lit(p.as_of))
        changed = None if last is None else due_store.changed_units(t, logs=logs.where(F.col("performed_on") > F.lit(last)))
        due_store.refresh_store(spark, root, t.with_(maintenance_log=logs), p, changed, n=STORE_BUCKETS)
        last = p.as_of
    return due_store.read_due(spark, root)


def q_due_snapshot_purge(spark, sf_dir):
    return _snapshot(spark, sf_dir, True)[1]


def q_due_snapshot_keep(spark, sf_dir):
    return _snapshot(spark, sf_dir, False)[1]


def q_due_view(spark, sf_dir):
    t, snap = stored_snapshot(spark, sf_dir)
    return views.due_view(t, snap)


def q_due_summary(spark, sf_dir):
    t, snap = stored_snapshot(spark, sf_dir)
    return views.due_summary(t, snap)


def q_due_ordered(spark, sf_dir):
    t, snap = stored_snapshot(spark, sf_dir)
    return views.due_ordered(t, snap)


def q_current_components(spark, sf_dir):
    return views.current_components(_t(spark, sf_dir))


def q_maintenance_timeline(spark, sf_dir):
    return views.maintenance_timeline(_t(spark, sf_dir))


def q_month_rules_due(spark, sf_dir):
    return views.month_rules_due(_t(spark, sf_dir), PARAMS.as_of, PARAMS.days_ahead)


SPARK: dict[str, QueryFn] = {
    "last_log": q_last_log,
    "equipment_base": q_equipment_base,
    "equipment_rules": q_equipment_rules,
    "picked_rules": q_picked_rules,
    "time_due": q_time_due,
    "hours_due": q_hours_due,
    "km_due": q_km_due,
    "due_stage": q_due_stage,
    "due_snapshot_purge": q_due_snapshot_purge,
    "due_snapshot_keep": q_due_snapshot_keep,
    "due_snapshot_versioned": q_due_snapshot_versioned,
    "due_refresh_changes": q_due_refresh_changes,
    "due_view": q_due_view,
    "due_summary": q_due_summary,
    "due_ordered": q_due_ordered,
    "current_components": q_current_components,
    "maintenance_timeline": q_maintenance_timeline,
    "month_rules_due": q_month_rules_due,
}


# --------------------------------------------------------------------------------------------------------------
# DuckDB side

_STAGE_COLS = ("computed_at, company_id, farm_id, equipment_id, task_id, rule_id, next_due_date, days_until_due, "
               "next_due_at_hours, hours_remaining, next_due_at_km, km_remaining, severity")


def _proc(select: str) -> str:
    return O.with_(O.adapter_ctes(), O.procedure_ctes("", PARAMS.as_of, PARAMS.computed_at)) + "\n" + select


def _snap(select: str, purge: bool = True) -> str:
    prev = refresh.shifted(PARAMS, PREVIOUS_GAP_DAYS)
    return O.with_(
        O.adapter_ctes(),
        f"a_log_old AS (SELECT * FROM a_log WHERE performed_on <= DATE '{prev.as_of.isoformat()}')",
        O.procedure_ctes("_old", prev.as_of, prev.computed_at, log="a_log_old"),
        O.procedure_ctes("_new", PARAMS.as_of, PARAMS.computed_at),
        O.snapshot_ctes(purge),
        O.place_cte(),
    ) + "\n" + select


def _chain(select: str) -> str:
    """Refreshes on several days, each with the logs up to its own: a row keeps its id while it is staged day after day; every
    entry (staged now, not the day before) takes the next id, by day and key."""
    days = [refresh.shifted(PARAMS, d) for d in CHANGE_DAYS]
    blocks = []
    for k, p in enumerate(days):
        log = f"a_log_{k}"
        blocks.append(f"{log} AS (SELECT * FROM a_log WHERE performed_on <= DATE '{p.as_of.isoformat()}')")
        blocks.append(O.procedure_ctes(f"_{k}", p.as_of, p.computed_at, log=log))
    every = " UNION ALL ".join(f"SELECT {k} AS turn, * FROM stage_{k}" for k in range(len(days)))
    key = "equipment_id, task_id, rule_id"
    return O.with_(
        O.adapter_ctes(),
        *blocks,
        f"staged AS ({every})",
        f"entered AS (SELECT *, coalesce(turn - 1 <> lag(turn) OVER (PARTITION BY {key} ORDER BY turn), true) AS entry FROM staged)",
        f"numbered AS (SELECT turn, {key}, row_number() OVER (ORDER BY turn, {key}) AS id FROM entered WHERE entry)",
        f"""chain AS (
  SELECT (SELECT max(n.id) FROM numbered n WHERE n.equipment_id = s.equipment_id AND n.task_id = s.task_id AND n.rule_id = s.rule_id) AS id,
         {_STAGE_COLS}
  FROM stage_{len(days) - 1} s)""",
    ) + "\n" + select


_VIEW_SELECT = """
SELECT computed_at, company, farm, equipment, (SELECT name FROM a_task WHERE id = task_id) AS task, severity, next_due_date,
       days_until_due, next_due_at_hours, hours_remaining, next_due_at_km, km_remaining, rule_id, equipment_id, task_id
FROM snap_new JOIN place USING (equipment_id)"""


def _oracles() -> dict[str, str]:
    rule_cols = ", ".join(due.RULE_COLS)
    a = PARAMS.as_of.isoformat()
    month_next = O.add_frequency_sql("day", "'MONTHS'", "value_numeric")
    return {
        "last_log": _proc("SELECT * FROM last_log"),
        "equipment_base": _proc("SELECT * FROM base"),
        "equipment_rules": _proc(f"SELECT {rule_cols} FROM equipment_rules"),
        "picked_rules": _proc(f"SELECT {rule_cols} FROM picked_rules"),
        "time_due": _proc("SELECT * FROM time_due"),
        "hours_due": _proc(
            "SELECT equipment_id, rule_id, task_id, CAST(next_due_at_hours AS DECIMAL(12,2)) AS next_due_at_hours, "
            "CAST(hours_remaining AS DECIMAL(12,2)) AS hours_remaining FROM hours_due"
        ),
        "km_due": _proc(
            "SELECT equipment_id, rule_id, task_id, CAST(next_due_at_km AS DECIMAL(12,2)) AS next_due_at_km, "
            "CAST(km_remaining AS DECIMAL(12,2)) AS km_remaining FROM km_due"
        ),
        "due_stage": _proc(f"SELECT {_STAGE_COLS} FROM stage"),
        "due_snapshot_purge": _snap(f"SELECT id, {_STAGE_COLS} FROM snap_new", True),
        "due_snapshot_keep": _snap(f"SELECT id, {_STAGE_COLS} FROM snap_new", False),
        "due_snapshot_versioned": _snap(f"SELECT id, {_STAGE_COLS} FROM snap_new", True),
        "due_refresh_changes": _chain(f"SELECT id, {_STAGE_COLS} FROM chain"),
        "due_view": _snap(_VIEW_SELECT),
        "due_summary": _snap(
            "SELECT company, severity, count(*) AS total FROM snap_new JOIN place USING (equipment_id) GROUP BY ALL ORDER BY ALL"
        ),
        "due_ordered": _snap(
            _VIEW_SELECT
            + "\nORDER BY severity, next_due_date NULLS LAST, hours_remaining NULLS LAST, km_remaining NULLS LAST"
        ),
        "current_components": O.with_(O.adapter_ctes(), O.place_cte())
        + "\nSELECT a_component.*, farm AS farm_name, company AS company_name FROM a_component JOIN place USING (equipment_id)"
        + "\nWHERE removed_at IS NULL",
        "maintenance_timeline": O.with_(
            O.adapter_ctes(),
            O.place_cte(),
            """noted AS (
  SELECT maintenance_log_id AS id, action, (SELECT slot_label FROM a_component WHERE id = a_detail.equipment_component_id) AS slot_label
  FROM a_detail
  UNION ALL
  SELECT id, NULL, NULL FROM a_log WHERE id NOT IN (SELECT maintenance_log_id FROM a_detail))""",
        )
        + """
SELECT performed_on, (SELECT name FROM a_task WHERE id = task_id) AS task, action, slot_label, farm AS farm_name, company AS company_name
FROM noted JOIN a_log USING (id) JOIN place USING (equipment_id) ORDER BY performed_on DESC""",
        "month_rules_due": O.with_(
            O.adapter_ctes(),
            O.place_cte(),
            f"""since AS (
  SELECT u.id AS equipment_id, r.task_id, r.value_numeric,
         coalesce((SELECT max(performed_on) FROM a_log l WHERE l.equipment_id = u.id AND l.task_id = r.task_id), u.created_at::DATE) AS day
  FROM a_equipment u, a_rule r WHERE r.active AND r.frequency_type = 'MONTHS'),
planned AS (SELECT *, {month_next} AS next_due FROM since)""",
        )
        + f"""
SELECT company AS company_name, farm AS farm_name, equipment, (SELECT name FROM a_task WHERE id = task_id) AS task, next_due
FROM planned JOIN place USING (equipment_id) WHERE date_diff('day', DATE '{a}', next_due) <= {PARAMS.days_ahead}""",
    }


def queries() -> dict[str, QueryFn]:
    from upkeep.plans import catalog_ops

    return {**SPARK, **catalog_ops.SPARK}


def oracle_sql() -> dict[str, str]:
    from upkeep.plans import catalog_ops

    return {**_oracles(), **catalog_ops.oracles()}
