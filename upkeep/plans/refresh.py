"""E-01 ``refresh_due_soon_upsert`` as one Spark job: tables (+ previous snapshot) -> new snapshot.

``as_of`` stands for ``current_date`` and ``computed_at`` for the transaction's ``now()``; both are arguments so a
run is reproducible and every row of one refresh carries the same ``computed_at``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame

from upkeep.operators import due, snapshot
from upkeep.sources.tables import Tables


@dataclass(frozen=True)
class RefreshParams:
    as_of: dt.date
    computed_at: dt.datetime
    days_ahead: int | None = due.DEFAULT_DAYS_AHEAD
    hours_ahead: Decimal | int | None = due.DEFAULT_HOURS_AHEAD
    km_ahead: Decimal | int | None = due.DEFAULT_KM_AHEAD
    purge: bool = True


def equipment_base(t: Tables) -> DataFrame:
    return due.base(t.equipment, t.farm, extra=("equipment_model_id",), keep_unmatched=True)


def matched_rules(t: Tables) -> DataFrame:
    return due.equipment_rules(equipment_base(t), t.maintenance_rule, t.equipment_component)


def picked(t: Tables) -> DataFrame:
    return due.picked_rules(matched_rules(t))


def due_values(t: Tables, picked_rules: DataFrame | None = None, last: DataFrame | None = None) -> DataFrame:
    """``last`` may be a stored, incrementally maintained ``last_log`` (``due.update_last_log_store``)."""
    chosen = picked(t) if picked_rules is None else picked_rules
    return due.due_values(chosen, due.last_log(t.maintenance_log) if last is None else last)


def due_stage(t: Tables, p: RefreshParams, picked_rules: DataFrame | None = None) -> DataFrame:
    return due.stage(due_values(t, picked_rules), p.as_of, p.computed_at, p.days_ahead, p.hours_ahead, p.km_ahead)


def refresh_due(
    t: Tables, old_snapshot: DataFrame | None, p: RefreshParams, picked_rules: DataFrame | None = None
) -> DataFrame:
    """The ``due_soon`` table after the procedure: stage upserted into ``old_snapshot`` (purged if asked).

    ``picked_rules`` may be passed in when several dates are refreshed from the same equipment/rule/component
    state: rule matching and the precedence pick depend on neither the date nor the log history.
    """
    stage = due_stage(t, p, picked_rules)
    if old_snapshot is None:
        return snapshot.initial_snapshot(stage)
    return snapshot.upsert(old_snapshot, stage, p.purge)


def shifted(p: RefreshParams, days: int) -> RefreshParams:
    """The same refresh ``days`` earlier (used to build a realistic previous snapshot)."""
    return RefreshParams(
        p.as_of - dt.timedelta(days=days), p.computed_at - dt.timedelta(days=days),
        p.days_ahead, p.hours_ahead, p.km_ahead, p.purge,
    )
