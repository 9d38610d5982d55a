"""Due-item computation (E-01 stages 2-7): last log, rule matching, precedence pick, due values, severity.

Plan shape (see ``plans/refresh.py``):

* ``last_log``: partial max per map task, one shuffle on (equipment, task) -- a hot unit is collapsed before the
  shuffle, so skew in the log does not reach the reducers.
* rule matching: the equipment row (with its farm/company and meters, i.e. the reference's ``base``) is joined to
  the rules once per scope and carried through the union, so the reference's three later ``JOIN base`` disappear.
  Catalog sides carry no hint: Spark broadcasts them by their size in bytes or plans a shuffle join that AQE can split.
  Part rules meet the *active* components, are de-duplicated on two narrow columns, then meet equipment.
* pick: the matches are hash-clustered once on (equipment, task); that one exchange satisfies both the
  ``row_number() = 1`` window per (equipment, task, frequency) and the later join with ``last_log`` on
  (equipment, task), which is already clustered the same way by its aggregation (one exchange fewer than letting
  each operator shuffle for itself). Rows per key are bounded by the rule catalog, so no map-side pre-limit is lost
  that would matter.
* due values: one pass over the picked rules with ``when`` columns instead of three UNION ALL branches (the branch
  filters on ``frequency_type`` are disjoint).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from upkeep.functions.intervals import TIME_FREQUENCIES, add_frequency
from upkeep.operators import buckets, versions
from upkeep.sources.schemas import DUE_NUM, DUE_STAGE, METER

RULE_COLS = [
    "equipment_id", "rule_id", "task_id", "frequency_type", "value_numeric",
    "interval_text", "pattern", "condition_note", "precedence",
]

# Fixed values of the reference procedure.
DEFAULT_DAYS_AHEAD = 30
DEFAULT_HOURS_AHEAD = Decimal("25")
DEFAULT_KM_AHEAD = Decimal("500")
OVERDUE, DUE_SOON, INFO = "OVERDUE", "DUE_SOON", "INFO"
ACTIONABLE = (OVERDUE, DUE_SOON)


def last_log(logs: DataFrame) -> DataFrame:
    """Q-G1: latest date and highest meters ever logged per (equipment, task)."""
    return logs.groupBy("equipment_id", "task_id").agg(
        F.max("performed_on").alias("last_date"),
        F.max("engine_hours").alias("last_hours"),
        F.max("odometer_km").alias("last_km"),
    )


def merge_last_log(stored: DataFrame, new_logs: DataFrame) -> DataFrame:
    """Q-G1 kept incrementally: MAX is monotone under inserts, so a stored ``last_log`` absorbs only the new log
    rows (e.g. the latest ``performed_year`` partitions) instead of re-reading the whole history."""
    fresh = last_log(new_logs)
    return stored.unionByName(fresh).groupBy("equipment_id", "task_id").agg(
        F.max("last_date").alias("last_date"),
        F.max("last_hours").alias("last_hours"),
        F.max("last_km").alias("last_km"),
    )


def base(equipment: DataFrame, farm: DataFrame, extra: tuple[str, ...] = (), keep_unmatched: bool = False) -> DataFrame:
    """Q-G4: equipment with farm/company, creation date and current meters.

    ``keep_unmatched`` keeps units whose farm row is missing (left join, ``has_farm`` = false): rule matching in the
    reference reads ``equipment`` itself, and only the due branches join ``base`` (dropping such units).
    """
    farms = farm.select(F.col("id").alias("farm_id"), "company_id", F.lit(True).alias("has_farm"))
    joined = equipment.join(farms, "farm_id", "left" if keep_unmatched else "inner")
    return joined.select(
        F.col("id").alias("equipment_id"),
        "farm_id",
        "company_id",
        F.col("created_at").cast("date").alias("equip_created"),
        "engine_hours",
        "odometer_km",
        *extra,
        *([F.coalesce(F.col("has_farm"), F.lit(False)).alias("has_farm")] if keep_unmatched else []),
    )


def _rule_attrs(rules: DataFrame) -> DataFrame:
    return rules.where(F.col("active")).select(
        F.col("id").alias("rule_id"),
        "task_id", "frequency_type", "value_numeric", "interval_text", "pattern", "condition_note",
        "equipment_model_id",
        F.col("equipment_id").alias("rule_equipment_id"),
        F.col("part_type_id").alias("rule_part_type_id"),
    )


def equipment_rules(equipment_base: DataFrame, rules: DataFrame, components: DataFrame) -> DataFrame:
    """Q-G2: every active rule that applies to every unit, tagged with its precedence (1 unit, 2 model, 3 part).

    ``equipment_base`` = ``base(...)`` plus ``equipment_model_id``; its columns ride along so the pick and the due
    values need no further join to equipment.
    """
    r = _rule_attrs(rules)
    attrs = ["rule_id", "task_id", "frequency_type", "value_numeric", "interval_text", "pattern", "condition_note"]
    eq = equipment_base

    unit_rules = r.where(F.col("rule_equipment_id").isNotNull()).select(*attrs, "rule_equipment_id")
    p1 = eq.join(unit_rules, eq.equipment_id == unit_rules.rule_equipment_id).select(
        *eq.columns, *attrs, F.lit(1).alias("precedence")
    )

    model_rules = r.where(F.col("rule_equipment_id").isNull() & F.col("equipment_model_id").isNotNull()).select(
        *attrs, "equipment_model_id"
    )
    p2 = eq.join(model_rules, "equipment_model_id").select(*eq.columns, *attrs, F.lit(2).alias("precedence"))

    part_rules = r.where(
        F.col("rule_equipment_id").isNull()
        & F.col("equipment_model_id").isNull()
        & F.col("rule_part_type_id").isNotNull()
    )
    part_keys = part_rules.select("rule_id", F.col("rule_part_type_id").alias("part_type_id"))
    installed = components.where(F.col("removed_at").isNull()).select("equipment_id", "part_type_id")
    matched = installed.join(part_keys, "part_type_id").select("equipment_id", "rule_id").distinct()
    p3 = (
        matched.join(part_rules.select(*attrs), "rule_id")
        .join(eq, "equipment_id")
        .select(*eq.columns, *attrs, F.lit(3).alias("precedence"))
    )
    return p1.unionByName(p2).unionByName(p3)


def picked_rules(matched: DataFrame) -> DataFrame:
    """Q-G3: one rule per (equipment, task, frequency) -- lowest precedence, then lowest rule id (tie-break)."""
    w = Window.partitionBy("equipment_id", "task_id", "frequency_type").orderBy("precedence", "rule_id")
    clustered = matched.repartition("equipment_id", "task_id")
    return clustered.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _dec(v) -> Column:
    return F.lit(Decimal(str(v)))


def due_values(picked: DataFrame, last: DataFrame) -> DataFrame:
    """Q-G5..Q-G7 in one pass: next due date (time rules) or next due meter and remaining (usage rules)."""
    j = picked.join(last, ["equipment_id", "task_id"], "left")
    if "has_farm" in j.columns:  # the due branches inner-join base: units without a farm row drop out here
        j = j.where(F.col("has_farm")).drop("has_farm")
    freq, value = F.col("frequency_type"), F.col("value_numeric")
    zero = F.lit(0).cast(METER)
    baseline = F.coalesce(F.col("last_date"), F.col("equip_created"))
    is_time = freq.isin(*TIME_FREQUENCIES)

    def usage(kind: str, current: str, last_col: str) -> tuple[Column, Column]:
        ok = (freq == kind) & F.col(current).isNotNull() & value.isNotNull()
        nxt = F.coalesce(F.col(last_col), zero) + value
        return F.when(ok, nxt), F.when(ok, F.greatest(nxt - F.col(current), zero))

    hours_at, hours_left = usage("HOURS", "engine_hours", "last_hours")
    km_at, km_left = usage("KM", "odometer_km", "last_km")
    return j.select(
        *[c for c in j.columns if c not in ("last_date", "last_hours", "last_km")],
        F.when(is_time, add_frequency(baseline, freq, value)).alias("next_due_date"),
        hours_at.cast(DUE_NUM).alias("next_due_at_hours"),
        hours_left.cast(DUE_NUM).alias("hours_remaining"),
        km_at.cast(DUE_NUM).alias("next_due_at_km"),
        km_left.cast(DUE_NUM).alias("km_remaining"),
    )


def _threshold(value, default) -> Column:
    # COALESCE(p, default) of the procedure: a NULL parameter falls back to the default
    return _dec(default if value is None else value)


def stage(
    values: DataFrame,
    as_of: dt.date,
    computed_at: dt.datetime,
    days_ahead: int | None = DEFAULT_DAYS_AHEAD,
    hours_ahead=DEFAULT_HOURS_AHEAD,
    km_ahead=DEFAULT_KM_AHEAD,
) -> DataFrame:
    """Q-G8: severity + branch filters; the rows the procedure stages (OVERDUE / DUE_SOON only)."""
    today = F.lit(as_of)
    freq = F.col("frequency_type")
    nxt = F.col("next_due_date")
    # NULL days: `(NULL || ' days')::interval` is NULL and every time row fails the bound
    bound = F.date_add(today, F.lit(days_ahead)) if days_ahead is not None else F.lit(None).cast("date")
    h_lim, k_lim = _threshold(hours_ahead, DEFAULT_HOURS_AHEAD), _threshold(km_ahead, DEFAULT_KM_AHEAD)
    h_left, k_left = F.col("hours_remaining"), F.col("km_remaining")

    time_sev = F.when(nxt < today, OVERDUE).when(nxt <= bound, DUE_SOON).otherwise(INFO)
    hours_sev = F.when(h_left.isNull(), INFO).when(h_left <= 0, OVERDUE).when(h_left <= h_lim, DUE_SOON).otherwise(INFO)
    km_sev = F.when(k_left.isNull(), INFO).when(k_left <= 0, OVERDUE).when(k_left <= k_lim, DUE_SOON).otherwise(INFO)

    keep_time = freq.isin(*TIME_FREQUENCIES) & nxt.isNotNull() & (nxt <= bound)
    keep_hours = (freq == "HOURS") & F.col("next_due_at_hours").isNotNull() & ((h_left <= h_lim) | (h_left <= 0))
    keep_km = (freq == "KM") & F.col("next_due_at_km").isNotNull() & ((k_left <= k_lim) | (k_left <= 0))

    out = values.where(keep_time | keep_hours | keep_km).select(
        F.lit(computed_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("computed_at"),
        "company_id", "farm_id", "equipment_id", "task_id", "rule_id",
        nxt.alias("next_due_date"),
        F.datediff(nxt, today).alias("days_until_due"),
        "next_due_at_hours", "hours_remaining", "next_due_at_km", "km_remaining",
        F.when(freq.isin(*TIME_FREQUENCIES), time_sev).when(freq == "HOURS", hours_sev).otherwise(km_sev).alias(
            "severity"
        ),
    )
    # W-07: keep only actionable severities (a no-op given the filters above, kept as in the reference)
    out = out.where(F.col("severity").isin(*ACTIONABLE))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in DUE_STAGE.fields])


# --------------------------------------------------------------------------------------------------------------
# stored last_log (incremental daily upkeep), in buckets by (unit, task)

LAST_LOG_KEY = ["equipment_id", "task_id"]
LAST_LOG = StructType(
    [StructField(c, LongType(), True) for c in LAST_LOG_KEY]
    + [StructField("last_date", DateType(), True), StructField("last_hours", METER, True), StructField("last_km", METER, True)]
)


def read_last_log_store(spark, root: str) -> DataFrame | None:
    """The stored ``last_log``, or None before the first arrival."""
    version = versions.current(spark, root)
    return buckets.read(spark, version.parts, "last_log", LAST_LOG) if version.number else None


def update_last_log_store(spark, arrival: str, logs: DataFrame, root: str, n: int = 64) -> DataFrame:
    """Fold one arrival of logs into the stored ``last_log`` and commit it; returns the store.

    Only the buckets of the arrival's (unit, task) pairs are read and rewritten. What was folded is remembered by the
    arrivals' names, not by a bound on ids or dates: a log with a lower id or an older date that comes later still counts, and
    an arrival delivered again changes nothing. A second writer on the same version gets ``versions.Conflict``.
    """
    base = versions.current(spark, root)
    folded = base.facts.get("arrivals", [])
    if arrival not in folded:
        n = base.facts.get("buckets", n)
        touched = buckets.touched(logs, LAST_LOG_KEY, n)
        merged = merge_last_log(buckets.read(spark, base.parts, "last_log", LAST_LOG, touched), logs)
        new = buckets.write(merged, root, "last_log", LAST_LOG_KEY, n) if touched else {}
        parts = buckets.replaced(base.parts, "last_log", touched, new)
        versions.commit(spark, root, base.number, parts, {"arrivals": [*folded, arrival], "buckets": n})
    return read_last_log_store(spark, root)
