"""Idempotent loading (W-01, W-02, P-06): defaults, insert-if-absent by natural key, natural-key -> id lookups.

The reference's seed guards every INSERT with ``WHERE NOT EXISTS (same natural key)``; the guard sees the table as
it was before the statement. For a whole batch that is: drop batch rows whose key already exists (anti join), and
within the batch keep the first arrival per key (``row_number() = 1`` by arrival order -- Spark pre-computes the
per-key top-1 map-side with a partial ``WindowGroupLimit``, so a hot key never reaches one reducer in full).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# What identifies a row in the seed's NOT EXISTS guards, per table.
NATURAL_KEYS: dict[str, list[str]] = {
    "company": ["name"],
    "farm": ["name", "company_id"],
    "equipment_model": ["manufacturer", "model_name"],
    "part_type": ["name"],
    "equipment": ["display_name"],
    "equipment_component": ["equipment_id", "slot_label"],
    "maintenance_task": ["name"],
    "maintenance_rule": ["task_id", "scope", "scope_id", "frequency_type"],
    "maintenance_log": ["equipment_id", "task_id"],
    "maintenance_log_detail": ["maintenance_log_id"],
}


def keyed(name: str, rows: DataFrame) -> DataFrame:
    """The rows a guard looks at, with its key columns: installed components only, and a rule's scope as two columns."""
    if name == "equipment_component":
        return rows.where(F.col("removed_at").isNull())
    if name == "maintenance_rule":
        scopes = ["equipment_id", "equipment_model_id", "part_type_id"]
        scope = F.coalesce(*(F.when(F.col(c).isNotNull(), F.lit(c)) for c in scopes))
        return rows.withColumn("scope", scope).withColumn("scope_id", F.coalesce(*scopes))
    return rows


def load_table(name: str, existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` that the seed's guard of table ``name`` lets in, the first arrival per natural key.

    A removed component neither blocks a new one in its slot nor is blocked: only installed rows are compared.
    """
    key = NATURAL_KEYS[name]
    fresh = new_rows(keyed(name, existing).select(*key), keyed(name, batch), key).select(*batch.columns)
    if name == "equipment_component":
        fresh = fresh.unionByName(batch.where(F.col("removed_at").isNotNull()).join(existing.select("id"), "id", "left_anti"))
    return fresh


def append_with_defaults(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """W-01: columns left out of an insert take their DEFAULT (``now()``, ``current_date``, ``true`` ...).

    As in SQL, a default stands in for an omitted column only; an explicit NULL stays NULL (and NOT NULL checks see it).
    """
    return rows.withColumns({c: value for c, value in defaults.items() if c not in rows.columns})


def new_rows(known: DataFrame, batch: DataFrame, key: Sequence[str], arrival: str = "id") -> DataFrame:
    """Batch rows whose key is not in ``known``, first arrival per key.

    Keys use SQL equality, so a NULL key part never matches (a NULL key is always inserted, like NOT EXISTS). A key is let in or
    not whichever of its rows is looked at, so the first arrivals are taken before the known keys: only they are dealt by key.
    """
    key = list(key)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    first = Window.partitionBy(*key).orderBy(arrival)
    first_rows = batch.where(complete).withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1).drop("_rn")
    fresh = first_rows.join(known.select(*key).where(complete).distinct(), key, "left_anti").select(*batch.columns)
    # a key with a NULL part never equals anything, so every such row passes its guard
    return fresh.unionByName(batch.where(~complete))


def insert_if_absent(existing: DataFrame, batch: DataFrame, key: Sequence[str], arrival: str = "id") -> DataFrame:
    """W-02: ``existing`` plus the batch rows whose natural key is new (first arrival per key wins)."""
    return existing.unionByName(new_rows(existing, batch, key, arrival).select(*existing.columns))


def lookup_id(
    rows: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    id_col: str = "id",
    as_name: str = "ref_id",
    check_unique: bool = True,
) -> DataFrame:
    """P-06: ``(SELECT id FROM dim WHERE natural key = row's values)`` as a left join.

    The scalar subquery fails when a key that is looked up has more than one match; ``check_unique`` enforces the same on
    those keys only. Keys with a NULL part match nothing.
    """
    dkeys = list(on.values())
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in dkeys])
    d = dim.where(complete).select(*[F.col(k).alias(f"_k_{k}") for k in dkeys], F.col(id_col).alias(as_name))
    cond = [rows[r] == d[f"_k_{k}"] for r, k in on.items()]
    if check_unique:
        asked = d.join(rows.select(*[F.col(r).alias(f"_k_{k}") for r, k in on.items()]).distinct(), [f"_k_{k}" for k in dkeys], "left_semi")
        if asked.groupBy(*[f"_k_{k}" for k in dkeys]).count().where(F.col("count") > 1).limit(1).count():
            raise ValueError(f"a key {dkeys} that is looked up is not unique (the scalar subquery would fail)")
    return rows.join(d, cond, "left").drop(*[f"_k_{k}" for k in dkeys])
