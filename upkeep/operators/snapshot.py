"""The ``due_soon`` snapshot as a whole frame: upsert, purge, cascades (W-08 ... W-13); at rest see ``plans.due_store``.

Parquet has no MERGE, so an upsert is one FULL OUTER JOIN of the old snapshot and the stage on the unique key
(equipment, task, rule):

* key in both   -> stage values, old ``id`` kept (ON CONFLICT DO UPDATE);
* stage only    -> inserted, ``id`` continues after the old maximum (``bigserial``), in key order;
* old only      -> deleted when ``purge`` (the NOT EXISTS purge), else kept unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.operators.ids import with_sequence
from upkeep.sources.schemas import DUE_SOON, conform

KEY = ["equipment_id", "task_id", "rule_id"]


def max_id(df: DataFrame) -> int:
    """Largest ``id`` (0 for an empty table): one scalar to the driver."""
    return int(df.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"])


def initial_snapshot(stage: DataFrame) -> DataFrame:
    """A first refresh into an empty snapshot: ids 1..n in key order."""
    return conform(with_sequence(stage, KEY, "id"), DUE_SOON)


def upsert(old: DataFrame, stage: DataFrame, purge: bool = True, last_id: int | None = None) -> DataFrame:
    """``old`` after the procedure; ids continue after ``last_id`` (else after the highest that ``old`` still has)."""
    o = old.select(*[F.col(c).alias(f"_o_{c}") for c in DUE_SOON.fieldNames()])
    s = stage.withColumn("_in_stage", F.lit(True))
    # computed once; new and kept rows are taken apart from the checkpoint
    j = s.join(o, [s[k] == o[f"_o_{k}"] for k in KEY], "left" if purge else "full").checkpoint()
    in_stage = F.col("_in_stage").isNotNull()
    columns = [c for c in DUE_SOON.fieldNames() if c != "id"]
    kept = j.where(F.col("_o_id").isNotNull()).select(
        F.col("_o_id").alias("id"), *[F.when(in_stage, F.col(c)).otherwise(F.col(f"_o_{c}")).alias(c) for c in columns]
    )
    # only new rows are sorted and numbered
    new = with_sequence(j.where(F.col("_o_id").isNull()).select(*columns), KEY, "id", max_id(old) if last_id is None else last_id)
    return conform(kept, DUE_SOON).unionByName(conform(new, DUE_SOON))


# --------------------------------------------------------------------------------------------------------------
# referential actions on delete


def cascade_delete(child: DataFrame, fk: str, deleted_parent_ids: DataFrame) -> DataFrame:
    """W-12: child rows whose ``fk`` points at a deleted parent go too (ON DELETE CASCADE)."""
    gone = deleted_parent_ids.select(F.col(deleted_parent_ids.columns[0]).alias(fk))
    return child.join(gone, fk, "left_anti")


def set_null_on_delete(child: DataFrame, fk: str, deleted_parent_ids: DataFrame) -> DataFrame:
    """W-13: ``fk`` becomes NULL where it points at a deleted parent (ON DELETE SET NULL)."""
    gone = deleted_parent_ids.select(F.col(deleted_parent_ids.columns[0]).alias("_gone")).distinct()
    j = child.join(gone, child[fk] == gone["_gone"], "left")
    return j.select(*[F.when(F.col("_gone").isNotNull(), None).otherwise(F.col(c)).alias(c) if c == fk else F.col(c)
                      for c in child.columns])
