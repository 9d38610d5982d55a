"""Component slot history (W-03 / E-02) and automatic detail lines (W-04 / E-03).

The reference does both with row triggers. Rows of one insert are processed in arrival order (the ``id``), each
seeing the rows before it, so a whole batch can be resolved with one window instead of a per-row loop:

* inserting component ``n`` into (equipment, slot) closes every *open* row of that slot at ``n.installed_at``;
  at most one row is open at any time (the latest arrival, if it came without ``removed_at``), so the final
  ``removed_at`` of a row is its own value if it arrived closed, else the ``installed_at`` of the next arrival in
  the same slot, else NULL. NULL slots are never closed. This keeps the reference's quirks: historical rows close
  the open row too, and out-of-order dates give ``removed_at < installed_at``.
* a log that names a single component gets one ``INSPECT`` line; the trigger never checks for existing lines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.operators.ids import with_sequence
from upkeep.sources.schemas import MAINTENANCE_LOG_DETAIL, conform

# Fixed values of the reference's auto-detail trigger.
AUTO_DETAIL_ACTION = "INSPECT"
AUTO_DETAIL_NOTE = "Auto-created detail for single-component log"


def _ts(value: dt.datetime | None):
    if value is None:
        return F.localtimestamp()
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


SLOT = ["equipment_id", "slot_label"]
# rows of a slot that may have more rows than this are closed in buckets of so many arrival ids, so no task holds the whole of a hot slot
BUCKET_IDS = 5_000_000
# slots are counted in so many groups, so that finding the hot ones moves a few numbers only
GROUPS = 8192


def _told_hot(rows: DataFrame, bucket_ids: int) -> DataFrame:
    """``rows`` with ``_hot``: whether their slot may have more than ``bucket_ids`` rows (its group of slots has)."""
    group = F.pmod(F.xxhash64(*SLOT), F.lit(GROUPS))
    many = rows.groupBy(group.alias("_many")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bucket_ids).select("_many")
    told = rows.withColumn("_group", group).join(F.broadcast(many), F.col("_group") == F.col("_many"), "left")
    return told.withColumn("_hot", F.col("_many").isNotNull()).drop("_group", "_many")


def close_previous(components: DataFrame, now: dt.datetime | None = None, bucket_ids: int = BUCKET_IDS) -> DataFrame:
    """Apply the slot-closing trigger to ``components`` taken in ``id`` (arrival) order.

    The next arrival is found inside each slot. Of a slot that may have more than ``bucket_ids`` rows it is found inside each
    (slot, id bucket); a bucket's last row is closed by the first row of the slot's next bucket (one row per bucket). Rows without a
    slot are never closed and bypass the windows. ``now`` stands for ``now()`` when an arriving row has no ``installed_at`` (a dead
    branch on valid rows, kept for fidelity).
    """
    cols = components.columns
    loose = components.where(F.col("slot_label").isNull())
    installed = F.coalesce(F.col("installed_at"), _ts(now))
    told = _told_hot(components.where(F.col("slot_label").isNotNull()), bucket_ids)
    usual = told.where(~F.col("_hot")).withColumn("_next", F.lead(installed).over(Window.partitionBy(*SLOT).orderBy("id")))
    usual = usual.withColumn("removed_at", F.coalesce("removed_at", "_next"))
    rows = told.where("_hot").withColumn("_b", F.floor(F.col("id") / F.lit(bucket_ids)))
    inside = rows.withColumn("_next", F.lead(installed).over(Window.partitionBy(*SLOT, "_b").orderBy("id")))
    first = rows.groupBy(*SLOT, "_b").agg(F.min_by(installed, F.col("id")).alias("_first"))
    following = first.withColumn("_later", F.lead("_first").over(Window.partitionBy(*SLOT).orderBy("_b"))).select(*SLOT, "_b", "_later")
    closed = inside.join(following.where(F.col("_later").isNotNull()), [*SLOT, "_b"], "left").withColumn(
        "removed_at", F.coalesce("removed_at", "_next", "_later")
    )
    return usual.select(*cols).unionByName(closed.select(*cols)).unionByName(loose)


def close_previous_incremental(open_rows: DataFrame, batch: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Resolve a new batch against the currently open rows of the same slots.

    ``open_rows``: stored rows with ``removed_at IS NULL``; only those of slots touched by the batch are read
    (semi join), so the work grows with the batch, not with the history. Returns the touched open rows (possibly
    closed now) plus the batch rows, all resolved.
    """
    keys = ["equipment_id", "slot_label"]
    touched = batch.where(F.col("slot_label").isNotNull()).select(*keys).distinct()
    prior = open_rows.where(F.col("removed_at").isNull()).join(touched, keys, "left_semi")
    return close_previous(prior.unionByName(batch), now)


def linked(
    known: DataFrame, batch: DataFrame, now: dt.datetime | None = None, bucket_ids: int = BUCKET_IDS, deal: Sequence[Column] = ()
) -> DataFrame:
    """Known rows and those of an arrival that have a slot, resolved in one shuffle of the rows: ``removed_at`` as it is now and ``_arrived``
    as it came, ``_known``, ``_changed`` (new, or closed at another time than before) and ``_last`` (the highest id of its slot).

    ``deal``: functions of the slot by which rows are dealt to tasks instead of by slot, for a caller that stores them by those.
    Further columns that both frames have are kept.
    """
    both = known.withColumn("_known", F.lit(True)).unionByName(batch.withColumn("_known", F.lit(False)))
    installed = F.coalesce(F.col("installed_at"), _ts(now))
    told = _told_hot(both.where(F.col("slot_label").isNotNull()), bucket_ids)
    times = {"_in": installed, "_known_in": F.when(F.col("_known"), installed)}
    # rows alike in all columns but these are the same row, so that all that is written of one evaluation fits another
    order = ", ".join(f"`{c}`" for c in ["id", *(c for c in both.columns if c not in ("id", *SLOT))])

    def nexts(rows: DataFrame, by: list[str]) -> DataFrame:
        inside = f"OVER (PARTITION BY {', '.join(by)} ORDER BY {order})"
        found = {"_next": "lead(_in)", "_known_next": "lead(_known_in) IGNORE NULLS", "_last": "lead(true)"}
        return rows.withColumns(times).withColumns({c: F.expr(f"{e} {inside}") for c, e in found.items()}).withColumn("_last", F.col("_last").isNull())

    # the windows' keys hold what rows are dealt by, so they need no shuffle of their own
    dealt = [f"_deal_{k}" for k in range(len(deal))]
    usual = told.where(~F.col("_hot")).withColumns(dict(zip(dealt, deal, strict=True))).repartition(*(dealt or SLOT))
    usual = nexts(usual, [*dealt, *SLOT]).withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("_later", "_known_later")})

    crowded = told.where("_hot").withColumn("_b", F.floor(F.col("id") / F.lit(bucket_ids)))
    later = "OVER (PARTITION BY equipment_id, slot_label ORDER BY _b)"
    first = crowded.withColumns(times).groupBy(*SLOT, "_b").agg(F.min_by("_in", F.col("id")).alias("_f"), F.min_by("_known_in", F.when(F.col("_known"), F.col("id"))).alias("_kf"))
    following = first.select(*SLOT, "_b", F.expr(f"lead(_f) {later}").alias("_later"), F.expr(f"lead(_kf) IGNORE NULLS {later}").alias("_known_later"))
    following = following.where(F.col("_later").isNotNull())
    hot = nexts(crowded.repartition(*SLOT, "_b"), [*SLOT, "_b"]).join(following, [*SLOT, "_b"], "left")
    hot = hot.withColumn("_last", F.col("_last") & F.col("_later").isNull())

    columns = [*both.columns, "_last", "_next", "_known_next", "_later", "_known_later"]
    before = F.coalesce("removed_at", "_known_next", "_known_later")
    after = F.coalesce("removed_at", "_next", "_later")
    out = usual.select(*columns).unionByName(hot.select(*columns)).withColumns({"_before": before, "_arrived": F.col("removed_at"), "removed_at": after})
    changed = ~F.col("_known") | ~F.col("removed_at").eqNullSafe(F.col("_before"))
    return out.withColumn("_changed", changed).select(*both.columns, "_arrived", "_changed", "_last")


def relinked(
    known: DataFrame, batch: DataFrame, now: dt.datetime | None = None, bucket_ids: int = BUCKET_IDS, rows: DataFrame | None = None
) -> DataFrame:
    """What an arrival changes, whatever the order of ids: its rows as resolved, and known rows that close at another time now.

    ``known``: the rows of the batch's slots as they had arrived -- of a slot whose arrivals all have higher ids the last one is
    enough, of a slot with a late arrival (a lower id after a higher one) every row, as a late one comes between two neighbours.
    ``rows``: both as ``linked``, where the caller keeps them.
    """
    rows = linked(known, batch, now, bucket_ids) if rows is None else rows
    # rows without a slot are never closed
    return rows.where("_changed").select(*batch.columns).unionByName(batch.where(F.col("slot_label").isNull()))


def auto_detail(logs: DataFrame, start_after: int = 0) -> DataFrame:
    """Detail lines the trigger creates for ``logs`` (only rows naming a component fire it)."""
    fired = logs.where(F.col("equipment_component_id").isNotNull()).select(
        F.col("id").alias("maintenance_log_id"),
        "equipment_component_id",
        F.lit(AUTO_DETAIL_ACTION).alias("action"),
        F.lit(AUTO_DETAIL_NOTE).alias("notes"),
    )
    return conform(with_sequence(fired, ["maintenance_log_id"], "id", start_after), MAINTENANCE_LOG_DETAIL)


def insert_logs_with_trigger(details: DataFrame, new_logs: DataFrame) -> DataFrame:
    """Detail table after inserting ``new_logs`` with the trigger on: existing lines plus the automatic ones."""
    start = details.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    return conform(details, MAINTENANCE_LOG_DETAIL).unionByName(auto_detail(new_logs, int(start)))
