"""Structured Streaming forms of the two row triggers (T-01, T-02).

T-01 slot closing: components arrive as files; each micro-batch is resolved by native windows against what is stored of the
slots it touches. The state is a versioned table in buckets by a hash of (unit, slot):

* ``tail``: the row of the highest id of every slot, as it arrived; a batch rewrites the buckets of its own slots only;
* ``past``: all other rows, and those without a unit; a batch appends to the buckets of its own slots. It is read only for groups of
  slots with a late arrival (an id below a slot's highest), whose neighbours are linked anew.

Stored and new rows meet in one shuffle by pieces of buckets; events and state are written from where it leaves them.

So a batch costs what it touches, and ids may arrive in any order. The sink is a changelog, one ``batch=<id>`` folder per
micro-batch: arrivals as resolved so far, and again known rows that close at another time now; the latest event of each id
gives exactly the batch ``close_previous`` table. Events are written before the state is committed with the number of
its batch, so a replayed batch starts from the same state and writes the same events, or is known to be done.

Replays (``run_*_stream``) deliver the input as arrivals written with full parallelism and drain each one with an
``availableNow`` run against the same checkpoint, so state and sink carry over exactly as across restarts.

T-02 auto detail: a stateless projection of the log stream; ``foreachBatch`` assigns ``bigserial`` ids after
a high-water mark kept per micro-batch and writes each micro-batch into its own ``batch=<id>`` directory with
overwrite, so a replayed batch rewrites the same files (idempotent sink).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from upkeep.operators import buckets, versions
from upkeep.operators.buckets import AT_REST
from upkeep.operators.history import SLOT, auto_detail, linked, relinked
from upkeep.session import shared_path
from upkeep.sources.schemas import EQUIPMENT_COMPONENT, MAINTENANCE_LOG, MAINTENANCE_LOG_DETAIL, conform

EVENT_SCHEMA = EQUIPMENT_COMPONENT
EVENTS = StructType([*EVENT_SCHEMA.fields, StructField("batch", IntegerType(), True)])  # the folder of the micro-batch
STATE_BUCKETS = 64
# late arrivals are told by so many groups of slots: the list of those with one is broadcast
LATE_GROUPS = 1 << 16
# appended pieces of a bucket of the past that are rewritten as one
PIECES = 16


def fold_changelog(events: DataFrame) -> DataFrame:
    """Final state per component: the event of its latest ``batch``."""
    # not by a row number, for which Spark would sort the rows by id before they are dealt: they lie by slot, which packs better
    later = F.lead(F.lit(True)).over(Window.partitionBy("id").orderBy("batch"))
    return conform(events.withColumn("_later", later).where(F.col("_later").isNull()), EQUIPMENT_COMPONENT)


def arrival_ranges(df: DataFrame, order_col: str, batches: int) -> list[tuple[int, int]]:
    """``batches`` consecutive [lo, hi) ranges of ``order_col`` covering ``df`` (arrival order); none for an empty table."""
    bounds = df.agg(F.min(order_col).alias("lo"), F.max(order_col).alias("hi")).first()
    if bounds["lo"] is None:
        return []
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = max(1, (hi - lo + batches) // batches)
    return [(lo + k * step, lo + (k + 1) * step) for k in range(batches)]


def in_order(df: DataFrame, batches: int, order_col: str = "id") -> list[DataFrame]:
    """The table as arrivals of rising ``order_col``."""
    return [df.where((F.col(order_col) >= a) & (F.col(order_col) < b)) for a, b in arrival_ranges(df, order_col, batches)]


def shuffled(df: DataFrame, batches: int) -> list[DataFrame]:
    """The table as arrivals that each hold ids from everywhere."""
    return [df.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == F.lit(k)) for k in range(batches)]


def replay(arrivals: Iterable[DataFrame], src: str, run_once: Callable[[], None]) -> None:
    """Deliver frames to the file source ``src`` one after the other.

    Each arrival is written with full parallelism; ``run_once`` then drains it (``availableNow``, no file cap, so
    one arrival = one micro-batch, ordered inside by the operator) against the same checkpoint, so the state store
    and the sink carry over between arrivals exactly as after a restart.
    """
    for k, rows in enumerate(arrivals):
        rows.write.mode("overwrite").option("compression", AT_REST).parquet(os.path.join(src, f"arrival={k:05d}"))
        run_once()


def _stream_dir(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def _pieces(parts: dict[str, str], wanted: Iterable[int]) -> dict[str, str]:
    """Parts of the past (``past/<bucket>/<piece>``) of some buckets."""
    wanted = {str(b) for b in wanted}
    return {n: p for n, p in parts.items() if n.startswith("past/") and n.split("/")[1] in wanted}


def close_batch(spark: SparkSession, state: str, events: str, batch: DataFrame, batch_id: int, n: int = STATE_BUCKETS) -> None:
    """One micro-batch of the slot trigger: write its events, then commit the state after it."""
    base = versions.current(spark, state)
    if base.facts.get("batch", -1) >= batch_id:
        return  # its state is committed, so its events were written before
    n = base.facts.get("buckets", n)
    slotted = batch.where(F.col("slot_label").isNotNull())
    touched = buckets.touched(slotted, SLOT, n)
    columns = EVENT_SCHEMA.fieldNames()
    tails = buckets.read(spark, base.parts, "tail", EVENT_SCHEMA, touched)
    with_unit = F.col("equipment_id").isNotNull()  # rows without a unit link within their batch only
    last = tails.where(with_unit)
    # groups of slots where an id came that is below the highest of a slot: those read the past
    group = F.pmod(F.xxhash64(*SLOT), F.lit(LATE_GROUPS)).cast("int")
    came = slotted.where(with_unit).groupBy(group.alias("_group")).agg(F.min("id").alias("_lowest"))
    stood = last.groupBy(group.alias("_group"), buckets.bucket(SLOT, n).alias("_bucket")).agg(F.max("id").alias("_highest"))
    late = stood.join(came, "_group").where(F.col("_lowest") < F.col("_highest")).select("_group", "_bucket").persist()
    crowded = sorted(r[0] for r in late.select("_bucket").distinct().collect())
    pieces = _pieces(base.parts, crowded)
    known = last.withColumn("_past", F.lit(False))
    if pieces:
        past = spark.read.schema(EVENT_SCHEMA).parquet(*pieces.values()).where(with_unit).withColumn("_group", group)
        past = past.join(F.broadcast(late.select("_group").distinct()), "_group", "left_semi").drop("_group")
        known = known.unionByName(past.withColumn("_past", F.lit(True)))

    # one shuffle of the rows, by pieces of buckets: the events, the new tail and what comes to the past are written from there
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = linked(known, slotted.withColumn("_past", F.lit(False)), deal=[buckets.piece(SLOT, n, tasks)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        relinked(known, batch, rows=rows).write.mode("overwrite").option("compression", AT_REST).parquet(events)
        as_arrived = rows.select(*(F.col("_arrived").alias(c) if c == "removed_at" else F.col(c) for c in columns), "_last", "_past")
        tail = as_arrived.where(F.col("_last") & with_unit).select(*columns)
        parts = buckets.replaced(base.parts, "tail", touched, buckets.write(tail, state, "tail", SLOT, n, dealt=True) if touched else {})
        behind = as_arrived.where(~F.col("_past") & ~(F.col("_last") & with_unit)).select(*columns)
        behind = behind.unionByName(tails.where(~with_unit))
        full = [b for b in touched if len(_pieces(parts, [b])) >= PIECES]
        if full:
            old = _pieces(parts, full)
            behind = behind.unionByName(spark.read.schema(EVENT_SCHEMA).parquet(*old.values()))
            parts = {name: path for name, path in parts.items() if name not in old}
        written = buckets.write(behind, state, "past", SLOT, n, dealt=not full)
        parts |= {f"{name}/{batch_id}": path for name, path in written.items()}
    finally:
        rows.unpersist()
        late.unpersist()
    versions.commit(spark, state, base.number, parts, {"batch": batch_id, "buckets": n})


def run_close_previous_stream(
    spark: SparkSession,
    components: DataFrame,
    batches: int = 4,
    deal: Callable[[DataFrame, int], list[DataFrame]] = in_order,
    base: str | None = None,
    state_buckets: int = STATE_BUCKETS,
) -> DataFrame:
    """Replay ``components`` (as inserted), dealt into arrivals by ``deal``, through the streaming trigger; return the folded
    table."""
    base = base or _stream_dir(spark, "components")
    src, sink, state, ckpt = (os.path.join(base, p) for p in ("source", "sink", "state", "checkpoint"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        close_batch(spark, state, os.path.join(sink, f"batch={batch_id}"), batch.select(*EVENT_SCHEMA.fieldNames()), batch_id, state_buckets)

    def run_once() -> None:
        stream = spark.readStream.schema(EQUIPMENT_COMPONENT).option("recursiveFileLookup", "true").parquet(src)
        q = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt).trigger(availableNow=True)
        q.start().awaitTermination()

    replay(deal(conform(components, EQUIPMENT_COMPONENT), batches), src, run_once)
    if not versions.children(spark, sink):
        return spark.createDataFrame([], EQUIPMENT_COMPONENT)
    return fold_changelog(spark.read.schema(EVENTS).parquet(sink))


def run_auto_detail_stream(spark: SparkSession, details: DataFrame, logs: DataFrame, batches: int = 4) -> DataFrame:
    """Replay ``logs`` through the streaming auto-detail trigger on top of ``details``; return the detail table.

    Ids continue ``bigserial``-style from a high-water-mark table (one row per micro-batch), so a batch reads one
    tiny row per earlier batch instead of scanning the detail table; a replayed batch ignores marks of itself and
    of later batches and rewrites its own directory, so replays are idempotent.
    """
    base = _stream_dir(spark, "logs")
    src, sink, marks, ckpt = (os.path.join(base, p) for p in ("source", "sink", "marks", "checkpoint"))
    initial = conform(details, MAINTENANCE_LOG_DETAIL)
    initial.write.mode("overwrite").parquet(os.path.join(sink, "batch=-1"))
    initial.agg(F.coalesce(F.max("id"), F.lit(0)).alias("hwm")).write.mode("overwrite").parquet(
        os.path.join(marks, "batch=-1")
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        earlier = spark.read.parquet(marks).where(F.col("batch") < batch_id)
        start = int(earlier.agg(F.max("hwm").alias("m")).first()["m"])
        lines = auto_detail(batch, start)
        lines.write.mode("overwrite").parquet(os.path.join(sink, f"batch={batch_id}"))
        lines.agg(F.coalesce(F.max("id"), F.lit(start)).alias("hwm")).write.mode("overwrite").parquet(
            os.path.join(marks, f"batch={batch_id}")
        )

    def run_once() -> None:
        stream = spark.readStream.schema(MAINTENANCE_LOG).option("recursiveFileLookup", "true").parquet(src)
        q = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt).trigger(availableNow=True)
        q.start().awaitTermination()

    replay(in_order(conform(logs, MAINTENANCE_LOG), batches), src, run_once)
    return spark.read.schema(MAINTENANCE_LOG_DETAIL).parquet(sink).select(*MAINTENANCE_LOG_DETAIL.fieldNames())
