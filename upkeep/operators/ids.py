"""Sequential surrogate ids (``serial`` / ``bigserial`` semantics) without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no PARTITION BY pulls every row into one task. Instead:

1. persist the input (so the boundary sampling and the tagging pass do not evaluate the upstream plan twice),
   range-partition on the order keys (sampled boundaries, distributed) and sort inside each partition;
2. tag rows with (partition id, position inside the partition) and checkpoint, so the tags are computed exactly
   once and survive executor loss;
3. count rows per partition -- one row per partition, a proven size bound -- and turn the counts into offsets;
4. broadcast the offsets and add ``offset + position``.

The result equals ``start_after + row_number() OVER (ORDER BY order_cols)`` when the order keys are unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark import StorageLevel
from pyspark.sql import functions as F

from upkeep.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id() = (partition index << 33) + record number


def with_sequence(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    name: str = "id",
    start_after: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pid = F.spark_partition_id()
    source = df.persist(StorageLevel.MEMORY_AND_DISK)
    tagged = (
        source.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_seq_pid", pid)
        .withColumn("_seq_pos", F.monotonically_increasing_id() - pid.cast("bigint") * F.lit(1 << _POS_BITS))
        .checkpoint(eager=True)
    )
    source.unpersist()
    counts = tagged.groupBy("_seq_pid").agg(F.count(F.lit(1)).alias("_seq_n"))
    before = Window.orderBy("_seq_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_seq_pid", F.coalesce(F.sum("_seq_n").over(before), F.lit(0)).alias("_seq_off"))
    return (
        tagged.join(F.broadcast(offsets), "_seq_pid")
        .withColumn(name, F.lit(start_after).cast("bigint") + F.col("_seq_off") + F.col("_seq_pos") + F.lit(1))
        .drop("_seq_pid", "_seq_pos", "_seq_off")
    )


def with_offsets(df: DataFrame, key: str, count: str, name: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` (one row per ``key``) with ``name``: the sum of ``count`` over all rows of smaller keys.

    With the rank of a row inside its key this numbers rows as ``with_sequence`` does, while only one narrow row per key is
    sorted. Sums run inside range partitions; a partition's start is broadcast, as above.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = df.columns.index(count)

    def running(batches):
        import numpy as np
        import pyarrow as pa

        total = 0
        for batch in batches:
            counts = batch.column(place).to_numpy()
            before = total + np.cumsum(counts) - counts
            total += int(counts.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], [*batch.schema.names, "_off_in"])

    dealt = df.repartitionByRange(n, key).sortWithinPartitions(key)
    schema = ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)
    summed = dealt.mapInArrow(running, f"{schema}, _off_in bigint").withColumn("_off_pid", F.spark_partition_id()).checkpoint(eager=True)
    sums = summed.groupBy("_off_pid").agg(F.sum(count).alias("_off_n"))
    before = Window.orderBy("_off_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_off_pid", F.coalesce(F.sum("_off_n").over(before), F.lit(0)).alias("_off"))
    out = summed.join(F.broadcast(starts), "_off_pid")
    return out.select(*df.columns, (F.col("_off") + F.col("_off_in")).cast("bigint").alias(name))
