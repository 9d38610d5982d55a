"""Picked rules and last logs stored bucketed by (unit, task), so that their join needs no exchange (J-11, J-12, A-01).

Both sides are written as bucketed tables with the same number of buckets, sorted inside; Spark then reads matching buckets
into one task each and merges them. The daily due values are a scan of two tables that way, however large.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = ["equipment_id", "task_id"]


def store(df: DataFrame, path: str, name: str, n: int) -> DataFrame:
    """``df`` as a table below ``path``, bucketed and sorted by (unit, task), under a name of its own in the session's catalog."""
    spark: SparkSession = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    # one task per bucket, so that a bucket is one file
    dealt = df.repartition(n, *KEY)
    dealt.write.bucketBy(n, *KEY).sortBy(*KEY).option("path", f"{path}/{table}").saveAsTable(table)
    return spark.table(table)

