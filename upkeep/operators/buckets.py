"""Bucketed tables of a version: rows dealt to a fixed number of folders by a hash of their unit.

A change rewrites the folders of the buckets it touches; the next version names all others by the paths they have. Reading a few
buckets lists their folders only, so nothing else is scanned.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from upkeep.operators import versions

# codec of tables at rest: about a quarter smaller than Spark's default
AT_REST = "zstd"
# tasks that write one bucket side by side
WRITERS_PER_BUCKET = 2
# pieces of buckets that one task gets of rows dealt by them
PIECES_PER_TASK = 4


def bucket(columns: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def touched(rows: DataFrame, columns: list[str], n: int) -> list[int]:
    """The buckets that rows fall in: at most ``n`` numbers to the driver."""
    return sorted(r[0] for r in rows.select(bucket(columns, n)).distinct().collect())


def read(spark: SparkSession, parts: dict[str, str], kind: str, schema: StructType, only: Iterable[int] | None = None) -> DataFrame:
    """The rows of table ``kind`` in all its buckets, or in those named."""
    if only is None:
        paths = [p for name, p in parts.items() if name.startswith(f"{kind}/")]
    else:
        paths = [parts[f"{kind}/{b}"] for b in only if f"{kind}/{b}" in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def piece(columns: list[str], n: int, tasks: int) -> Column:
    """A number for dealing rows to ``tasks`` tasks, so that each gets rows of few buckets only: every piece lies in one bucket."""
    return F.pmod(F.xxhash64(*columns), F.lit(n * -(-PIECES_PER_TASK * tasks // n))).cast("int")


def write(df: DataFrame, root: str, kind: str, columns: list[str], n: int, dealt: bool = False) -> dict[str, str]:
    """Write the rows into new bucket folders; returns the parts that exist now (a bucket without rows has none).

    ``dealt``: each task has rows of few buckets already (``piece``), so they are written from where they are.
    """
    folder = versions.new_folder(root)
    rows = df.withColumn("_bucket", bucket(columns, n))
    if not dealt:
        rows = rows.repartition("_bucket", F.pmod(F.xxhash64(*(c for c in df.columns)), F.lit(WRITERS_PER_BUCKET)))
    rows.write.partitionBy("_bucket").option("compression", AT_REST).parquet(folder)
    found = [c for c in versions.children(df.sparkSession, folder) if c.startswith("_bucket=")]
    return {f"{kind}/{c.removeprefix('_bucket=')}": f"{folder}/{c}" for c in found}


def replaced(parts: dict[str, str], kind: str, buckets: Iterable[int], new: dict[str, str]) -> dict[str, str]:
    """``parts`` with the named buckets of ``kind`` taken from ``new`` (gone where it has none)."""
    gone = {f"{kind}/{b}" for b in buckets}
    return {name: path for name, path in parts.items() if name not in gone} | new
