"""A stored index of natural keys, so that a load does not scan the table it loads into (W-02).

The keys of every table are kept in buckets by a hash of the key. A load reads the buckets of its batch's keys only,
lets in the rows whose key is not there, and appends their keys as new pieces of those buckets in one commit. A
second load built on the same version gets ``versions.Conflict``, so no key is let in twice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from upkeep.operators import buckets, load, versions

# appended pieces of a bucket that are rewritten as one
PIECES = 16
REMOVED = "equipment_component_removed"  # removed components are told apart by their id


def _pieces(parts: dict[str, str], kind: str, only: Iterable[int]) -> dict[str, str]:
    wanted = {str(b) for b in only}
    return {n: p for n, p in parts.items() if n.startswith(f"{kind}/") and n.split("/")[1] in wanted}


def known_keys(spark: SparkSession, version: versions.Version, kind: str, schema: StructType, only: Iterable[int]) -> DataFrame:
    """The keys of some buckets; no other file is listed."""
    paths = list(_pieces(version.parts, kind, only).values())
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _admit(spark: SparkSession, root: str, version: versions.Version, kind: str, batch: DataFrame, key: list[str], n: int) -> tuple[DataFrame, dict]:
    """Rows of ``batch`` with a new key, and the parts after their keys are stored."""
    keys = batch.select(*key)
    touched = buckets.touched(keys, key, n)
    known = known_keys(spark, version, kind, keys.schema, touched)
    fresh = load.new_rows(known, batch, key).checkpoint()
    added = fresh.select(*key).dropna()
    parts = version.parts
    full = [b for b in touched if len(_pieces(parts, kind, [b])) >= PIECES]
    if full:
        added = added.unionByName(known_keys(spark, version, kind, keys.schema, full))
        parts = {name: path for name, path in parts.items() if name not in _pieces(parts, kind, full)}
    new = buckets.write(added, root, kind, key, n)
    return fresh, parts | {f"{name}/{version.number + 1}": path for name, path in new.items()}


def load_indexed(spark: SparkSession, root: str, name: str, batch: DataFrame, n: int = 64) -> DataFrame:
    """``load.load_table`` against the stored keys of table ``name`` (an index folder each): the rows let in, whose keys are
    stored now."""
    version = versions.current(spark, root)
    n = version.facts.get("buckets", n)
    fresh, parts = _admit(spark, root, version, name, load.keyed(name, batch), load.NATURAL_KEYS[name], n)
    fresh = fresh.select(*batch.columns)
    if name == "equipment_component":
        closed = batch.where(F.col("removed_at").isNotNull())
        between = versions.Version(version.number, parts, version.facts)
        again, parts = _admit(spark, root, between, REMOVED, closed, ["id"], n)
        fresh = fresh.unionByName(again.select(*batch.columns))
    versions.commit(spark, root, version.number, parts, {"buckets": n})
    return fresh
