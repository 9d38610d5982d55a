"""Base tables and due list at rest as one version, and deletes that rewrite only what they touch (W-12 ... W-14).

Logs and lines are parts by the header's year (``maintenance_log/1995``), the due list by a hash of the unit
(``due_soon/7``). A delete names the rows that go; their lines and snapshot rows go with them (ON DELETE CASCADE), snapshot
columns that point at a deleted company or farm become NULL (ON DELETE SET NULL), and all of it is one commit: readers see
everything before or everything after. Years and buckets without such a row keep their folders.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.operators import buckets, versions
from upkeep.sources.schemas import DUE_SOON, SCHEMAS, conform
from upkeep.sources.tables import YEAR_COL, YEAR_PARTITIONED

UNIT = ["equipment_id"]
# what a deleted parent does to the due list: columns whose rows go, columns that become NULL (fixed values of the schema)
CASCADES = {"units": "equipment_id", "tasks": "task_id", "rules": "rule_id"}
SET_NULL = {"companies": "company_id", "farms": "farm_id"}
HEADER = {"maintenance_log": "id", "maintenance_log_detail": "maintenance_log_id"}


def publish(spark: SparkSession, root: str, tables_root: str, due: DataFrame, n: int = 64) -> versions.Version:
    """First version: the written tables of ``sources.tables.write_tables`` by reference, the due list in buckets."""
    parts = {}
    for name in YEAR_PARTITIONED:
        for folder in versions.children(spark, f"{tables_root}/{name}"):
            if folder.startswith(f"{YEAR_COL}="):
                parts[f"{name}/{folder.split('=')[1]}"] = f"{tables_root}/{name}/{folder}"
    parts |= buckets.write(conform(due, DUE_SOON), root, "due_soon", UNIT, n)
    return versions.commit(spark, root, 0, parts, {"buckets": n})


def years(version: versions.Version, name: str) -> list[str]:
    return sorted(part.split("/")[1] for part in version.parts if part.startswith(f"{name}/"))


def read_years(spark: SparkSession, version: versions.Version, name: str, only: Iterable[str] | None = None) -> DataFrame:
    """Rows of a yearly table with ``performed_year``; the folders of other years are not listed."""
    frames = [
        spark.read.schema(SCHEMAS[name]).parquet(version.parts[f"{name}/{y}"]).withColumn(YEAR_COL, F.lit(int(y) if y.lstrip("-").isdigit() else None).cast("int"))
        for y in (years(version, name) if only is None else only)
        if f"{name}/{y}" in version.parts
    ]
    empty = spark.createDataFrame([], SCHEMAS[name]).withColumn(YEAR_COL, F.lit(None).cast("int"))
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else empty


def read_due(spark: SparkSession, version: versions.Version) -> DataFrame:
    return buckets.read(spark, version.parts, "due_soon", DUE_SOON)


def _year_label() -> F.Column:
    return F.coalesce(F.col(YEAR_COL).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))


def _without_logs(spark: SparkSession, root: str, base: versions.Version, logs: DataFrame) -> dict[str, str]:
    """Parts after deleting logs (id, performed_year) and their lines: the years of deleted logs are written anew."""
    parts = dict(base.parts)
    gone = logs.select("id", YEAR_COL).distinct().checkpoint()
    touched = [r[0] for r in gone.select(_year_label()).distinct().collect()]  # at most one row a year
    for name, key in HEADER.items():
        if not touched:
            continue
        ids = gone.select(F.col("id").alias(key))
        folder = versions.new_folder(root)
        kept = read_years(spark, base, name, touched).join(ids, key, "left_anti")
        kept.select(*SCHEMAS[name].fieldNames(), YEAR_COL).write.partitionBy(YEAR_COL).parquet(folder)
        new = {f"{name}/{c.split('=')[1]}": f"{folder}/{c}" for c in versions.children(spark, folder) if c.startswith(f"{YEAR_COL}=")}
        parts = {p: path for p, path in parts.items() if p not in {f"{name}/{y}" for y in touched}} | new
    return parts


def delete(spark: SparkSession, root: str, logs: DataFrame | None = None, **parents: DataFrame) -> versions.Version:
    """Delete logs (id, performed_year) and parents of the due list (``units``, ``tasks``, ``rules``, ``companies``, ``farms``:
    frames of ids) with everything that hangs on them, as one commit."""
    base = versions.current(spark, root)
    parts = dict(base.parts) if logs is None else _without_logs(spark, root, base, logs)
    if parents:
        n = base.facts["buckets"]
        rows = read_due(spark, base)
        for kind, ids in parents.items():
            column = CASCADES.get(kind) or SET_NULL[kind]
            gone = ids.select(F.col(ids.columns[0]).alias(f"_{kind}")).distinct()
            rows = rows.join(gone, rows[column] == gone[f"_{kind}"], "left")
        hit = {kind: F.col(f"_{kind}").isNotNull() for kind in parents}
        touched = buckets.touched(rows.where(reduce(lambda a, b: a | b, hit.values())), UNIT, n)
        if touched:
            falls = [hit[k] for k in parents if k in CASCADES]
            here = rows.where(buckets.bucket(UNIT, n).isin(touched))
            if falls:
                here = here.where(~reduce(lambda a, b: a | b, falls))
            nulls = {SET_NULL[k]: F.when(~hit[k], F.col(SET_NULL[k])) for k in parents if k in SET_NULL}
            new = buckets.write(here.withColumns(nulls).select(*DUE_SOON.fieldNames()), root, "due_soon", UNIT, n)
            parts = buckets.replaced(parts, "due_soon", touched, new)
    return versions.commit(spark, root, base.number, parts, base.facts)
