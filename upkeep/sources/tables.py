"""The ten base tables as one value, and their Parquet layout at rest (R-01, W-14).

``maintenance_log`` and ``maintenance_log_detail`` are stored partitioned by ``performed_year`` (the header's
year, carried by the lines) so that date-bounded readers get partition pruning; the other tables are plain
Parquet directories. Reads always use the fixed schema (no inference).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from upkeep.operators.buckets import AT_REST
from upkeep.sources.schemas import SCHEMAS, conform

YEAR_PARTITIONED = ("maintenance_log", "maintenance_log_detail")
YEAR_COL = "performed_year"
# lookup key each large table is sorted by inside its files: Parquet min/max statistics then let a pushed-down
# equality (e.g. Query A/B for one unit) skip most row groups
SORT_WITHIN = {
    "equipment": ["id"],
    "equipment_component": ["equipment_id", "slot_label", "id"],
    "maintenance_log": [YEAR_COL, "equipment_id", "performed_on"],
    "maintenance_log_detail": [YEAR_COL, "maintenance_log_id"],
}


@dataclass(frozen=True)
class Tables:
    company: DataFrame
    farm: DataFrame
    equipment_model: DataFrame
    equipment: DataFrame
    part_type: DataFrame
    equipment_component: DataFrame
    maintenance_task: DataFrame
    maintenance_rule: DataFrame
    maintenance_log: DataFrame
    maintenance_log_detail: DataFrame

    def with_(self, **changes: DataFrame) -> Tables:
        return replace(self, **changes)

    def names(self) -> list[str]:
        return [f.name for f in fields(self)]

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in self.names()}


def _stored_schema(name: str) -> StructType:
    schema = SCHEMAS[name]
    if name in YEAR_PARTITIONED:
        return StructType(list(schema.fields) + [StructField(YEAR_COL, IntegerType(), True)])
    return schema


def write_tables(tables: Tables, root: str, log_year: DataFrame | None = None, dated_details: DataFrame | None = None) -> None:
    """Write every table under ``root/<name>``; log and detail are partitioned by the header year.

    ``log_year`` maps ``maintenance_log.id`` -> ``performed_year`` for the detail lines; when absent it is derived
    by joining the header. ``dated_details`` are the detail lines that have that year already, one per line and header.
    """
    for name, df in tables.as_dict().items():
        path = os.path.join(root, name)
        out = conform(df, SCHEMAS[name])
        if name == "maintenance_log":
            out = out.withColumn(YEAR_COL, F.year("performed_on")).sortWithinPartitions(*SORT_WITHIN[name])
            out.write.mode("overwrite").option("compression", AT_REST).partitionBy(YEAR_COL).parquet(path)
        elif name == "maintenance_log_detail" and dated_details is not None:
            out = conform(dated_details, StructType([*SCHEMAS[name].fields, StructField(YEAR_COL, IntegerType(), True)]))
            out.sortWithinPartitions(*SORT_WITHIN[name]).write.mode("overwrite").option("compression", AT_REST).partitionBy(YEAR_COL).parquet(path)
        elif name == "maintenance_log_detail":
            years = log_year if log_year is not None else tables.maintenance_log.select(
                F.col("id").alias("maintenance_log_id"), F.year("performed_on").alias(YEAR_COL)
            )
            out = out.join(years, "maintenance_log_id", "left").select(*SCHEMAS[name].fieldNames(), YEAR_COL)
            out.sortWithinPartitions(*SORT_WITHIN[name]).write.mode("overwrite").option("compression", AT_REST).partitionBy(YEAR_COL).parquet(path)
        elif name in SORT_WITHIN:
            out.sortWithinPartitions(*SORT_WITHIN[name]).write.mode("overwrite").option("compression", AT_REST).parquet(path)
        else:
            out.write.mode("overwrite").option("compression", AT_REST).parquet(path)


def read_table(spark: SparkSession, root: str, name: str, keep_year: bool = False) -> DataFrame:
    df = spark.read.schema(_stored_schema(name)).parquet(os.path.join(root, name))
    if name in YEAR_PARTITIONED and not keep_year:
        df = df.drop(YEAR_COL)
    return df


def read_tables(spark: SparkSession, root: str) -> Tables:
    return Tables(**{n: read_table(spark, root, n) for n in SCHEMAS if n != "due_soon"})
