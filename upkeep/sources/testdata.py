"""Adapter: the driver's TPC-H-like tables -> the ten maintenance tables.

| domain            | from                                                                            |
|-------------------|---------------------------------------------------------------------------------|
| company           | region                                                                          |
| farm              | nation (company = region)                                                       |
| equipment_model   | the five market segments                                                        |
| equipment         | customer; meters = max logged ``o_totalprice`` (hours NULL for MACHINERY,       |
|                   | km NULL for FURNITURE)                                                          |
| part_type         | part                                                                            |
| maintenance_task  | the five order priorities                                                       |
| maintenance_log   | orders (task by priority, hours = price, km = price when status F, component    |
|                   | named when the order has exactly one line)                                      |
| equipment_component | lineitem x orders, slot = line number, arrival id = order of 7 line columns,  |
|                   | ``removed_at`` by the slot-closing trigger                                     |
| maintenance_log_detail | lineitem (action by return flag)                                           |
| maintenance_rule  | model x task cycle; an individual MONTHS rule for units whose account is in     |
|                   | arrears (negative balance); a global DAYS rule for small parts (size <= 2)      |

Everything is a Spark job over the whole input; the result is written once as Parquet into the shared folder
and read back with fixed schemas, like production tables at rest.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upkeep.operators import versions
from upkeep.operators.history import close_previous
from upkeep.operators.ids import with_offsets
from upkeep.session import shared_path
from upkeep.sources.schemas import (
    EQUIPMENT_MODEL,
    MAINTENANCE_TASK,
    METER,
    conform,
    SCHEMAS,
)
from upkeep.sources.tables import YEAR_COL, Tables, read_tables, write_tables

ADAPTER_VERSION = "6"

# ---------------------------------------------------------------------------------------------------------------
# Fixed values of the adapter (they define the test scenario and must match the DuckDB oracle text).
CREATED_AT = "1995-01-01 00:00:00"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # equipment_model ids 1..5
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]  # maintenance_task ids 1..5
NO_HOURS_MODEL = 5  # MACHINERY units have no engine-hour meter
NO_KM_MODEL = 3  # FURNITURE units have no odometer
RULE_CYCLE = [("DAYS", 900), ("WEEKS", 100), ("MONTHS", 18), ("YEARS", 2), ("HOURS", 50000), ("KM", 100000)]
EQUIPMENT_RULE = ("MONTHS", 24)  # individual rule for units whose account balance is negative; task = model id
SMALL_PART_SIZE, PART_RULE = 2, ("DAYS", 700)  # global rule for parts of size <= 2; task = 1 + size
RETURNFLAG_ACTION = {"R": "REPLACE", "A": "REPAIR", "N": "INSPECT"}
COMPONENT_ORDER = [
    "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
]
# Scenario parameters of the refresh on this data.
AS_OF = dt.date(2001, 8, 1)
COMPUTED_AT = dt.datetime(2001, 8, 1, 2, 5, 0)
DAYS_AHEAD, HOURS_AHEAD, KM_AHEAD = 30, 25000, 25000
# ---------------------------------------------------------------------------------------------------------------


def model_rule_id(model: F.Column, task: F.Column) -> F.Column:
    return F.lit(100) + F.lit(10) * model + task


def equipment_rule_id(equipment: F.Column) -> F.Column:
    return F.lit(1000) + F.lit(2) * equipment


def part_rule_id(part: F.Column) -> F.Column:
    return F.lit(1001) + F.lit(2) * part


def _created() -> F.Column:
    return F.lit(CREATED_AT).cast("timestamp_ntz")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _numbered_lines(lineitem: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines of known orders with their ``rank`` inside the order, and per order key the lines ``before`` it, its number ``n``
    of lines and smallest part: ``before + rank`` is a line's number in ``COMPONENT_ORDER``.

    Lines are dealt once, by order key, and kept until ``unpersist``; only a narrow row per order is sorted by key. Each line
    carries the ``year`` of its order's log, or ``more_years`` where the key repeats, so detail lines need no join for it.
    """
    n = int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    logged = F.col("o_orderpriority").isin(PRIORITIES)
    dated = orders.where(F.col("o_orderkey").isNotNull()).select(
        "o_orderkey", "o_custkey", F.when(logged, F.struct(F.year("o_orderdate").alias("year"))).alias("log")
    )
    years = F.transform(F.collect_list("log").over(Window.partitionBy("o_orderkey")), lambda x: x["year"])
    dated = dated.repartition(n, "o_orderkey").withColumn("years", years).select(
        "o_orderkey",
        "o_custkey",
        F.when(F.size("years") == 1, F.col("years")[0]).alias("year"),
        F.when(F.size("years") > 1, F.col("years")).alias("more_years"),
    )
    dealt = lineitem.where(F.col("l_orderkey").isNotNull()).select(*COMPONENT_ORDER, "l_returnflag").repartition(n, "l_orderkey")
    # lines alike in all of COMPONENT_ORDER go by their other columns, so that ids are the same whenever this is computed
    inside = Window.partitionBy("l_orderkey").orderBy(*COMPONENT_ORDER[1:], "l_returnflag", "o_custkey")
    lines = (
        dealt.join(dated, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("rank", F.row_number().over(inside))
        .select("l_orderkey", "rank", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity", "l_returnflag", "o_custkey", "year", "more_years")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("pk"))
    starts = with_offsets(per_order, "l_orderkey", "n", "before").repartition(n, "l_orderkey").persist(StorageLevel.MEMORY_AND_DISK)
    return lines, starts


def build_tables(spark: SparkSession, sf_dir: str) -> tuple[Tables, DataFrame, list[DataFrame]]:
    """The tables, the detail lines with the year of their log, and the frames to unpersist once both are written."""
    region = _read(spark, sf_dir, "region")
    nation = _read(spark, sf_dir, "nation")
    customer = _read(spark, sf_dir, "customer")
    part = _read(spark, sf_dir, "part")
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem")

    company = region.select(
        F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"), _created().alias("created_at")
    )
    farm = nation.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("bigint").alias("company_id"),
        _created().alias("created_at"),
    )
    models = spark.createDataFrame(
        [(i + 1, "TPC", seg, seg, None) for i, seg in enumerate(SEGMENTS)], EQUIPMENT_MODEL
    )
    tasks = spark.createDataFrame([(i + 1, p, None, None) for i, p in enumerate(PRIORITIES)], MAINTENANCE_TASK)

    price = F.col("o_totalprice").cast(METER)
    meter = orders.groupBy("o_custkey").agg(F.max(price).alias("mx"))
    seg_model = models.select(F.col("id").alias("equipment_model_id"), F.col("model_name"))
    equipment = (
        customer.join(seg_model, customer.c_mktsegment == seg_model.model_name)
        .join(meter, customer.c_custkey == meter.o_custkey, "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("display_name"),
            "equipment_model_id",
            F.col("c_nationkey").cast("bigint").alias("farm_id"),
            F.lit(True).alias("active"),
            F.when(F.col("equipment_model_id") != NO_HOURS_MODEL, F.col("mx")).alias("engine_hours"),
            F.when(F.col("equipment_model_id") != NO_KM_MODEL, F.col("mx")).alias("odometer_km"),
            _created().alias("created_at"),
        )
    )
    part_type = part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("manufacturer"),
    )

    kept, starts = _numbered_lines(lineitem, orders)
    lines = kept.join(starts.select("l_orderkey", "before"), "l_orderkey").withColumn("cid", F.col("before") + F.col("rank"))
    components = close_previous(
        conform(
            lines.select(
                F.col("cid").alias("id"),
                F.col("o_custkey").alias("equipment_id"),
                F.col("l_partkey").alias("part_type_id"),
                F.col("l_linenumber").cast("string").alias("slot_label"),
                F.col("l_shipdate").alias("installed_at"),
            ),
            SCHEMAS["equipment_component"],
        )
    )
    action = F.lit(None).cast("string")
    for flag, name in RETURNFLAG_ACTION.items():
        action = F.when(F.col("l_returnflag") == flag, name).otherwise(action)
    # a line per log of its order: one but where order keys repeat
    dated = F.when(F.col("more_years").isNull(), F.array(F.col("year"))).otherwise(F.col("more_years"))
    details = lines.withColumn(YEAR_COL, F.explode(dated)).select(
        F.col("cid").alias("id"),
        F.col("l_orderkey").alias("maintenance_log_id"),
        F.col("cid").alias("equipment_component_id"),
        F.coalesce(action, F.lit("INSPECT")).alias("action"),
        F.col("l_partkey").alias("new_part_type_id"),
        F.col("l_quantity").cast(METER).alias("qty_used"),
        YEAR_COL,
    )
    single = starts.where(F.col("n") == 1).select("l_orderkey", (F.col("before") + F.lit(1)).alias("cid"), "pk")
    task_by_name = tasks.select(F.col("id").alias("task_id"), F.col("name").alias("priority"))
    logs = (
        orders.join(F.broadcast(task_by_name), orders.o_orderpriority == task_by_name.priority)
        .join(single, orders.o_orderkey == single.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("equipment_id"),
            "task_id",
            F.col("o_orderdate").cast("date").alias("performed_on"),
            price.alias("engine_hours"),
            F.when(F.col("o_orderstatus") == "F", price).alias("odometer_km"),
            F.col("cid").alias("equipment_component_id"),
            F.col("pk").alias("part_type_id"),
        )
    )

    cycle_freq = F.element_at(F.array(*[F.lit(f) for f, _ in RULE_CYCLE]), F.col("k") + 1)
    cycle_val = F.element_at(F.array(*[F.lit(v) for _, v in RULE_CYCLE]), F.col("k") + 1)
    model_rules = (
        models.select(F.col("id").alias("equipment_model_id"), F.explode(F.sequence(F.lit(1), F.lit(len(PRIORITIES)))).alias("task_id"))
        .withColumn("k", ((F.col("equipment_model_id") + F.col("task_id")) % len(RULE_CYCLE)).cast("int"))
        .select(
            model_rule_id(F.col("equipment_model_id"), F.col("task_id")).alias("id"),
            F.col("task_id").cast("bigint").alias("task_id"),
            "equipment_model_id",
            cycle_freq.alias("frequency_type"),
            cycle_val.cast(METER).alias("value_numeric"),
            F.lit(True).alias("active"),
            F.lit(True).alias("is_default"),
        )
    )
    equipment_rules = (
        customer.where(F.col("c_acctbal") < 0).join(seg_model, customer.c_mktsegment == seg_model.model_name)
    ).select(
        equipment_rule_id(F.col("c_custkey")).alias("id"),
        F.col("equipment_model_id").alias("task_id"),
        F.col("c_custkey").alias("equipment_id"),
        F.lit(EQUIPMENT_RULE[0]).alias("frequency_type"),
        F.lit(EQUIPMENT_RULE[1]).cast(METER).alias("value_numeric"),
        F.lit(True).alias("active"),
        F.lit(False).alias("is_default"),
    )
    part_rules = part.where(F.col("p_size") <= SMALL_PART_SIZE).select(
        part_rule_id(F.col("p_partkey")).alias("id"),
        (F.lit(1) + F.col("p_size")).alias("task_id"),
        F.col("p_partkey").alias("part_type_id"),
        F.lit(PART_RULE[0]).alias("frequency_type"),
        F.lit(PART_RULE[1]).cast(METER).alias("value_numeric"),
        F.lit(True).alias("active"),
        F.lit(False).alias("is_default"),
    )
    rules = model_rules.unionByName(equipment_rules, allowMissingColumns=True).unionByName(
        part_rules, allowMissingColumns=True
    )

    frames = dict(
        company=company, farm=farm, equipment_model=models, equipment=equipment, part_type=part_type,
        equipment_component=components, maintenance_task=tasks, maintenance_rule=rules,
        maintenance_log=logs, maintenance_log_detail=details,
    )
    return Tables(**{n: conform(df, SCHEMAS[n]) for n, df in frames.items()}), details, [kept, starts]


def _listing(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input files: changed input under the same path is read again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, folders = [], [path]
    while folders:
        for s in fs.listStatus(folders.pop()):
            if s.isDirectory():
                folders.append(s.getPath())
            else:
                found.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
    return "\n".join(sorted(found))


def domain_root(spark: SparkSession, sf_dir: str) -> str:
    tag = hashlib.sha1(_listing(spark, sf_dir).encode()).hexdigest()[:12]
    return shared_path(spark, "domain", f"v{ADAPTER_VERSION}", os.path.basename(os.path.normpath(sf_dir)) + "-" + tag)


def materialize(spark: SparkSession, sf_dir: str) -> str:
    """Write the adapted tables once per (shared folder, state of the input) and return their root.

    Each attempt builds into a folder of its own and then commits it (``operators.versions``), so two applications never
    write into the same files and readers only ever see a complete folder.
    """
    base = domain_root(spark, sf_dir)
    version = versions.current(spark, base)
    if not version.number:
        root = versions.new_folder(base)
        tables, dated_details, kept = build_tables(spark, sf_dir)
        write_tables(tables, root, dated_details=dated_details)
        for frame in kept:
            frame.unpersist()
        try:
            version = versions.commit(spark, base, 0, {"tables": root})
        except versions.Conflict:  # another application was first with the same input
            version = versions.current(spark, base)
    return version.parts["tables"]


_LOADED: dict[tuple[str, str], Tables] = {}


def load(spark: SparkSession, sf_dir: str) -> Tables:
    """The domain tables for ``sf_dir`` (materialized on first use), read with fixed schemas.

    The returned DataFrames are immutable plan definitions, so one ``Tables`` value is reused per application
    (file listing and schema resolution happen once).
    """
    root = materialize(spark, sf_dir)
    key = (spark.sparkContext.applicationId, root)
    if key not in _LOADED:
        _LOADED[key] = read_tables(spark, root)
    return _LOADED[key]
