"""Fixed schemas of the maintenance domain tables (R-01).

Column names and meanings follow the reference DDL. Deliberate widening: every id / foreign-key column is
``LongType`` (PostgreSQL ``serial`` is int4, but keys derived from 100 TB inputs exceed 2^31).
Timestamps without zone are ``TimestampNTZType``; ``computed_at`` (timestamptz in the DDL) is kept as UTC wall
time in ``TimestampNTZType`` so that results do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

METER = DecimalType(10, 2)   # numeric(10,2)
DUE_NUM = DecimalType(12, 2)  # numeric(12,2) of the snapshot


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


COMPANY = _s(("id", LongType(), False), ("name", StringType(), False), ("created_at", TimestampNTZType(), False))

FARM = _s(
    ("id", LongType(), False),
    ("name", StringType(), False),
    ("location", StringType(), True),
    ("company_id", LongType(), False),
    ("created_at", TimestampNTZType(), False),
)

EQUIPMENT_MODEL = _s(
    ("id", LongType(), False),
    ("manufacturer", StringType(), False),
    ("model_name", StringType(), False),
    ("equipment_type", StringType(), False),
    ("description", StringType(), True),
)

EQUIPMENT = _s(
    ("id", LongType(), False),
    ("display_name", StringType(), False),
    ("serial_number", StringType(), True),
    ("equipment_model_id", LongType(), False),
    ("farm_id", LongType(), False),
    ("acquired_on", DateType(), True),
    ("active", BooleanType(), False),
    ("engine_hours", METER, True),
    ("odometer_km", METER, True),
    ("created_at", TimestampNTZType(), False),
)

PART_TYPE = _s(
    ("id", LongType(), False),
    ("name", StringType(), False),
    ("category", StringType(), False),
    ("manufacturer", StringType(), True),
    ("model_code", StringType(), True),
    ("description", StringType(), True),
)

EQUIPMENT_COMPONENT = _s(
    ("id", LongType(), False),
    ("equipment_id", LongType(), False),
    ("part_type_id", LongType(), False),
    ("slot_label", StringType(), True),
    ("serial_number", StringType(), True),
    ("installed_at", TimestampNTZType(), False),
    ("removed_at", TimestampNTZType(), True),
    ("notes", StringType(), True),
)

MAINTENANCE_TASK = _s(
    ("id", LongType(), False),
    ("name", StringType(), False),
    ("description", StringType(), True),
    ("default_part_type_id", LongType(), True),
)

MAINTENANCE_RULE = _s(
    ("id", LongType(), False),
    ("task_id", LongType(), False),
    ("equipment_model_id", LongType(), True),
    ("equipment_id", LongType(), True),
    ("part_type_id", LongType(), True),
    ("frequency_type", StringType(), False),
    ("value_numeric", METER, True),
    ("interval_text", StringType(), True),
    ("pattern", StringType(), True),
    ("condition_note", StringType(), True),
    ("active", BooleanType(), False),
    ("is_default", BooleanType(), False),
)

MAINTENANCE_LOG = _s(
    ("id", LongType(), False),
    ("equipment_id", LongType(), False),
    ("task_id", LongType(), False),
    ("performed_on", DateType(), False),
    ("engine_hours", METER, True),
    ("odometer_km", METER, True),
    ("notes", StringType(), True),
    ("equipment_component_id", LongType(), True),
    ("part_type_id", LongType(), True),
    ("performed_by", StringType(), True),
)

MAINTENANCE_LOG_DETAIL = _s(
    ("id", LongType(), False),
    ("maintenance_log_id", LongType(), False),
    ("equipment_component_id", LongType(), True),
    ("action", StringType(), False),
    ("old_part_type_id", LongType(), True),
    ("new_part_type_id", LongType(), True),
    ("qty_used", METER, True),
    ("notes", StringType(), True),
)

DUE_SOON = _s(
    ("id", LongType(), False),
    ("computed_at", TimestampNTZType(), False),
    ("company_id", LongType(), True),
    ("farm_id", LongType(), True),
    ("equipment_id", LongType(), False),
    ("task_id", LongType(), False),
    ("rule_id", LongType(), False),
    ("next_due_date", DateType(), True),
    ("days_until_due", IntegerType(), True),
    ("next_due_at_hours", DUE_NUM, True),
    ("hours_remaining", DUE_NUM, True),
    ("next_due_at_km", DUE_NUM, True),
    ("km_remaining", DUE_NUM, True),
    ("severity", StringType(), True),
)

# the stage has the snapshot columns except the surrogate id
DUE_STAGE = StructType([f for f in DUE_SOON.fields if f.name != "id"])

SCHEMAS: dict[str, StructType] = {
    "company": COMPANY,
    "farm": FARM,
    "equipment_model": EQUIPMENT_MODEL,
    "equipment": EQUIPMENT,
    "part_type": PART_TYPE,
    "equipment_component": EQUIPMENT_COMPONENT,
    "maintenance_task": MAINTENANCE_TASK,
    "maintenance_rule": MAINTENANCE_RULE,
    "maintenance_log": MAINTENANCE_LOG,
    "maintenance_log_detail": MAINTENANCE_LOG_DETAIL,
    "due_soon": DUE_SOON,
}

# declared varchar(n) limits (D-14)
VARCHAR_LIMITS: dict[str, dict[str, int]] = {
    "company": {"name": 100},
    "farm": {"name": 100},
    "equipment_model": {"manufacturer": 100, "model_name": 100, "equipment_type": 50},
    "equipment": {"display_name": 100, "serial_number": 100},
    "part_type": {"name": 100, "category": 100, "manufacturer": 100, "model_code": 100},
    "equipment_component": {"slot_label": 50, "serial_number": 100},
    "maintenance_task": {"name": 100},
    "maintenance_rule": {"frequency_type": 20, "interval_text": 50, "pattern": 200},
    "maintenance_log": {"performed_by": 100},
    "maintenance_log_detail": {"action": 20},
}

# declared NOT NULL columns (D-13) are the non-nullable fields above
NOT_NULL: dict[str, list[str]] = {t: [f.name for f in s.fields if not f.nullable] for t, s in SCHEMAS.items()}


def conform(df, schema: StructType):
    """Select and cast ``df`` to ``schema`` (missing nullable columns become typed NULLs)."""
    from pyspark.sql import functions as F

    cols = []
    have = set(df.columns)
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
