"""DuckDB SQL oracles for the registered queries.

Each oracle is one SQL statement over the driver's raw views (region, nation, customer, part, orders, lineitem).
It first derives the domain tables (``a_*`` CTEs: the adapter written independently in SQL), then states the
results declaratively (a rule is chosen when no better one exists, one pass over all kinds of frequency) rather than
mirroring the Spark plan, so a plan mistake shows up as a mismatch.
"""

from __future__ import annotations

import datetime as dt

from upkeep.sources import testdata as td

# ---------------------------------------------------------------------------------------------------------------
# adapter


def _values(rows: list[tuple]) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)


def adapter_ctes() -> str:
    models = _values([(i + 1, s) for i, s in enumerate(td.SEGMENTS)])
    tasks = _values([(i + 1, p) for i, p in enumerate(td.PRIORITIES)])
    cycle = _values([(k, f, v) for k, (f, v) in enumerate(td.RULE_CYCLE)])
    created = f"TIMESTAMP '{td.CREATED_AT}'"
    order = ", ".join(td.COMPONENT_ORDER)
    flags = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in td.RETURNFLAG_ACTION.items())
    return f"""
a_company AS (SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, {created} AS created_at FROM region),
a_farm AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(NULL AS VARCHAR) AS location,
                  CAST(n_regionkey AS BIGINT) AS company_id, {created} AS created_at FROM nation),
a_model AS (SELECT CAST(id AS BIGINT) AS id, 'TPC' AS manufacturer, model_name, model_name AS equipment_type,
                   CAST(NULL AS VARCHAR) AS description
            FROM (VALUES {models}) v(id, model_name)),
a_task AS (SELECT CAST(id AS BIGINT) AS id, name, CAST(NULL AS VARCHAR) AS description,
                  CAST(NULL AS BIGINT) AS default_part_type_id FROM (VALUES {tasks}) v(id, name)),
a_meter AS (SELECT o_custkey, MAX(CAST(o_totalprice AS DECIMAL(10,2))) AS mx FROM orders GROUP BY o_custkey),
a_equipment AS (
  SELECT c.c_custkey AS id, c.c_name AS display_name, CAST(NULL AS VARCHAR) AS serial_number,
         m.id AS equipment_model_id, CAST(NULL AS DATE) AS acquired_on,
         CAST(c.c_nationkey AS BIGINT) AS farm_id, TRUE AS active,
         CASE WHEN m.id <> {td.NO_HOURS_MODEL} THEN mt.mx END AS engine_hours,
         CASE WHEN m.id <> {td.NO_KM_MODEL} THEN mt.mx END AS odometer_km,
         {created} AS created_at
  FROM customer c JOIN a_model m ON m.model_name = c.c_mktsegment
  LEFT JOIN a_meter mt ON mt.o_custkey = c.c_custkey),
a_part AS (SELECT p_partkey AS id, p_name AS name, p_type AS category, p_brand AS manufacturer,
                  CAST(NULL AS VARCHAR) AS model_code, CAST(NULL AS VARCHAR) AS description FROM part),
a_li AS (
  SELECT l.*, o.o_custkey, row_number() OVER (ORDER BY {order}) AS cid
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
a_component_raw AS (
  SELECT cid AS id, o_custkey AS equipment_id, l_partkey AS part_type_id, CAST(l_linenumber AS VARCHAR) AS slot_label,
         CAST(NULL AS VARCHAR) AS serial_number, l_shipdate AS installed_at, CAST(NULL AS TIMESTAMP) AS removed_at,
         CAST(NULL AS VARCHAR) AS notes
  FROM a_li),
a_component AS (
  SELECT id, equipment_id, part_type_id, slot_label, serial_number, installed_at,
         LEAD(installed_at) OVER (PARTITION BY equipment_id, slot_label ORDER BY id) AS removed_at, notes
  FROM a_component_raw),
a_single AS (SELECT l_orderkey, MIN(cid) AS cid, MIN(l_partkey) AS pk FROM a_li GROUP BY l_orderkey HAVING COUNT(*) = 1),
a_log AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS equipment_id, t.id AS task_id, CAST(o.o_orderdate AS DATE) AS performed_on,
         CAST(o.o_totalprice AS DECIMAL(10,2)) AS engine_hours,
         CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS DECIMAL(10,2)) END AS odometer_km,
         CAST(NULL AS VARCHAR) AS notes, s.cid AS equipment_component_id, s.pk AS part_type_id,
         CAST(NULL AS VARCHAR) AS performed_by
  FROM orders o JOIN a_task t ON t.name = o.o_orderpriority LEFT JOIN a_single s ON s.l_orderkey = o.o_orderkey),
a_detail AS (
  SELECT cid AS id, l_orderkey AS maintenance_log_id, cid AS equipment_component_id,
         CASE l_returnflag {flags} ELSE 'INSPECT' END AS action,
         CAST(NULL AS BIGINT) AS old_part_type_id, l_partkey AS new_part_type_id,
         CAST(l_quantity AS DECIMAL(10,2)) AS qty_used, CAST(NULL AS VARCHAR) AS notes
  FROM a_li),
a_cycle AS (SELECT * FROM (VALUES {cycle}) v(k, frequency_type, value)),
a_rule AS (
  SELECT 100 + 10 * m.id + t.id AS id, t.id AS task_id, m.id AS equipment_model_id, CAST(NULL AS BIGINT) AS equipment_id,
         CAST(NULL AS BIGINT) AS part_type_id, cy.frequency_type, CAST(cy.value AS DECIMAL(10,2)) AS value_numeric,
         CAST(NULL AS VARCHAR) AS interval_text, CAST(NULL AS VARCHAR) AS pattern, CAST(NULL AS VARCHAR) AS condition_note,
         TRUE AS active, TRUE AS is_default
  FROM a_model m JOIN a_task t ON TRUE JOIN a_cycle cy ON cy.k = (m.id + t.id) % {len(td.RULE_CYCLE)}
  UNION ALL
  SELECT 1000 + 2 * c.c_custkey, m.id, NULL, c.c_custkey, NULL,
         '{td.EQUIPMENT_RULE[0]}', CAST({td.EQUIPMENT_RULE[1]} AS DECIMAL(10,2)), NULL, NULL, NULL, TRUE, FALSE
  FROM customer c JOIN a_model m ON m.model_name = c.c_mktsegment
  WHERE c.c_acctbal < 0
  UNION ALL
  SELECT 1001 + 2 * p_partkey, 1 + p_size, NULL, NULL, p_partkey,
         '{td.PART_RULE[0]}', CAST({td.PART_RULE[1]} AS DECIMAL(10,2)), NULL, NULL, NULL, TRUE, FALSE
  FROM part WHERE p_size <= {td.SMALL_PART_SIZE})"""


# ---------------------------------------------------------------------------------------------------------------
# the procedure's CTEs (one set per refresh date, names suffixed)


def add_frequency_sql(base: str, freq: str, v: str) -> str:
    whole = f"trunc({v})"
    frac = f"({v} - trunc({v}))"
    return f"""CASE {freq}
        WHEN 'DAYS' THEN {base} + CAST(floor({v}) AS INTEGER)
        WHEN 'WEEKS' THEN {base} + CAST(floor({v} * 7) AS INTEGER)
        WHEN 'MONTHS' THEN CAST({base} + to_months(CAST({whole} AS INTEGER)) AS DATE) + CAST(floor({frac} * 30) AS INTEGER)
        WHEN 'YEARS' THEN CAST({base} + to_months(CAST({whole} * 12 + round({frac} * 12) AS INTEGER)) AS DATE)
      END"""


# frequency -> what it counts (fixed values)
_KINDS = [("DAYS", "date"), ("WEEKS", "date"), ("MONTHS", "date"), ("YEARS", "date"), ("HOURS", "hours"), ("KM", "km")]


def procedure_ctes(
    sfx: str,
    as_of: dt.date,
    computed_at: dt.datetime,
    days: int | None = td.DAYS_AHEAD,
    hours=td.HOURS_AHEAD,
    km=td.KM_AHEAD,
    log: str = "a_log",
) -> str:
    """Due items stated by what holds for them, in one pass over all kinds of frequency.

    A rule's level is its narrowest scope; it fits a unit if that scope names it; it is chosen if no rule of the same
    unit, task and frequency has a smaller (level, id). ``slack`` is what is left, in days, hours or km; ``room`` the
    threshold of the kind.
    """
    today = f"DATE '{as_of.isoformat()}'"
    room = _values([("date", "NULL" if days is None else days), ("hours", 25 if hours is None else hours), ("km", 500 if km is None else km)])
    room = room.replace("'NULL'", "NULL")
    date = add_frequency_sql("since", "frequency_type", "value_numeric")
    return f"""
last_log{sfx} AS (
  SELECT equipment_id, task_id, max(performed_on) AS last_date, max(engine_hours) AS last_hours, max(odometer_km) AS last_km
  FROM {log} GROUP BY ALL),
base{sfx} AS (
  SELECT u.id AS equipment_id, u.farm_id, (SELECT company_id FROM a_farm WHERE id = u.farm_id) AS company_id,
         u.created_at::DATE AS equip_created, u.engine_hours, u.odometer_km
  FROM a_equipment u WHERE u.farm_id IN (SELECT id FROM a_farm)),
kinds{sfx} AS (SELECT * FROM (VALUES {_values(_KINDS)}) v(frequency_type, kind)),
rooms{sfx} AS (SELECT kind, room::DECIMAL(12,2) AS room FROM (VALUES {room}) v(kind, room)),
levelled{sfx} AS (
  SELECT id AS rule_id, task_id, frequency_type, value_numeric, interval_text, pattern, condition_note,
         CASE WHEN equipment_id IS NOT NULL THEN 1 WHEN equipment_model_id IS NOT NULL THEN 2 ELSE 3 END AS precedence,
         coalesce(equipment_id, equipment_model_id, part_type_id) AS target
  FROM a_rule WHERE active),
targets{sfx} AS (
  SELECT id AS equipment_id, 1 AS precedence, id AS target FROM a_equipment
  UNION SELECT id, 2, equipment_model_id FROM a_equipment
  UNION SELECT equipment_id, 3, part_type_id FROM a_component WHERE removed_at IS NULL),
equipment_rules{sfx} AS (SELECT * EXCLUDE (target) FROM targets{sfx} JOIN levelled{sfx} USING (precedence, target)),
picked_rules{sfx} AS (
  SELECT * FROM equipment_rules{sfx} mine
  WHERE NOT EXISTS (
    SELECT 1 FROM equipment_rules{sfx} other
    WHERE other.equipment_id = mine.equipment_id AND other.task_id = mine.task_id
      AND other.frequency_type = mine.frequency_type
      AND (other.precedence, other.rule_id) < (mine.precedence, mine.rule_id))),
measured{sfx} AS (
  SELECT equipment_id, task_id, rule_id, farm_id, company_id, frequency_type, kind, value_numeric,
         coalesce(last_date, equip_created) AS since,
         CASE kind WHEN 'hours' THEN engine_hours WHEN 'km' THEN odometer_km END AS meter,
         coalesce(CASE kind WHEN 'hours' THEN last_hours WHEN 'km' THEN last_km END, 0) AS seen
  FROM picked_rules{sfx} JOIN kinds{sfx} USING (frequency_type) JOIN base{sfx} USING (equipment_id)
  LEFT JOIN last_log{sfx} USING (equipment_id, task_id)),
due{sfx} AS (
  SELECT *, CASE WHEN kind = 'date' THEN {date} END AS at_date,
         CASE WHEN meter IS NOT NULL THEN seen + value_numeric END AS at_meter,
         CASE WHEN meter IS NOT NULL AND value_numeric IS NOT NULL THEN greatest(seen + value_numeric - meter, 0) END AS left_over
  FROM measured{sfx}),
time_due{sfx} AS (SELECT equipment_id, rule_id, task_id, at_date AS next_due_date FROM due{sfx} WHERE kind = 'date'),
hours_due{sfx} AS (
  SELECT equipment_id, rule_id, task_id, at_meter AS next_due_at_hours, left_over AS hours_remaining FROM due{sfx} WHERE kind = 'hours'),
km_due{sfx} AS (
  SELECT equipment_id, rule_id, task_id, at_meter AS next_due_at_km, left_over AS km_remaining FROM due{sfx} WHERE kind = 'km'),
slack{sfx} AS (
  SELECT *, CASE kind WHEN 'date' THEN date_diff('day', {today}, at_date) ELSE left_over END AS slack
  FROM due{sfx} JOIN rooms{sfx} USING (kind)),
stage{sfx} AS (
  SELECT TIMESTAMP '{computed_at.isoformat(sep=" ")}' AS computed_at, company_id, farm_id, equipment_id, task_id, rule_id,
         at_date AS next_due_date, CASE kind WHEN 'date' THEN slack::INTEGER END AS days_until_due,
         (CASE kind WHEN 'hours' THEN at_meter END)::DECIMAL(12,2) AS next_due_at_hours,
         (CASE kind WHEN 'hours' THEN left_over END)::DECIMAL(12,2) AS hours_remaining,
         (CASE kind WHEN 'km' THEN at_meter END)::DECIMAL(12,2) AS next_due_at_km,
         (CASE kind WHEN 'km' THEN left_over END)::DECIMAL(12,2) AS km_remaining,
         if(slack < 0 OR (slack = 0 AND kind <> 'date'), 'OVERDUE', 'DUE_SOON') AS severity
  FROM slack{sfx} WHERE slack <= room OR (slack = 0 AND kind <> 'date'))"""


def place_cte() -> str:
    """Where each unit stands now."""
    return """place AS (
  SELECT u.id AS equipment_id, u.display_name AS equipment, f.name AS farm, (SELECT name FROM a_company WHERE id = f.company_id) AS company
  FROM a_equipment u SEMI JOIN a_farm ON a_farm.id = u.farm_id, LATERAL (SELECT name, company_id FROM a_farm WHERE id = u.farm_id) f)"""


def snapshot_ctes(purge: bool) -> str:
    """old = first refresh 60 days earlier (ids 1..n in key order); new = upsert of today's stage."""
    cols = ("computed_at, company_id, farm_id, equipment_id, task_id, rule_id, next_due_date, days_until_due, "
            "next_due_at_hours, hours_remaining, next_due_at_km, km_remaining, severity")
    pick = ", ".join(f"CASE WHEN s.equipment_id IS NOT NULL THEN s.{c} ELSE o.{c} END AS {c}" for c in cols.split(", "))
    keep = "" if not purge else "WHERE s.equipment_id IS NOT NULL"
    return f"""
snap_old AS (SELECT row_number() OVER (ORDER BY equipment_id, task_id, rule_id) AS id, {cols} FROM stage_old),
snap_j AS (
  SELECT o.id AS old_id, s.equipment_id IS NOT NULL AS in_stage, {pick}
  FROM stage_new s FULL JOIN snap_old o
    ON s.equipment_id = o.equipment_id AND s.task_id = o.task_id AND s.rule_id = o.rule_id
  {keep}),
snap_new AS (
  SELECT CAST(CASE WHEN in_stage AND old_id IS NULL
           THEN (SELECT COALESCE(MAX(id), 0) FROM snap_old)
                + row_number() OVER (PARTITION BY (in_stage AND old_id IS NULL) ORDER BY equipment_id, task_id, rule_id)
           ELSE old_id END AS BIGINT) AS id, {cols}
  FROM snap_j)"""


def with_(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks)
