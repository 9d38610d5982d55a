"""The reference's seed scenario as in-memory tables at a pinned date (R-04 constant rows, test fixture only).

Every relative date of the seed (``current_date - INTERVAL ...``, ``now() - INTERVAL ...``) is resolved against
``as_of`` / ``now``; ids are those an empty database assigns. ``auto_detail`` chooses whether the optional log
trigger is installed: with it, inserting log 2 creates an INSPECT line and the seed's own REPLACE line is skipped
by its NOT EXISTS guard; without it, the REPLACE line is stored.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from upkeep.operators.history import AUTO_DETAIL_ACTION, AUTO_DETAIL_NOTE
from upkeep.sources.schemas import SCHEMAS
from upkeep.sources.tables import Tables


def _months_back(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.year * 12 + d.month - 1 - n, 12)
    m += 1
    last = (dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(y, m, min(d.day, last))


def _ts_months_back(ts: dt.datetime, n: int) -> dt.datetime:
    return dt.datetime.combine(_months_back(ts.date(), n), ts.time())


def seed_tables(
    spark: SparkSession, as_of: dt.date, now: dt.datetime | None = None, auto_detail: bool = True
) -> Tables:
    now = now or dt.datetime.combine(as_of, dt.time(9, 0))
    days = dt.timedelta
    D = Decimal

    # The seed rows of the reference (names, codes, meters, offsets).
    company = [(1, "Acme Farms", now), (2, "GreenFields Co.", now)]
    farm = [(1, "North Farm", "Iowa", 1, now), (2, "South Farm", "Nebraska", 1, now), (3, "Valley Farm", "Kansas", 2, now)]
    model = [
        (1, "John Deere", "6110", "Tractor", "Mid-size tractor"),
        (2, "Case IH", "Axial-Flow 8250", "Combine", "High capacity combine"),
        (3, "Ford", "F-250", "Truck", "Farm pickup"),
    ]
    part = [
        (1, "Oil Filter Type A", "Oil Filter", "FleetGuard", "OF-A", "Standard oil filter"),
        (2, "Oil Filter Type B", "Oil Filter", "FleetGuard", "OF-B", "Higher performance oil filter"),
        (3, "Hydraulic Filter H100", "Hydraulic Filter", "Parker", "HF-100", "Hydraulic system filter"),
        (4, 'Front Tire 18"', "Tire", "Firestone", "FT18", "Front tire 18 inch"),
        (5, "Engine Oil 15W-40", "Oil", "Shell", "ROTELLA-1540", "Engine oil"),
    ]
    equipment = [
        (1, "Tractor T-100", "JD6110-0001", 1, 1, as_of - days(400), True, D("495"), None, now - days(400)),
        (2, "Combine C-200", "CASE8250-0009", 2, 1, as_of - days(300), True, D("520"), None, now - days(300)),
        (3, "Truck TR-9", "F250-77TR9", 3, 2, as_of - days(500), True, None, D("148500"), now - days(500)),
    ]
    component = [
        (1, 1, 2, "FILTER_OIL", "OF-B-TRAC-001", now - days(240), None, "Upgraded filter"),
        (2, 1, 4, "FRONT-LEFT", "TIRE18-FL-001", _ts_months_back(now, 7), None, None),
        (3, 1, 4, "FRONT-RIGHT", "TIRE18-FR-001", _ts_months_back(now, 7), None, None),
        (4, 2, 3, "FILTER_HYD", "HF-100-COMB-01", now - days(200), None, None),
        (5, 3, 4, "FRONT-LEFT", "TIRE18-FL-TR9", _ts_months_back(now, 5), None, None),
    ]
    task = [
        (1, "Change Engine Oil", "Replace engine oil", 5),
        (2, "Replace Oil Filter", "Replace engine oil filter", 1),
        (3, "Grease Fittings", "Lubricate grease points", None),
        (4, "Inspect Tires", "Check wear & pressure", None),
        (5, "Replace Hydraulic Filter", "Replace hydraulic filter", None),
    ]
    rule = [
        (1, 1, 1, None, None, "HOURS", D("250"), None, None, "Every 250 engine hours", True, True),
        (2, 2, 1, None, None, "HOURS", D("200"), None, None, "Every 200 engine hours", True, True),
        (3, 5, 2, None, None, "HOURS", D("500"), None, None, "Every 500 engine hours", True, True),
        (4, 4, None, None, 4, "MONTHS", D("6"), None, None, "Every 6 months while tire is installed", True, True),
        (5, 1, 3, None, None, "KM", D("10000"), None, None, "Every 10,000 km", True, True),
    ]
    log = [
        (1, 1, 1, as_of - days(200), D("260"), None, "Oil changed using 15W-40", None, 5, None),
        (2, 1, 2, as_of - days(150), D("300"), None, "Oil filter replaced (Type B)", 1, 2, None),
        (3, 3, 4, _months_back(as_of, 5), None, D("148500"), "Routine tire inspection", None, None, None),
        (4, 2, 5, as_of - days(250), D("100"), None, "Initial hydraulic filter replacement", None, None, None),
    ]
    if auto_detail:
        detail = [(1, 2, 1, AUTO_DETAIL_ACTION, None, None, None, AUTO_DETAIL_NOTE)]
    else:
        detail = [(1, 2, 1, "REPLACE", 1, 2, D("1"), "Upgraded to Type B")]

    def df(name, rows):
        return spark.createDataFrame(rows, SCHEMAS[name])

    return Tables(
        company=df("company", company),
        farm=df("farm", farm),
        equipment_model=df("equipment_model", model),
        equipment=df("equipment", equipment),
        part_type=df("part_type", part),
        equipment_component=df("equipment_component", component),
        maintenance_task=df("maintenance_task", task),
        maintenance_rule=df("maintenance_rule", rule),
        maintenance_log=df("maintenance_log", log),
        maintenance_log_detail=df("maintenance_log_detail", detail),
    )
