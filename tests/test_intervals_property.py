"""Date + fractional interval: Spark expressions vs an independent model of PostgreSQL's interval input rules.

Model (PostgreSQL 15 interval input, then ``timestamp + interval`` and ``::date``):
  '<v> days'   -> v days             (fraction becomes hours/seconds)
  '<v> weeks'  -> 7v days
  '<v> months' -> trunc(v) months + frac * 30 days
  '<v> years'  -> 12 trunc(v) + rint(12 frac) months
timestamp + interval applies months first (end-of-month clamp), then days, then the time part; ``::date`` keeps the
calendar day of the resulting timestamp.
"""

import calendar
import datetime as dt
import random
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import functions as F

from upkeep.functions.intervals import add_frequency


def _add_months(d: dt.date, months: int) -> dt.date:
    y, m = divmod(d.year * 12 + (d.month - 1) + months, 12)
    return dt.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def _pg(d: dt.date, unit: str, v: Decimal) -> dt.date:
    whole = int(v)  # truncation toward zero
    frac = v - whole
    months, days = 0, Decimal(0)
    if unit == "DAYS":
        days = v
    elif unit == "WEEKS":
        days = v * 7
    elif unit == "MONTHS":
        months, days = whole, frac * 30
    else:
        months = whole * 12 + int((frac * 12).quantize(Decimal(1), rounding=ROUND_HALF_EVEN))
    start = dt.datetime.combine(_add_months(d, months), dt.time())
    seconds = int((days * 86400).to_integral_value())
    return (start + dt.timedelta(seconds=seconds)).date()


def test_random_dates_and_values_match_the_model(spark):
    rng = random.Random(2026)
    cases = []
    for _ in range(2000):
        d = dt.date(1990, 1, 1) + dt.timedelta(days=rng.randint(0, 40 * 365))
        v = Decimal(rng.randint(-9999, 9999)) / Decimal(100)
        unit = rng.choice(["DAYS", "WEEKS", "MONTHS", "YEARS"])
        cases.append((d, unit, v))
    # month-end bases are where the clamp matters
    for d in (dt.date(2024, 1, 31), dt.date(2023, 2, 28), dt.date(2024, 2, 29), dt.date(2025, 12, 31)):
        for v in ("0.50", "1.00", "1.99", "-0.01", "-1.50", "11.50", "0.04"):
            for unit in ("DAYS", "WEEKS", "MONTHS", "YEARS"):
                cases.append((d, unit, Decimal(v)))
    df = spark.createDataFrame(cases, "d date, unit string, v decimal(10,2)")
    got = df.select("d", "unit", "v", add_frequency(F.col("d"), F.col("unit"), F.col("v")).alias("n")).collect()
    bad = [(r.d, r.unit, r.v, r.n, _pg(r.d, r.unit, r.v)) for r in got if r.n != _pg(r.d, r.unit, r.v)]
    assert not bad, bad[:5]
