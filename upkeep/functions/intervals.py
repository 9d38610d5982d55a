"""Date + frequency arithmetic (X-05 ... X-09), native column expressions only.

The reference builds ``(value || ' unit')::interval`` from a ``numeric(10,2)`` and adds it to a date, then casts
back to ``date``. Casting the text ``'6.00 months'`` to an interval is NULL in Spark, so the interval is never built;
the same result is computed with date functions following PostgreSQL's interval input rules:

* days:   ``v`` days; the sub-day remainder is dropped by ``::date``           -> ``date_add(d, floor(v))``
* weeks:  ``7 v`` days, same                                                  -> ``date_add(d, floor(7 v))``
* months: whole months (end-of-month clamp), fraction x 30 days                -> ``add_months`` then ``floor(30 f)`` days
* years:  whole years, fraction x 12 rounded to months                         -> ``add_months(d, 12 t + round(12 f))``

``floor`` (not truncation) because the fractional day of a negative interval moves the timestamp to the
previous calendar day before ``::date``. ``value`` stays decimal so the products are exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The frequency vocabulary of the reference (time-based ones get a due date).
TIME_FREQUENCIES = ("DAYS", "WEEKS", "MONTHS", "YEARS")
USAGE_FREQUENCIES = ("HOURS", "KM")


def _whole(value: Column) -> Column:
    # decimal -> bigint truncates toward zero
    return value.cast("bigint")


def add_days(d: Column, value: Column) -> Column:
    return F.date_add(d, F.floor(value).cast("int"))


def add_weeks(d: Column, value: Column) -> Column:
    return F.date_add(d, F.floor(value * F.lit(7)).cast("int"))


def add_months_frac(d: Column, value: Column) -> Column:
    whole = _whole(value)
    frac = value - whole
    return F.date_add(F.add_months(d, whole.cast("int")), F.floor(frac * F.lit(30)).cast("int"))


def add_years_frac(d: Column, value: Column) -> Column:
    whole = _whole(value)
    frac = value - whole
    months = whole * F.lit(12) + F.round(frac * F.lit(12), 0).cast("bigint")
    return F.add_months(d, months.cast("int"))


def add_frequency(d: Column, frequency: Column, value: Column) -> Column:
    """``(d + (value || ' ' || unit)::interval)::date`` for the four time frequencies, NULL otherwise."""
    return (
        F.when(frequency == "DAYS", add_days(d, value))
        .when(frequency == "WEEKS", add_weeks(d, value))
        .when(frequency == "MONTHS", add_months_frac(d, value))
        .when(frequency == "YEARS", add_years_frac(d, value))
    )
