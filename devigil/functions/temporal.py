"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column) -> Column:
    """``YYYYMMDD`` or ``YYYY-MM-DD`` (a time part is ignored); anything else is NULL."""
    value = F.trim(c.cast("string"))
    return F.when(value.rlike(r"^\d{8}$"), F.try_to_date(value, "yyyyMMdd")).when(
        value.rlike(r"^\d{4}-\d{2}-\d{2}([ T].*)?$"),
        F.try_to_date(F.substring(value, 1, 10), "yyyy-MM-dd"),
    )


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "month")


def trailing_days(c: Column, reference: Column, days: int = 30) -> Column:
    return c.cast("date") >= F.date_sub(reference, days)


def within_last_year(c: Column, as_of: Column) -> Column:
    return c.cast("date") >= F.add_months(as_of, -12)
