"""Fiscal and calendar dates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_end(year: Column, months: Column, fiscal_month: int = 12) -> Column:
    """Month end of the cumulative period; exact for December year-ends."""
    m = F.pmod(months + F.lit(fiscal_month - 13), F.lit(12)) + 1
    y = year if fiscal_month == 12 else year + F.when(m <= fiscal_month, 0).otherwise(-1)
    return F.last_day(F.make_date(y, m, F.lit(1)))


def compact_date(c: Column) -> Column:
    return F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd")


def settlement_date(c: Column, reported: Column) -> Column:
    """Year, month and maybe day in free text; a missing or impossible day is the month's last; nothing usable: the end of the year before the report."""
    y, m, d = (F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d{4})\D+(\d{1,2})(?:\D+(\d{1,2}))?", k).try_cast("int") for k in (1, 2, 3))
    month = F.when((m >= 1) & (m <= 12), F.make_date(y, m, F.lit(1)))
    full = F.when((d >= 1) & (d <= F.dayofmonth(F.last_day(month))), F.date_add(month, d - 1)).otherwise(F.last_day(month))
    return F.coalesce(full, F.make_date(F.year(reported) - 1, F.lit(12), F.lit(31)))


def expiry(occurred: Column, days: Column, stated: Column) -> Column:
    return F.coalesce(stated, F.date_add(occurred, days.cast("int")))


def chunks(first: date, last: date, size: int = 14) -> list:
    """first to last, both included, in stretches of so many days."""
    out = []
    while first <= last:
        stop = min(last, first + timedelta(days=size - 1))
        out.append((first, stop))
        first = stop + timedelta(days=1)
    return out
