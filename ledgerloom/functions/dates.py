"""Calendar arithmetic on date columns, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first dates, read with or without zero padding.
READ_DAY_FIRST = "d/M/yyyy"
WRITE_DAY_FIRST = "dd/MM/yyyy"
PADDED = r"^[0-3][0-9]/[01][0-9]/[1-9][0-9]{3}\z"


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def truncate(date: Column, unit: str | None = None) -> Column:
    """First day of the year for ``unit='year'``, of the month otherwise."""
    return F.trunc(date, "year" if unit == "year" else "month")


def next_day(date: Column) -> Column:
    return F.date_add(date, 1)


def next_month(date: Column) -> Column:
    return F.add_months(month_start(date), 1)


def previous_month(date: Column) -> Column:
    return F.add_months(month_start(date), -1)


def days_in_month(date: Column) -> Column:
    return F.dayofmonth(F.last_day(date))


def day_weighted(amount: Column, date: Column) -> Column:
    """Amount scaled by the share of its month that is left, its own day included."""
    days = days_in_month(date)
    return amount * (days - F.dayofmonth(date) + 1) / days


def parse_day_first(text: Column) -> Column:
    """Padded dates, which are most, are cast; the pattern reads, or rejects, all others."""
    iso = F.concat(F.substring(text, 7, 4), F.lit("-"), F.substring(text, 4, 2), F.lit("-"),
                   F.substring(text, 1, 2))
    return F.coalesce(F.when(text.rlike(PADDED), iso.try_cast("date")), F.to_date(text, READ_DAY_FIRST))


def format_day_first(date: Column) -> Column:
    return F.date_format(date, WRITE_DAY_FIRST)
