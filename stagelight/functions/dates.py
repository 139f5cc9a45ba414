"""Date expressions. Dates run to the end of Spark's date type; beyond it a query stops with an error."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The last day that a date can hold, counted from 1970-01-01.
LAST_DAY = (1 << 31) - 1
EPOCH = dt.date(1970, 1, 1)


def _checked(day_number: Column) -> Column:
    """The date of a day number; an error for one that a date cannot hold, NULL for NULL."""
    failed = F.raise_error(F.lit("a date lies beyond the end of the calendar")).cast("int")
    number = F.when(day_number.isNull() | (day_number <= LAST_DAY), day_number.try_cast("int")).otherwise(failed)
    return F.date_from_unix_date(number)


def days_after(base: dt.date, offset: Column) -> Column:
    """``base`` plus ``offset`` days; NULL for a negative offset, an error for one beyond the calendar."""
    number = F.when(offset >= 0, offset.cast("decimal(20,0)") + (base - EPOCH).days)
    return _checked(number)


def add_days(day: Column, days: int) -> Column:
    """``day`` plus a fixed number of days; an error beyond the calendar."""
    return day if days == 0 else _checked(F.unix_date(day).cast("long") + days)


def week_of_year(day: Column) -> Column:
    """Week number 0..53 with Monday as first day; days before the year's first Monday are week 0."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


def month_text(day: Column) -> Column:
    """'YYYY-MM', with as many digits as the year has."""
    year = F.year(day).cast("string")
    padded = F.when(F.length(year) >= 4, year).otherwise(F.lpad(year, 4, "0"))
    return F.concat(padded, F.lit("-"), F.lpad(F.month(day).cast("string"), 2, "0"))
