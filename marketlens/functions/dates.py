"""Dates and calendar helpers; 'today' is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col


def day(as_of: str | dt.date) -> Column:
    return F.lit(str(as_of)).cast("date")


def parse_date(value) -> Column:
    x = as_col(value).cast("string")
    return F.coalesce(F.try_to_date(x, "yyyy-MM-dd"), x.try_cast("date"))


def parse_timestamp(value) -> Column:
    x = as_col(value).cast("string")
    return F.coalesce(F.try_to_timestamp(x, F.lit("yyyy-MM-dd HH:mm:ss")), x.try_cast("timestamp"))


def month_start(year="year", month="month") -> Column:
    return F.make_date(as_col(year).cast("int"), as_col(month).cast("int"), F.lit(1))


def next_month(as_of) -> Column:
    """First day of the month after ``as_of``."""
    return F.add_months(F.trunc(day(as_of), "MM"), 1)


def days_between(later, earlier) -> Column:
    return F.datediff(as_col(later), as_col(earlier)).cast("bigint")
