"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratamart.functions.keys import date_key


def is_weekend(day: Column | str) -> Column:
    return F.dayofweek(day).isin(1, 7)


def months_before(day: Column, months: int) -> Column:
    """The same day ``months`` months earlier, or that month's last day."""
    return F.add_months(day, -months)


def calendar_columns(day: str) -> list[Column]:
    """Every attribute of the date dimension, computed from the DATE column ``day``."""
    d = F.col(day)
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "E").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        is_weekend(d).alias("is_weekend"),
        F.trunc(d, "MONTH").alias("month_start"),
        F.last_day(d).alias("month_end"),
        F.trunc(d, "QUARTER").alias("quarter_start"),
        F.trunc(d, "YEAR").alias("year_start"),
    ]
