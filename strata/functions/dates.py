"""Calendar attributes as Column expressions over a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_id(d: Column) -> Column:
    return (F.year(d) * 100 + F.month(d)).cast("int")


def quarter_id(d: Column) -> Column:
    return (F.year(d) * 10 + F.quarter(d)).cast("smallint")


def working_day(d: Column) -> Column:
    """1 Monday–Friday, 0 at weekends (``weekday`` is 0 for Monday)."""
    return F.when(F.weekday(d) < 5, F.lit(1)).otherwise(F.lit(0))


def calendar_columns(day: Column, as_of: Column) -> dict[str, Column]:
    """The calendar dimension's attributes for a DATE column ``day``."""
    return {
        "TimeSkey": F.date_format(day, "yyyyMMdd").cast("int"),
        "Date": day.cast("timestamp_ntz"),
        "DayOfWeek": F.date_format(day, "EEEE"),
        "CurrentDay": F.when(day == as_of, F.lit(1)).otherwise(F.lit(0)),
        "WorkingDay": working_day(day),
        "MonthId": month_id(day),
        "MonthDesc": F.date_format(day, "MMMM yyyy"),
        "QuarterId": quarter_id(day),
        "QuarterDesc": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "Year": F.year(day).cast("int"),
    }
