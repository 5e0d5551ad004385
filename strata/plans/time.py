"""Time dimension: a calendar spanning the business's order history (first
order date + 10 years), widened by an existing calendar when one exists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.calendar import CALENDAR_YEARS, bounds_of, calendar, widen


def span_from(df: DataFrame, date_col: str, years: int = CALENDAR_YEARS) -> DataFrame:
    """(first day, first day + years) of a date column, as a one-row frame."""
    return bounds_of(df, date_col).select(
        "start", F.add_months("start", 12 * years).alias("end"))


def dim_time(requested: DataFrame, as_of: str, existing: DataFrame | None = None) -> DataFrame:
    b = requested if existing is None else widen(requested, bounds_of(existing, "Date"))
    return calendar(b, as_of=as_of)
