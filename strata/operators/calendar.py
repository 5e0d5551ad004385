"""Calendar dimension: one row per day between bounds computed in Spark.

Bounds are a one-row frame (start, end) — requested bounds, optionally widened
by an existing calendar and by the dates a fact actually uses — so nothing is
collected to the driver.  The day spine is ``explode(sequence(...))``: its size
is the number of days in the span, independent of data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import calendar_columns

CALENDAR_YEARS = 10


def requested_bounds(spark: SparkSession, start: str | Column,
                     end: str | Column | None = None, years: int = CALENDAR_YEARS) -> DataFrame:
    """``start`` .. ``end`` (default: ``start`` + ``years`` years, via
    ``add_months`` so a 29 February start is valid)."""
    s = F.to_date(F.lit(start) if isinstance(start, str) else start)
    e = (F.add_months(s, 12 * years) if end is None
         else F.to_date(F.lit(end) if isinstance(end, str) else end))
    return spark.range(1).select(s.alias("start"), e.alias("end"))


def bounds_of(df: DataFrame, date_col: str) -> DataFrame:
    """(min, max) day of a date/timestamp column, in one pass."""
    d = F.to_date(F.col(date_col))
    return df.agg(F.min(d).alias("start"), F.max(d).alias("end"))


def widen(*bounds: DataFrame) -> DataFrame:
    """Union of bound rows -> the covering span (missing inputs are skipped)."""
    parts = [b.select("start", "end") for b in bounds if b is not None]
    out = parts[0]
    for b in parts[1:]:
        out = out.unionByName(b)
    return out.agg(F.min("start").alias("start"), F.max("end").alias("end"))


def calendar(bounds: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """The calendar dimension for a one-row bounds frame."""
    a = (F.current_date() if as_of is None
         else F.to_date(F.lit(as_of) if isinstance(as_of, str) else as_of))
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("_day"))
    cols = calendar_columns(F.col("_day"), a)
    return days.select(*[c.alias(n) for n, c in cols.items()]).dropDuplicates(["TimeSkey"])
