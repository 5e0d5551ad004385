"""Broadcast only behind a proven size bound.

Without a bound, nothing is hinted: Spark's own size check decides
(plan-time statistics against ``spark.sql.autoBroadcastJoinThreshold`` and,
with AQE, the real shuffle sizes against
``spark.sql.adaptive.autoBroadcastJoinThreshold``) and otherwise keeps a
shuffle join, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when it provably holds at most ``max_rows`` rows.

    ``known_rows`` is an upper bound the caller already has; otherwise the rows
    are counted (one number a task reaches the last stage)."""
    n = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if n <= max_rows else df
