"""Audit log: one row per pipeline event, counts from ``Observation``.

Counts are observed while the data is written (no extra job per count); the
log itself is a handful of control rows appended to a table.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("LogDateTime", T.TimestampNTZType()),
    T.StructField("LogType", T.StringType()),
    T.StructField("LogMessage", T.StringType()),
    T.StructField("LogMessageDetails", T.StringType()),
    T.StructField("LogRowCount", T.LongType()),
    T.StructField("LogRunID", T.StringType()),
])


def observed(df: DataFrame, name: str, metrics: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Attach row-count (and any other) metrics to ``df``; values are
    available from the Observation after the first action on the result."""
    obs = Observation(name)
    ms = metrics or {}
    exprs = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in ms.items()]
    return df.observe(obs, *exprs), obs


def audit_frame(spark: SparkSession, run_id: str,
                events: Sequence[tuple[str, str, str, int]],
                at: _dt.datetime | None = None) -> DataFrame:
    """Log rows (type, message, details, row count) of one run."""
    ts = at or _dt.datetime.now()
    rows = [(ts, t, m, d, int(n), run_id) for t, m, d, n in events]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def append_audit(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
