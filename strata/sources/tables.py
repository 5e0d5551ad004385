"""Table scans, the optional-table scan and the settings table."""

from __future__ import annotations

from typing import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS_SCHEMA = T.StructType([
    T.StructField("SettingName", T.StringType(), False),
    T.StructField("SettingValue", T.StringType(), False),
])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               merge_schema: bool = False) -> DataFrame:
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path`` or None when it does not exist yet.  Only a
    missing path is tolerated; any other analysis error propagates."""
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition() or "") or "Path does not exist" in str(e):
            return None
        raise


def settings_frame(spark: SparkSession, rows: Iterable[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), SETTINGS_SCHEMA)


def settings_lookup(settings: DataFrame) -> dict[str, str]:
    """Key/value settings as a dict.  The settings table is a handful of
    control rows by contract (one per zone), so collecting it is bounded."""
    return {r["SettingName"]: r["SettingValue"]
            for r in settings.select("SettingName", "SettingValue").collect()}
