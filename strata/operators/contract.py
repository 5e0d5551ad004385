"""Output contracts: exact names, order and types of a produced table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(AssertionError):
    pass


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, same order, declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def assert_schema(df: DataFrame, schema: T.StructType, check_types: bool = True) -> DataFrame:
    """Fail unless ``df`` has exactly the declared columns (and types)."""
    got = [f.name for f in df.schema.fields]
    want = [f.name for f in schema.fields]
    if got != want:
        raise ContractError(f"column mismatch: got {got}, expected {want}")
    if check_types:
        bad = [(g.name, g.dataType.simpleString(), w.dataType.simpleString())
               for g, w in zip(df.schema.fields, schema.fields) if g.dataType != w.dataType]
        if bad:
            raise ContractError(f"type mismatch: {bad}")
    return df
