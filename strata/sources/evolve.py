"""Appending batches whose types change: widen, fill, or quarantine.

The table's schema is a stored contract (one row a change, the newest holds).  For
each batch every column is decided by name, so order does not matter:

* the same type: kept;
* a narrower one: cast up to the table's;
* a wider one (``common_type``): the contract is widened.  Stored files stay as they
  are; Spark's Parquet reader promotes their values when it reads with the contract;
* a new column: added, null in older rows; a missing one: null in this batch;
* any other type: the column keeps its type, values are tried, and rows with a value
  that does not fit go whole to the quarantine, with the column's name.

A widening never loses a digit: integers meet as the longer one, with a decimal as
a decimal that holds both; only integers of up to 32 bits become doubles.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.tables import read_optional
from strata.sources.writers import write_control_table, write_table

_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of both, None where there is none."""
    if a == b:
        return a
    if a in _DIGITS and b in _DIGITS:
        return max(a, b, key=_DIGITS.get)
    parts = []
    for t in (a, b):
        if t in _DIGITS:
            parts.append((_DIGITS[t], 0))
        elif isinstance(t, T.DecimalType):
            parts.append((t.precision - t.scale, t.scale))
    if len(parts) == 2:
        whole, scale = (max(p) for p in zip(*parts))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    kinds = {type(a), type(b)}
    if T.DoubleType in kinds and kinds <= {T.DoubleType, T.FloatType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def reconcile(held: T.StructType, batch: T.StructType) -> tuple[T.StructType, list[str]]:
    """(the contract after the batch, the batch's columns whose type does not fit)."""
    fields, unfit = [], []
    arriving = {f.name: f.dataType for f in batch}
    for f in held:
        kind = common_type(f.dataType, arriving[f.name]) if f.name in arriving else f.dataType
        if kind is None:
            unfit.append(f.name)
        fields.append(T.StructField(f.name, kind or f.dataType))
    known = {f.name for f in held}
    fields += [T.StructField(f.name, f.dataType) for f in batch if f.name not in known]
    return T.StructType(fields), unfit


def contract_of(spark: SparkSession, path: str) -> T.StructType | None:
    """The newest stored contract (a control table of a row a change)."""
    stored = read_optional(spark, path)
    newest = None if stored is None else stored.orderBy(F.desc("number")).first()
    return None if newest is None else T.StructType.fromJson(json.loads(newest["schema"]))


def append_reconciled(spark: SparkSession, batch: DataFrame, path: str, contract: str, quarantine: str) -> DataFrame:
    """Append ``batch`` to the table at ``path`` under the contract stored at
    ``contract`` (see the module's notes); returns the whole table.  Rows that do
    not fit are appended to ``quarantine``: the column and the row as JSON."""
    held = contract_of(spark, contract)
    schema, unfit = (T.StructType([T.StructField(f.name, f.dataType) for f in batch.schema]), []) if held is None \
        else reconcile(held, batch.schema)
    if unfit:
        fits = {c: F.col(f"`{c}`").try_cast(schema[c].dataType) for c in unfit}
        wrong = F.coalesce(*(F.when(F.col(f"`{c}`").isNotNull() & v.isNull(), F.lit(c)) for c, v in fits.items()))
        whole = F.to_json(F.struct(*(F.col(f"`{c}`") for c in batch.columns)))
        write_table(batch.withColumn("column", wrong).where("column is not null").select("column", whole.alias("row")),
                    quarantine, mode="append")
        batch = batch.where(wrong.isNull()).withColumns(fits)
    write_table(batch.select(*(
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema)), path, mode="append")
    if schema != held:
        number = 0 if held is None else spark.read.parquet(contract).count()
        write_control_table(spark.createDataFrame([(number, schema.json())], "number long, schema string"), contract)
    return spark.read.schema(schema).parquet(path)
