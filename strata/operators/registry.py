"""Persisted surrogate keys: a registry of natural key -> dense BIGINT.

The registry is a stored table with the natural key's columns and the number.
``register`` adds the keys it does not hold yet and leaves the rest alone, so a
number never changes; new keys are numbered on from the largest one without a
gap, in the order of their natural key.

Numbering needs no window over the keys: they are sorted into ranges, written,
and a key's number is the registry's size, plus the keys in the ranges before
its own (one small row a range), plus its place in the range.  A natural key that a
third of all rows share is one row before anything is shuffled.  Null parts are
ordinary values.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import discard, scratch_path
from strata.sources.tables import read_optional
from strata.sources.writers import write_table

# Rows of one range are numbered below this (``monotonically_increasing_id``).
_RANGE = 1 << 33


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(right[f"_r_{k}"])
    return same


def _renamed(registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    return registry.withColumnsRenamed({k: f"_r_{k}" for k in keys})


def register(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str],
             number: str = "Skey", first: int = 1) -> DataFrame:
    """Add the natural keys of ``rows`` to the registry at ``path`` (created when
    absent) and return it.  A rerun with the same rows appends nothing.  One
    writer at a time, as for any numbering."""
    known = read_optional(spark, path)
    new = rows.select(*keys).distinct()
    if known is not None:
        held = _renamed(known, keys)
        new = new.join(held, _same(new, held, keys), "left_anti")
    # Written in sorted ranges; the id holds the range and the place in it.
    staged = scratch_path(spark, "registry-new")
    write_table(new.repartitionByRange(*(F.col(k).asc_nulls_first() for k in keys))
                .sortWithinPartitions(*(F.col(k).asc_nulls_first() for k in keys))
                .withColumn("_id", F.monotonically_increasing_id()), staged)
    placed = spark.read.schema(new.withColumn("_id", F.lit(0).cast("long")).schema).parquet(staged).select(
        *keys, F.floor(F.col("_id") / _RANGE).alias("_range"), (F.col("_id") % _RANGE).alias("_place"))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))      # one row a range
    before = F.coalesce(F.sum("_n").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = first + (0 if known is None else known.count())     # file footers only
    numbered = placed.join(F.broadcast(counts.select("_range", before.alias("_before"))), "_range").select(
        *keys, (F.lit(start).cast("long") + F.col("_before") + F.col("_place")).alias(number))
    write_table(numbered, path, mode="append")
    discard(spark, staged)
    return spark.read.schema(numbered.schema).parquet(path)


def resolve(rows: DataFrame, registry: DataFrame, keys: Sequence[str], number: str = "Skey") -> DataFrame:
    """``rows`` with the number of their natural key (null where unregistered)."""
    known = _renamed(registry, keys)
    return rows.join(known, _same(rows, known, keys), "left").drop(*(f"_r_{k}" for k in keys))
