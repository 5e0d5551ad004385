"""Set operations, duplicates and distinct-with-intent."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` absent from ``right`` (null equals null)."""
    return left.subtract(right)


# Largest number of copies of one row a single task emits in set_difference_all.
COPIES_PER_TASK = 1_000_000


def set_difference_all(left: DataFrame, right: DataFrame,
                       copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Multiset difference (EXCEPT ALL): each right row cancels one equal left
    row (null equals null).

    Counts per distinct row are a partial aggregate.  The surviving copies
    are then emitted in chunks of at most ``copies_per_task``, and the chunks
    are rebalanced, so a row that makes up a third of the input is emitted by
    many tasks rather than one (``exceptAll`` replicates each group in the
    task that holds it)."""
    cols = left.columns
    signed = (left.select(*cols, F.lit(1).alias("_d"))
              .unionByName(right.select(*cols, F.lit(-1).alias("_d"))))
    counts = signed.groupBy(*cols).agg(F.sum("_d").alias("_n")).filter(F.col("_n") > 0)
    n = F.col("_n")
    chunks = counts.select(*cols, n, F.explode(F.sequence(
        F.lit(0).cast("long"), ((n - 1) / copies_per_task).cast("long"))).alias("_c"))
    sized = chunks.withColumn("_k", F.least(F.lit(copies_per_task).cast("long"),
                                           n - F.col("_c") * copies_per_task))
    return (sized.hint("rebalance")
            .select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))).alias("_i"))
            .drop("_i"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Natural keys that occur more than once, with their multiplicity.
    A partial aggregate: hot keys are combined map-side before the shuffle."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(count_col))
              .filter(F.col(count_col) > 1))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing from a frame is null there
    (extracts whose layout gained columns over time)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
