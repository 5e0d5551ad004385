"""Type-1 upsert (MERGE) as a pure function: full outer join on the key.

Matched rows take the source's values for ``update_cols``; unmatched source
rows are inserted; unmatched target rows are kept.  ``InsertedDateTime``
survives updates; ``ModifiedDateTime`` moves only when some column differs
(null-safe comparison), so re-applying the same source is a no-op (idempotent).

A key given several times by the source counts once, with the row whose
``update_cols`` are the largest (compared in their order, nulls smallest); a
null key is an ordinary key.  Target columns that are neither key nor updated nor
a time stamp keep their values; an inserted row has nulls there.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.predicates import changed
from strata.session import discard, scratch_path
from strata.sources.writers import write_table


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str], load_ts: Column,
           inserted_col: str = "InsertedDateTime",
           modified_col: str = "ModifiedDateTime") -> DataFrame:
    """Merge ``source`` into ``target``: each side is read once, the target is
    shuffled once and the source twice (reduced to one row a key, then joined
    null-safely)."""
    s = (source.groupBy(*keys).agg(F.max(F.struct(*update_cols)).alias("_new"))
         .select(*[F.col(k).alias(f"_s_{k}") for k in keys], "_new", F.lit(True).alias("_in_s")))
    t = target.withColumn("_in_t", F.lit(True))
    cond = None
    for k in keys:
        c = t[k].eqNullSafe(s[f"_s_{k}"])
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    in_s, in_t = F.col("_in_s").isNotNull(), F.col("_in_t").isNotNull()
    moved = ~in_t | changed([F.col(f"_new.{c}") for c in update_cols], [F.col(c) for c in update_cols])
    stamped = {*keys, *update_cols, inserted_col, modified_col}
    return j.select(
        *[F.coalesce(F.col(f"_s_{k}"), F.col(k)).alias(k) for k in keys],
        *[F.when(in_s, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in update_cols],
        F.when(in_t, F.col(inserted_col)).otherwise(load_ts).alias(inserted_col),
        F.when(in_s & moved, load_ts).otherwise(F.col(modified_col)).alias(modified_col),
        *[F.col(f"`{c}`") for c in target.columns if c not in stamped])


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(right[f"{prefix}{k}"])
    return same


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                     update_cols: Sequence[str], partition_cols: Sequence[str], load_ts: Column,
                     inserted_col: str = "InsertedDateTime", modified_col: str = "ModifiedDateTime",
                     find_moved: bool = True) -> int:
    """Upsert ``source`` into the partitioned table at ``path`` and rewrite only the
    partitions in which a row is new or differs; returns how many those are.

    The source brings the partition columns.  Rows that the table holds already
    with equal values are put aside first, by a join with the table's keys and
    compared columns, so a rerun touches no file.  The partitions of the rest are
    found by a semi join, merged by ``upsert`` and written in one dynamic overwrite;
    all other files keep their names.  A key's partition may not change: a source
    key that the table holds in another partition is an error, as a row can only be
    replaced where it lies.  Where the partition follows from the key,
    ``find_moved=False`` reads only the partitions that the source names."""
    target = spark.read.parquet(path)
    kinds = dict(target.dtypes)
    source = source.withColumns({c: F.col(c).cast(kinds[c]) for c in partition_cols})
    named = source.select(*(F.col(c).alias(f"_p_{c}") for c in partition_cols)).distinct()
    seen = target if find_moved else target.join(named, _same(target, named, partition_cols, "_p_"), "left_semi")
    one = source.groupBy(*keys, *partition_cols).agg(F.max(F.struct(*update_cols)).alias("_new"))
    held = seen.select(*(F.col(c).alias(f"_t_{c}") for c in [*keys, *partition_cols, *update_cols]),
                         F.lit(True).alias("_held"))
    met = one.join(held, _same(one, held, keys, "_t_"), "left")
    elsewhere = ~_all_equal([met[c] for c in partition_cols], [F.col(f"_t_{c}") for c in partition_cols])
    differs = F.col("_held").isNull() | changed(
        [F.col(f"_new.{c}") for c in update_cols], [F.col(f"_t_{c}") for c in update_cols])
    staged = scratch_path(spark, "merge-news")
    write_table(met.where(differs | elsewhere).select(
        *keys, *partition_cols, *(F.col(f"_new.{c}").alias(c) for c in update_cols),
        (F.col("_held").isNotNull() & elsewhere).alias("_moved")), staged)
    news = spark.read.parquet(staged)
    counts = news.agg(F.count(F.lit(1)), F.max("_moved")).first()
    if counts[1]:
        raise ValueError("a key of the source lies in another partition of the table")
    if not counts[0]:
        discard(spark, staged)
        return 0
    touched = news.select(*(F.col(c).alias(f"_p_{c}") for c in partition_cols)).distinct()
    before = target.join(touched, _same(target, touched, partition_cols, "_p_"), "left_semi")
    merged = upsert(before, news.drop("_moved"), [*keys, *partition_cols], update_cols, load_ts,
                    inserted_col, modified_col).select(*target.columns)
    result = scratch_path(spark, "merge-result")    # a table cannot be overwritten while it is read
    write_table(merged, result, partition_by=partition_cols)
    write_table(spark.read.schema(target.schema).parquet(result), path, partition_by=partition_cols, dynamic=True,
                clustered=True)     # as the result is
    rewritten = touched.count()
    discard(spark, staged)
    discard(spark, result)
    return rewritten


def _all_equal(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return ~changed(list(left), list(right))
