"""Point-in-time lookup by a carried value: one sort instead of a range join.

Facts and dimension versions are put in one stream per natural key, ordered by
time, and every fact takes the last version before it.  The work is one shuffle
and one sort of facts and versions together, whatever the number of versions a
key has (a range join compares each fact with every version of its key).

Hot keys are dealt: a key with at least ``HOT_KEY_ROWS`` facts is spread over
``SALT_BUCKETS`` parts by a hash of its facts, and only its versions are
repeated in each part.  Facts without key or time match nothing and are not
shuffled.

The result equals ``star.resolve_as_of`` where a key's intervals do not overlap.
Where they do (``overlapping_versions`` reports them) a fact has one row all
the same: the version that began last decides, and if it has ended by then there
is no match.  Of versions that begin at one time the one with the largest key
counts.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.star import HOT_KEY_ROWS, SALT_BUCKETS, hot_keys

_KEY, _AT, _PART, _FACT, _VERSION = "_asof_key", "_asof_at", "_asof_part", "_asof_fact", "_asof_version"


def _parts(rows: DataFrame, hot: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with the number of parts of their key."""
    marked = rows.join(hot.withColumn("_hot", F.lit(True)), rows[_KEY] == hot["_hk"], "left")
    return marked.withColumn("_parts", F.when(F.col("_hot"), buckets).otherwise(1)).drop("_hk", "_hot")


def carry_as_of(fact: DataFrame, versions: DataFrame, fact_col: str, at_col: str,
                dim_col: str, key_col: str, out_col: str, spread_by: Sequence[str] | None = None,
                valid_from: str = "ValidFrom", valid_to: str = "ValidTo",
                hot_key_rows: int = HOT_KEY_ROWS, buckets: int = SALT_BUCKETS) -> DataFrame:
    """``fact`` with ``out_col``, the key of the version valid at ``at_col``.
    ``spread_by`` names fact columns that tell the rows of a hot key apart."""
    spread = list(spread_by or fact.columns)
    whole = F.struct(*(F.col(f"`{c}`") for c in fact.columns)).alias(_FACT)
    matchable = F.col(fact_col).isNotNull() & F.col(at_col).isNotNull()
    hot = hot_keys(fact.where(matchable), fact_col, hot_key_rows)

    facts = _parts(fact.where(matchable).select(
        F.col(fact_col).alias(_KEY), F.col(at_col).alias(_AT), whole,
        F.xxhash64(*(F.col(f"`{c}`") for c in spread)).alias("_spread")), hot, buckets)
    facts = facts.withColumn(_PART, F.pmod("_spread", "_parts").cast("int")).drop("_spread", "_parts")
    v = versions.where(F.col(dim_col).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(dim_col).alias(_KEY), F.col(valid_from).alias(_AT),
        F.struct(F.col(key_col).alias("key"), F.col(valid_to).alias("until")).alias(_VERSION))
    v = (_parts(v, hot, buckets)
         .withColumn(_PART, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts"))

    both = facts.unionByName(v, allowMissingColumns=True)
    # At one time versions come before facts, and of those the largest key last.
    order = Window.partitionBy(_KEY, _PART).orderBy(
        _AT, F.col(_FACT).isNotNull(), F.col(f"{_VERSION}.key").asc_nulls_first())
    carried = F.last(_VERSION, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_carried", carried).where(F.col(_FACT).isNotNull())
    valid = F.col("_carried.until").isNull() | (F.col(_AT) < F.col("_carried.until"))
    columns = [c for c in fact.columns if c != out_col]
    resolved = found.select(*(F.col(f"{_FACT}.`{c}`").alias(c) for c in columns),
                            F.when(valid, F.col("_carried.key")).alias(out_col))
    nothing = F.lit(None).cast(versions.schema[key_col].dataType).alias(out_col)
    rest = fact.where(~F.coalesce(matchable, F.lit(False))).select(*(F.col(f"`{c}`") for c in columns), nothing)
    return resolved.unionByName(rest)


def overlapping_versions(versions: DataFrame, dim_col: str, key_col: str,
                         valid_from: str = "ValidFrom", valid_to: str = "ValidTo") -> DataFrame:
    """Pairs of a key's neighbouring versions whose intervals overlap: key,
    earlier and later version, and the span they share."""
    order = Window.partitionBy(dim_col).orderBy(valid_from, key_col)
    nxt = versions.select(
        dim_col, F.col(key_col).alias("earlier"), F.col(valid_to).alias("_until"),
        F.lead(key_col).over(order).alias("later"), F.lead(valid_from).over(order).alias("overlap_from"),
        F.lead(valid_to).over(order).alias("_later_until"))
    shared = F.col("later").isNotNull() & (F.col("_until").isNull() | (F.col("overlap_from") < F.col("_until")))
    return nxt.where(shared).select(
        dim_col, "earlier", "later", "overlap_from",
        F.least("_until", "_later_until").alias("overlap_to"))    # least skips nulls (open ends)
