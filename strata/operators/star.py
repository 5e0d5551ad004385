"""Star-schema key resolution.

Each dimension is first reduced to one member per natural key (the current
version), so the fact's row count is preserved by construction.  Joins are left
outer: an unresolved key stays null and is quarantined downstream.  A dimension
is broadcast only behind a count of its rows; beyond that the join is a shuffle
join with the fact's hot keys salted (AQE's skew-join split does not apply when
the dimension side is an aggregate) and null keys spread.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Lookup:
    dim: DataFrame
    fact_col: str     # natural key in the fact
    dim_col: str      # natural key in the dimension
    key_col: str      # surrogate key in the dimension
    out_col: str      # name of the resolved key in the fact


def current_members(dim: DataFrame, natural_key: str, key_col: str,
                    current_first: Sequence[str] = ("isActive", "version", "ValidFrom")) -> DataFrame:
    """One surrogate key per natural key: the active member, of several the
    latest version, of still several (two members that share a natural key; see
    ``duplicate_keys``) the one with the largest key."""
    order = [F.col(c) for c in current_first if c in dim.columns]
    if not order:
        return dim.groupBy(natural_key).agg(F.max(key_col).alias(key_col))
    return dim.groupBy(natural_key).agg(F.max_by(key_col, F.struct(*order, key_col)).alias(key_col))


# Prefix of the stand-in join key given to fact rows whose natural key is null.
NULL_KEY_PREFIX = "\u0001null:"


def spread_nulls(fact: DataFrame, col: str,
                  spread_by: Sequence[str] | None = None) -> tuple[DataFrame, str]:
    """A join key equal to ``col``, except that null (never-matching) string
    keys become distinct non-matching values derived from the row (its
    ``spread_by`` columns, default all), so they spread over all shuffle
    partitions instead of piling into one task."""
    if not isinstance(fact.schema[col].dataType, T.StringType):
        return fact, col
    jk = f"_jk_{col}"
    row = F.xxhash64(*[F.col(c) for c in (spread_by or fact.columns)]).cast("string")
    return fact.withColumn(jk, F.coalesce(F.col(col), F.concat(F.lit(NULL_KEY_PREFIX), row))), jk


# A dimension (one row per natural key) up to this many rows is broadcast.
DIM_BROADCAST_ROWS = 5_000_000
# Beyond that the join is a shuffle join: a fact key holding at least this
# many rows is spread over SALT_BUCKETS buckets.
HOT_KEY_ROWS = 1_000_000
SALT_BUCKETS = 32


def hot_keys(fact: DataFrame, col: str, min_rows: int) -> DataFrame:
    """Keys holding at least ``min_rows`` fact rows: a partial aggregate of
    one column (hot keys are combined map-side).  At most
    rows / ``min_rows`` keys, so the result is small."""
    return (fact.groupBy(F.col(col).alias("_hk")).agg(F.count(F.lit(1)).alias("_hn"))
            .filter(F.col("_hn") >= min_rows).select("_hk"))


def salted_left_join(out: DataFrame, jk: str, d: DataFrame, nk: str, spread: Sequence[str],
                 min_rows: int, buckets: int, hot: DataFrame | None = None) -> DataFrame:
    """Left join on ``jk = nk`` where the fact's hot keys are spread over
    ``buckets`` salt values and only their dimension rows are replicated.
    ``hot`` are the hot keys (``_hk``) where the caller has them already."""
    # No broadcast hint: the hot keys are few (rows / min_rows), and Spark sees
    # the size of the aggregate when it runs.
    hot = (hot_keys(out, jk, min_rows) if hot is None else hot).withColumn("_is_hot", F.lit(True))
    fact = out.join(hot, out[jk] == hot["_hk"], "left").drop("_hk")
    fact = fact.withColumn("_salt", F.when(F.col("_is_hot"), F.pmod(
        F.xxhash64(*[F.col(c) for c in spread]), F.lit(buckets))).otherwise(F.lit(0))).drop("_is_hot")
    dh = d.join(hot, d[nk] == hot["_hk"], "left").drop("_hk")
    dim = dh.withColumn("_dsalt", F.explode(F.when(
        F.col("_is_hot"), F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long")))
        .otherwise(F.array(F.lit(0).cast("long"))))).drop("_is_hot")
    cond = (fact[jk] == dim[nk]) & (fact["_salt"] == dim["_dsalt"])
    return fact.join(dim, cond, "left").drop("_salt", "_dsalt")


def resolve_keys(fact: DataFrame, lookups: list[Lookup],
                 spread_by: Sequence[str] | None = None,
                 broadcast_rows: int = DIM_BROADCAST_ROWS, hot_key_rows: int = HOT_KEY_ROWS,
                 salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Left-join each dimension's current surrogate key onto the fact.

    Each dimension is reduced to one member per natural key and size-checked
    by a count of its rows.  Up to ``broadcast_rows`` members it is
    broadcast: no shuffle of the fact, and no skew.  Beyond that the join is a
    shuffle join in which fact keys with at least ``hot_key_rows`` rows are
    salted over ``salt_buckets`` tasks, and null keys get spread stand-in
    keys.  ``spread_by`` names fact columns that identify a row (its natural
    key); they seed the salts and stand-in keys."""
    out = fact
    spread = list(spread_by or fact.columns)
    for i, lk in enumerate(lookups):
        nk = f"_nk{i}"
        d = current_members(lk.dim, lk.dim_col, lk.key_col).select(
            F.col(lk.dim_col).alias(nk), F.col(lk.key_col).alias(lk.out_col))
        # The dimension's rows bound its members; a count sends one number a
        # task (for a stored table it reads file footers only).
        if lk.dim.count() <= broadcast_rows:
            out = out.join(F.broadcast(d), out[lk.fact_col] == d[nk], "left").drop(nk)
            continue
        out, jk = spread_nulls(out, lk.fact_col, spread)
        # Hot keys come from one column of the stored input, not from the chain
        # of joins so far.
        hot = hot_keys(fact.where(F.col(lk.fact_col).isNotNull()), lk.fact_col, hot_key_rows)
        out = salted_left_join(out, jk, d, nk, spread, hot_key_rows, salt_buckets, hot).drop(nk)
        if jk != lk.fact_col:
            out = out.drop(jk)
    return out


def resolve_as_of(fact: DataFrame, versions: DataFrame, fact_col: str, at_col: str,
                  dim_col: str, key_col: str, out_col: str,
                  valid_from: str = "ValidFrom", valid_to: str = "ValidTo") -> DataFrame:
    """Point-in-time lookup: the version whose [ValidFrom, ValidTo) holds the
    fact's date.  An equi-join on the natural key with a range residual — each
    fact row meets only its own key's few versions, never a cross product."""
    v = versions.select(F.col(dim_col).alias("_nk"), F.col(key_col).alias(out_col),
                        F.col(valid_from).alias("_vf"), F.col(valid_to).alias("_vt"))
    cond = ((fact[fact_col] == v["_nk"]) & (fact[at_col] >= v["_vf"])
            & (v["_vt"].isNull() | (fact[at_col] < v["_vt"])))
    return fact.join(v, cond, "left").drop("_nk", "_vf", "_vt")
