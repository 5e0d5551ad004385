"""Slowly-changing dimension versioning over N ordered extracts.

All extracts are one frame with a ``version`` column.  Per business key, a row
is kept when it is the key's first appearance or any tracked column differs
(null-safe) from the key's previous kept row; ``ValidTo`` is the next kept
row's ``ValidFrom``; the row without a successor is the active one.  One
shuffle on the key serves both windows (same partitioning and order).
A key missing from a later extract stays active (extracts are deltas);
``history`` also knows full extracts, which close the keys they do not list, and
``splice_extract`` applies extracts in any order of arrival.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.predicates import changed


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def new_keys(new: DataFrame, base: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is absent from ``base`` (left anti join)."""
    return new.join(base.select(*_names(key)), _names(key), "left_anti")


def changed_keys(new: DataFrame, base: DataFrame, key: str | Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key exists in ``base`` with a different (null-safe)
    tracked value.  Returns the new row plus ``old_<col>`` for each tracked
    column."""
    keys = _names(key)
    old = base.select(*keys, *[F.col(c).alias(f"old_{c}") for c in tracked])
    j = new.join(old, keys, "inner")
    return j.filter(changed([j[c] for c in tracked], [j[f"old_{c}"] for c in tracked]))


def account_status(date_closed: Column) -> Column:
    """0 once a closing date is present, else 1."""
    return F.when(date_closed.isNotNull(), F.lit(0)).otherwise(F.lit(1))


def one_per_version(versions: DataFrame, key: str, version: str) -> DataFrame:
    """Exactly one row per (key, version); duplicates inside one extract are
    resolved deterministically (smallest row).  A partial aggregate, so a key
    repeated millions of times is combined map-side and reaches the window as
    one row per extract."""
    others = [c for c in versions.columns if c not in (key, version)]
    return (versions.groupBy(key, version)
            .agg(F.min(F.struct(*[F.col(c) for c in others])).alias("_row"))
            .select(key, version, *[F.col(f"_row.{c}").alias(c) for c in others]))


def version_dimension(versions: DataFrame, key: str, version: str, tracked: Sequence[str],
                      effective: Column, valid_from: str = "ValidFrom",
                      valid_to: str = "ValidTo", active: str = "isActive") -> DataFrame:
    versions = one_per_version(versions, key, version)
    w = Window.partitionBy(key).orderBy(version)
    prev = [F.lag(c).over(w) for c in tracked]
    first = F.lag(F.col(version)).over(w).isNull()
    keep = first | changed([F.col(c) for c in tracked], prev)
    kept = versions.withColumn("_keep", keep).filter("_keep").drop("_keep")
    kept = kept.withColumn(valid_from, effective)
    nxt = F.lead(F.col(valid_from)).over(w)
    return (kept.withColumn(valid_to, nxt)
                .withColumn(active, F.when(F.col(valid_to).isNull(), F.lit(1)).otherwise(F.lit(0))))


def apply_extract(current: DataFrame, extract: DataFrame, key: str, version: str,
                  tracked: Sequence[str], effective: Column, valid_from: str = "ValidFrom",
                  valid_to: str = "ValidTo", active: str = "isActive") -> DataFrame:
    """Incremental SCD step: apply one new extract to the current versions.

    Only the extract and the *active* rows meet (one join on the key); closed
    history passes through untouched.  A key whose tracked values changed
    (null-safe) gets its active row closed at the extract's effective time and
    a new active row; a new key gets an active row; unchanged keys produce
    nothing.  Equals ``version_dimension`` over all extracts."""
    ext = one_per_version(extract, key, version).withColumn(valid_from, effective)
    act = current.filter(F.col(active) == 1)
    old = act.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_o_{c}") for c in tracked])
    j = ext.join(old, ext[key] == old["_k"], "left")
    differs = changed([F.col(c) for c in tracked], [F.col(f"_o_{c}") for c in tracked])
    arriving = (j.filter(F.col("_k").isNull() | differs)
                .drop("_k", *[f"_o_{c}" for c in tracked])
                .withColumn(valid_to, F.lit(None).cast(current.schema[valid_to].dataType))
                .withColumn(active, F.lit(1)))
    closes = arriving.select(F.col(key).alias("_ck"), F.col(valid_from).alias("_cv"))
    touched = act.join(closes, act[key] == closes["_ck"], "left")
    hit = F.col("_ck").isNotNull()
    updated = (touched.withColumn(valid_to, F.when(hit, F.col("_cv")).otherwise(F.col(valid_to)))
               .withColumn(active, F.when(hit, F.lit(0)).otherwise(F.col(active)))
               .drop("_ck", "_cv"))
    history = current.filter(F.col(active) != 1)
    return history.unionByName(updated).unionByName(arriving.select(*current.columns))


def history(versions: DataFrame, key: str, version: str, tracked: Sequence[str],
            effective: Callable[[Column], Column], full_versions: Sequence[int] = (),
            valid_from: str = "ValidFrom", valid_to: str = "ValidTo", active: str = "isActive") -> DataFrame:
    """``version_dimension`` over extracts of which some, ``full_versions`` (a few
    numbers), list every living key.  The first full extract after a sighting of
    a key that neither it nor an extract in between lists closes the key at its
    effective time; a key that comes back later begins a new version, also with
    its old values.  ``effective`` gives the time of a version number."""
    rows = one_per_version(versions, key, version).withColumn("_gone", F.lit(False))
    w = Window.partitionBy(key).orderBy(version)
    if full_versions:
        numbers = F.array(*(F.lit(v).cast(versions.schema[version].dataType) for v in full_versions))
        closing = F.array_min(F.filter(numbers, lambda v: v > F.col(version)))
        missed = rows.select(key, version, closing.alias("_closing"), F.lead(version).over(w).alias("_after")).where(
            F.col("_closing").isNotNull() & (F.col("_after").isNull() | (F.col("_after") > F.col("_closing"))))
        ends = missed.select(key, F.col("_closing").alias(version), F.lit(True).alias("_gone"))
        rows = rows.unionByName(ends, allowMissingColumns=True)
    seen = [*tracked, "_gone"]
    keep = F.lag(F.col(version)).over(w).isNull() | changed(
        [F.col(c) for c in seen], [F.lag(c).over(w) for c in seen])
    kept = rows.withColumn("_keep", keep).filter("_keep").drop("_keep").withColumn(valid_from, effective(F.col(version)))
    return (kept.withColumn(valid_to, F.lead(valid_from).over(w)).filter("not _gone").drop("_gone")
            .withColumn(active, F.col(valid_to).isNull().cast("int")))


def splice_extract(current: DataFrame, staged: DataFrame, arrived: int, key: str, version: str,
                   tracked: Sequence[str], effective: Callable[[Column], Column],
                   full_versions: Sequence[int] = (), valid_from: str = "ValidFrom",
                   valid_to: str = "ValidTo", active: str = "isActive") -> DataFrame:
    """Apply the extract number ``arrived`` to the stored versions, whatever
    extracts came before it.

    ``staged`` holds all extracts that have arrived, this one included, and
    ``full_versions`` names the full ones among them.  The extract meets the
    stored intervals that hold its effective time: a key with equal values there
    is untouched; one that differs, that no interval holds or that a full extract
    does not list is spliced: its versions are rebuilt from its own rows in
    ``staged`` (one semi join), so an interval may be split, shortened, merged
    with its neighbour or closed.  Equals ``history`` over all of ``staged``, in
    any order of arrival.  Null keys are one key."""
    at = effective(F.lit(arrived).cast(staged.schema[version].dataType))
    new = one_per_version(staged.where(F.col(version) == arrived), key, version)
    new = new.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_n_{c}") for c in tracked), F.lit(True).alias("_new"))
    held = current.where((F.col(valid_from) <= at) & (F.col(valid_to).isNull() | (F.col(valid_to) > at)))
    held = held.select(F.col(key).alias("_h"), *(F.col(c).alias(f"_o_{c}") for c in tracked), F.lit(True).alias("_held"))
    both = new.join(held, new["_k"].eqNullSafe(held["_h"]), "full_outer" if arrived in full_versions else "left")
    touched = (F.col("_new").isNull() | F.col("_held").isNull()
               | changed([F.col(f"_n_{c}") for c in tracked], [F.col(f"_o_{c}") for c in tracked]))
    spliced = both.where(touched).select(
        F.when(F.col("_new"), F.col("_k")).otherwise(F.col("_h")).alias("_spliced")).distinct()
    own = staged.join(spliced, staged[key].eqNullSafe(spliced["_spliced"]), "left_semi")
    rebuilt = history(own, key, version, tracked, effective, full_versions, valid_from, valid_to, active)
    rest = current.join(spliced, current[key].eqNullSafe(spliced["_spliced"]), "left_anti")
    return rest.unionByName(rebuilt.select(*current.columns))
