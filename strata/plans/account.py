"""Account dimension: clean -> split groups/members -> exceptions -> parent
lookup -> SCD versions -> gold."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import stable_key
from strata.functions.predicates import first_reason
from strata.functions.text import clean_text, label
from strata.operators.hierarchy import lookup_parent, split_roots
from strata.operators.scd import account_status, apply_extract, history, splice_extract, version_dimension

REQUIRED = ("RowId", "AccountNo", "AccountDesc", "ParentRowId", "DateOpened")
TRACKED = ("AccountDesc", "PrimaryGroupNo", "DateOpened", "DateClosed")
UNKNOWN = "Unknown"


def cleaned(versions: DataFrame) -> DataFrame:
    return versions.withColumn("AccountDesc", clean_text("AccountDesc"))


def member_reasons(versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, members tagged with the first missing required field)."""
    groups, members = split_roots(cleaned(versions), "ParentRowId", ["DateOpened", "DateClosed"])
    rules = [(f"{c} is missing", F.col(c).isNull()) for c in REQUIRED]
    return groups, members.withColumn("exception_reason", first_reason(rules))


def exceptions(versions: DataFrame) -> DataFrame:
    _, members = member_reasons(versions)
    return members.filter(F.col("exception_reason").isNotNull())


def with_parents(versions: DataFrame) -> DataFrame:
    """Valid members of every extract with their group (same extract)."""
    groups, members = member_reasons(versions)
    valid = members.filter(F.col("exception_reason").isNull()).drop("exception_reason")
    j = lookup_parent(valid, groups, on=[("version", "version"), ("ParentRowId", "AccountNo")],
                      parent_cols={"AccountDesc": "PrimaryGroupDesc"}, default=UNKNOWN)
    return j.select(F.col("RowId").alias("SourceSystemId"), "AccountNo", "AccountDesc",
                    F.col("ParentRowId").alias("PrimaryGroupNo"), "PrimaryGroupDesc",
                    "DateOpened", "DateClosed", "version")


DERIVED = ("AccountStatus", "AccountSkey")


def _finish(v: DataFrame) -> DataFrame:
    return v.withColumns({
        "AccountStatus": account_status(F.col("DateClosed")),
        "AccountSkey": stable_key("AccountNo", "version"),
    })


def silver(versions: DataFrame, effective) -> DataFrame:
    """Versions of every account over all extracts (full recompute)."""
    v = version_dimension(with_parents(versions), key="AccountNo", version="version",
                          tracked=TRACKED, effective=effective(F.col("version")))
    return _finish(v)


def apply_new_extract(current_silver: DataFrame, extract: DataFrame, effective) -> DataFrame:
    """Incremental silver: apply one new extract to the stored versions."""
    v = apply_extract(current_silver.drop(*DERIVED), with_parents(extract), key="AccountNo",
                      version="version", tracked=TRACKED, effective=effective(F.col("version")))
    return _finish(v)


def silver_of_any_order(staged: DataFrame, order: Sequence[int], full: Sequence[int], effective,
                        store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Silver after the extracts of ``staged`` (``with_parents``) arrived in
    ``order``; those in ``full`` list every living account.  ``store`` writes
    each step's result and reads it back."""
    names = {"key": "AccountNo", "version": "version", "tracked": TRACKED, "effective": effective}
    arrived: list[int] = []
    current = None
    for number in order:
        arrived.append(number)
        seen = staged.where(F.col("version").isin(arrived))
        known_full = [v for v in full if v in arrived]
        current = store(history(seen, full_versions=known_full, **names) if current is None
                        else splice_extract(current, seen, number, full_versions=known_full, **names))
    return _finish(current)


def gold(silver_df: DataFrame) -> DataFrame:
    return silver_df.filter(F.col("isActive") == 1).select(
        label("AccountNo", "AccountDesc").alias("Account"),
        label("PrimaryGroupNo", "PrimaryGroupDesc").alias("AccountGroup"),
        "AccountNo", "AccountDesc", "PrimaryGroupNo", "PrimaryGroupDesc",
        "DateOpened", "DateClosed", "isActive", "AccountStatus", "AccountSkey")
