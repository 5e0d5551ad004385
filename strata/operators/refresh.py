"""Idempotent partition refresh and retention windows."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.writers import write_table


def refresh_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], clustered: bool = False) -> None:
    """Replace exactly the partitions present in ``df`` and insert new ones,
    in one write (dynamic partition overwrite, set per write, not per
    session).  Partitions absent from ``df`` are untouched, so running it twice
    equals running it once.  ``clustered``: see ``write_table``."""
    write_table(df, path, mode="overwrite", partition_by=partition_cols, dynamic=True, clustered=clustered)


def retain(df: DataFrame, basis: str, months: int, as_of: str | Column | None = None,
           year_col: str | None = None, month_col: str | None = None) -> DataFrame:
    """Rows whose ``basis`` date lies within the last ``months`` months of
    ``as_of`` (default today).

    The range predicate on the basis column is pushed to the scan.  When the
    table is partitioned by year and month, ``year_col``/``month_col`` add the
    implied (coarser) predicate on the partition columns; with a literal
    ``as_of`` it folds to a constant, so whole partitions are pruned."""
    a = (F.current_date() if as_of is None
         else F.to_date(F.lit(as_of) if isinstance(as_of, str) else as_of))
    start = F.add_months(a, -months)
    out = df.filter(F.col(basis) >= start)
    if year_col and month_col:
        y, m = F.year(start), F.month(start)
        out = out.filter((F.col(year_col) > y) | ((F.col(year_col) == y) & (F.col(month_col) >= m)))
    return out


def partition_keys(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Distinct partition values a batch touches."""
    return df.select(*partition_cols).distinct()
