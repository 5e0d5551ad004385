"""Sinks.  No ``coalesce(1)`` on data tables: output files are sized by
``maxRecordsPerFile`` and, for partitioned tables, rows are rebalanced by the
partition columns so each task writes few files and no task writes a whole hot
partition alone."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shuffles_removed

# Keys are digests in hex, which only a codec that codes entropy packs.
CODEC = "zstd"


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                max_records_per_file: int | None = 5_000_000,
                dynamic: bool = False, clustered: bool = False) -> None:
    """``clustered`` says that a task holds few values of ``partition_by`` anyway (there
    are but a handful, or equal ones lie together): rows then stay in their tasks,
    each of which writes a file a value, and are not shuffled."""
    out = df
    if partition_by and not clustered:
        # Rebalance (not repartition): rows are clustered by the partition
        # columns, and AQE splits a partition holding a large share of the
        # rows over several tasks (several files in one directory) while
        # merging small ones.
        out = out.hint("rebalance", *partition_by)
    w = out.write.format(fmt).mode(mode)
    if fmt == "parquet":
        w = w.option("compression", CODEC)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        w.save(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
              mode: str = "overwrite", num_partitions: int | None = None,
              options: dict[str, str] | None = None) -> None:
    """CSV with a header line in every file (archive, reject and landing zones).

    With ``partition_by``, rows are clustered by the partition columns first.
    By default they are rebalanced: AQE sizes tasks by volume and splits a hot
    directory over several tasks.  ``num_partitions`` pins the task count
    instead (hash clustering, one task per directory; AQE leaves an explicit
    count alone), for many small, evenly sized directories."""
    out = df
    if partition_by:
        cols = [F.col(c) for c in partition_by]
        out = (df.repartition(num_partitions, *cols) if num_partitions
               else df.hint("rebalance", *partition_by))
    w = out.write.mode(mode).option("header", True).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        w.csv(path)


def append_evolved(spark: SparkSession, df: DataFrame, path: str,
                   partition_by: Sequence[str] | None = None) -> DataFrame:
    """Append a batch whose schema may have gained columns, then return the
    table read with ``mergeSchema`` so old rows show nulls in new columns."""
    write_table(df, path, mode="append", partition_by=partition_by)
    return spark.read.option("mergeSchema", True).parquet(path)


def write_control_table(df: DataFrame, path: str, mode: str = "append") -> None:
    """One file for a control table (audit log, settings): a handful of rows
    by contract, so a single writer task is the right size.  Never used for
    data tables."""
    df.coalesce(1).write.mode(mode).parquet(path)
