"""Account and product extracts: landed CSV -> contract -> stage, archive, reject.

Every source file is read once as text.  A source whose files all begin with the
declared header goes to the archive zone, any other to the reject zone, whole rows
as they arrived; only rows of the former are typed and staged.  A staged row
with a cell that does not fit its type has a null there and is counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import (CORRUPT, HEADER_OK, IS_HEADER, MALFORMED, SOURCE, contract_of_files, empty_files,
                                  file_headers, good_files, scan_landed, typed_rows)
from strata.sources.tables import read_table
from strata.sources.writers import write_csv, write_table

# Values keep their spaces: what arrives is what was landed.
AS_IS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


@dataclass(frozen=True)
class Bronze:
    """The tables of one kind of extract."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def land(files: dict[str, DataFrame], path: str) -> str:
    """Write source files as they arrive: CSV with a header, a directory a source."""
    for rows in files.values():
        write_csv(rows, path, partition_by=[SOURCE], mode="append", options=AS_IS)
    return path


def ingest(spark: SparkSession, landed: str, expected: T.StructType, bronze: Bronze) -> Bronze:
    """Contract, stage and zones of everything landed in ``landed``."""
    raw = scan_landed(spark, landed, expected)
    write_table(file_headers(raw), bronze.path("headers"))
    headers = read_table(spark, bronze.path("headers"))      # a row a file
    write_table(contract_of_files(headers, empty_files(raw, landed)), bronze.path("contract"))
    rows = typed_rows(raw, expected, rename=False, good=good_files(headers))
    contract = read_table(spark, bronze.path("contract"))     # a row a source
    write_table(rows.join(contract.where("contract_ok").select(SOURCE), SOURCE, "left_semi").drop(HEADER_OK),
                bronze.path("stage"), partition_by=[SOURCE])
    zone = F.when(F.col("contract_ok"), "archive").otherwise("reject").alias("zone")
    whole = raw.where(~F.col(IS_HEADER)).select(*(f"`{f.name}`" for f in expected.fields), CORRUPT, SOURCE)
    write_csv(whole.join(contract.select(SOURCE, zone), SOURCE), bronze.path("zones"),
              partition_by=["zone", SOURCE], options=AS_IS)
    return bronze


def staged(spark: SparkSession, bronze: Bronze) -> DataFrame:
    """The typed rows of the sources that honour the contract."""
    return read_table(spark, bronze.path("stage"))


def outcome(spark: SparkSession, bronze: Bronze, expected: T.StructType) -> DataFrame:
    """Per source: contract_ok, n_staged rows, n_malformed among them, and n_archived
    and n_rejected, counted in the zones (a wrong header line is no row)."""
    first = expected.fields[0].name
    rows = spark.read.option("header", True).csv(bronze.path("zones")).where(~F.col(f"`{first}`").eqNullSafe(first))
    zones = rows.groupBy(SOURCE).agg(
        *(F.sum((F.col("zone") == z).cast("int")).cast("bigint").alias(f"n_{z}") for z in ("archive", "reject")))
    counts = staged(spark, bronze).groupBy(SOURCE).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_staged"),
        F.sum(F.col(MALFORMED).cast("int")).cast("bigint").alias("n_malformed"))
    out = read_table(spark, bronze.path("contract")).join(counts, SOURCE, "left").join(zones, SOURCE, "left")

    def or_none(c):
        return F.coalesce(c, F.lit(0).cast("long"))
    return out.select(SOURCE, "contract_ok", or_none("n_staged").alias("n_staged"),
                      or_none("n_malformed").alias("n_malformed"), or_none("n_archive").alias("n_archived"),
                      or_none("n_reject").alias("n_rejected"))
