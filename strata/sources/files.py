"""CSV ingestion with a real header contract, in one scan.

All files of a source are read by **one** scan (a directory, glob or list of
paths) with every column as a string, ``header=False`` and a corrupt-record
column.  Each row knows its file through ``_metadata.file_path``.  Header rows
are recognised as data: a physical file honours the contract iff its first row
equals the expected header with no extra or missing fields; a source (a
``source_file=...`` directory or one file) iff all of its physical files do.  A file
without a row shows in no scan; ``empty_files`` finds it by its size.  Typed values come from
``try_cast`` so a malformed cell becomes null and the row is flagged, instead of
failing the job (ANSI mode is on in Spark 4).

Nothing is listed or looped over on the driver; per-file facts are aggregates
over ``source_file``.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import normalize_name

CORRUPT = "_corrupt_record"
SOURCE = "source_file"
PATH = "_source_path"
IS_HEADER = "_is_header"
ORDER = "_row_order"
HEADER_OK = "_header_ok"
MALFORMED = "_malformed"


def source_id(path: Column, root: str | None = None) -> Column:
    """Identity of a source file: the value of a ``source_file=...`` directory
    when the files were landed partitioned, else the path below ``root`` (the
    whole path without one) and without its extension, so equal names in two
    folders stay apart."""
    from_dir = F.regexp_extract(path, r"source_file=([^/]+)/", 1)
    below = path
    if root and not any(c in root for c in "*?[{"):
        base = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/+", "/", root).rstrip("/") + "/"
        at = F.locate(base, path)
        below = F.when(at > 0, F.substring(path, at + len(base), F.length(path))).otherwise(path)
    from_name = F.regexp_replace(below, r"\.[^./]*$|\.csv\.gz$", "")
    return F.when(from_dir != "", from_dir).otherwise(from_name)


def landed_string_schema(expected: T.StructType) -> T.StructType:
    """Every declared column as a string, plus the corrupt-record column."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in expected.fields]
                        + [T.StructField(CORRUPT, T.StringType())])


def landed_projection(raw: DataFrame, expected: T.StructType, root: str | None = None) -> DataFrame:
    """Columns of an all-string scan plus ``source_file``, the physical file's
    path and ``_is_header``; shared by the batch scan and the streaming ingest."""
    names = [f.name for f in expected.fields]
    header_match = F.lit(True)
    for n in names:
        header_match = header_match & F.col(f"`{n}`").eqNullSafe(F.lit(n))
    return raw.select(
        *[F.col(f"`{n}`") for n in names],
        F.col(CORRUPT),
        source_id(F.col("_metadata.file_path"), root).alias(SOURCE),
        F.col("_metadata.file_path").alias(PATH),
        (header_match & F.col(CORRUPT).isNull()).alias(IS_HEADER),
        # Rows of a file in their order: its splits by their start, a split's rows as read.
        *([F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"))
           .alias(ORDER)] if not raw.isStreaming else []),
    )


# Names of landed files: plain or packed.
CSV_FILES = "*.{csv,csv.gz}"
CSV_OPTIONS = {"header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def scan_landed(spark: SparkSession, paths: str | Sequence[str],
                expected: T.StructType, glob: str | None = CSV_FILES) -> DataFrame:
    """All-string scan of every file; adds ``source_file`` and ``_is_header``.
    ``glob`` keeps only matching file names (the reference's suffix filter)."""
    raw = (spark.read.schema(landed_string_schema(expected))
           .options(**CSV_OPTIONS)
           .option("recursiveFileLookup", True)
           .options(**({"pathGlobFilter": glob} if glob else {}))
           .csv(paths if isinstance(paths, str) else list(paths)))
    return landed_projection(raw, expected, paths if isinstance(paths, str) else None)


def empty_files(raw: DataFrame, root: str) -> DataFrame:
    """``source_file`` and path of the scan's files that gave no row (an empty file
    shows in no row).  The names come from the scan's own listing, which the
    driver holds anyway; they are compared as a table."""
    spark = raw.sparkSession
    listed = spark.createDataFrame([(path,) for path in raw.inputFiles()], f"{PATH} string")

    def spelling(path: str) -> Column:      # file:/x and file:///x are one file
        return F.regexp_replace(path, "^([a-zA-Z][a-zA-Z0-9+.-]*):/+", "$1:/").alias("_file")
    seen = raw.select(spelling(PATH)).distinct()
    return (listed.withColumn("_file", spelling(PATH)).join(seen, "_file", "left_anti")
            .select(source_id(F.col(PATH), root).alias(SOURCE), PATH))


def file_headers(raw: DataFrame) -> DataFrame:
    """One row a physical file, from which the contract and the header verdicts are
    taken (store it where both are needed): ``_ok``, whether its first row is the header (a stream
    does not know the order of rows: there a header anywhere counts), and ``_n``, its
    other rows.  A file's splits are reduced first, so that every buffer holds plain
    numbers and the rows are hashed, not sorted."""
    n = F.sum(F.when(F.col(IS_HEADER), 0).otherwise(1)).alias("_n")
    if ORDER not in raw.columns:
        return raw.groupBy(SOURCE, PATH).agg(F.max(F.col(IS_HEADER).cast("int")).alias("_ok"), n)
    splits = raw.groupBy(SOURCE, PATH, F.col(f"{ORDER}.at").alias("_at")).agg(
        F.min_by(F.col(IS_HEADER).cast("int"), F.col(f"{ORDER}.id")).alias("_first"), n)
    return splits.groupBy(SOURCE, PATH).agg(F.min_by("_first", "_at").alias("_ok"), F.sum("_n").alias("_n"))


def file_contract(raw: DataFrame, empty: DataFrame | None = None) -> DataFrame:
    """Per source: does every physical file begin with exactly the expected header,
    and how many other rows are there.  ``empty`` adds the files without a row (see
    ``empty_files``), which honour no contract.  Partial aggregates, so a file
    holding a large share of all rows costs no more than any other."""
    return contract_of_files(file_headers(raw), empty)


def contract_of_files(files: DataFrame, empty: DataFrame | None = None) -> DataFrame:
    """``file_contract`` from stored ``file_headers``."""
    if empty is not None:
        files = files.unionByName(empty.select(
            SOURCE, PATH, F.lit(0).alias("_ok"), F.lit(0).cast("long").alias("_n")))
    return (files.groupBy(SOURCE)
            .agg(F.min("_ok").cast("boolean").alias("contract_ok"),
                 F.sum("_n").cast("bigint").alias("n_rows")))


def header_files(raw: DataFrame) -> DataFrame:
    """The physical files that begin with the expected header, one row each."""
    return good_files(file_headers(raw))


def good_files(files: DataFrame) -> DataFrame:
    """``header_files`` from stored ``file_headers``."""
    return files.filter(F.col("_ok") == 1).select(PATH)


def with_header_verdict(raw: DataFrame, good: DataFrame | None = None) -> DataFrame:
    """Adds ``_header_ok``: whether the row's physical file has the header.
    ``good`` is the stored ``header_files`` (without it, ``raw`` is read a second
    time).  It has one row a file; no hint is given, so Spark broadcasts it only
    while it is small."""
    good = (header_files(raw) if good is None else good).withColumn(HEADER_OK, F.lit(True))
    return raw.join(good, PATH, "left").withColumn(HEADER_OK, F.coalesce(HEADER_OK, F.lit(False)))


def typed_rows(raw: DataFrame, expected: T.StructType,
               rename: bool = True, good: DataFrame | None = None) -> DataFrame:
    """Data rows of a landed scan, cast to the declared types.

    Header rows are dropped; ``_header_ok`` says whether the row's file has the
    header (a gate rejects the rows of those without it); a row is ``_malformed`` when the parser flagged it
    or a non-blank cell did not cast.  Names are normalised (dots removed) once
    here so nothing downstream needs back-quotes."""
    body = with_header_verdict(raw, good).filter(~F.col(IS_HEADER))
    cols: list[Column] = []
    bad = F.col(CORRUPT).isNotNull()
    for f in expected.fields:
        src = F.col(f"`{f.name}`")
        out = normalize_name(f.name) if rename else f.name
        if isinstance(f.dataType, T.StringType):
            cols.append(src.alias(out))
            continue
        text = F.nullif(F.trim(src), F.lit(""))
        typed = F.try_cast(text, f.dataType) if hasattr(F, "try_cast") else text.try_cast(f.dataType)
        cols.append(typed.alias(out))
        bad = bad | (text.isNotNull() & typed.isNull() & ~text.isin("NA"))
    return body.select(*cols, F.col(SOURCE), F.col(HEADER_OK), bad.alias(MALFORMED))
