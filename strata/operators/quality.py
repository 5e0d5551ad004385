"""Quality rules with reasons, row/file gates, quarantine and conservation.

A rule is ``(reason, predicate)``; the first rule that holds names the reason.
Valid and rejected rows come from one flagged frame, so the rules run once;
writers persist both sides from that frame (or write it once partitioned by
outcome) instead of filtering the input twice.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.predicates import all_present, any_missing, blank, first_reason, is_sentinel

Rule = tuple[str, Column]
REASON = "reason"
# Per-file verdicts are (file id, flag) rows: up to this many are broadcast.
MAX_BROADCAST_FILES = 500_000


def tag_reasons(df: DataFrame, rules: Sequence[Rule], reason_col: str = REASON) -> DataFrame:
    return df.withColumn(reason_col, first_reason(rules))


def split_valid(tagged: DataFrame, reason_col: str = REASON) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of a frame tagged by ``tag_reasons``."""
    return (tagged.filter(F.col(reason_col).isNull()).drop(reason_col),
            tagged.filter(F.col(reason_col).isNotNull()))


def required_key_rules(cols: Sequence[str], sentinels: Sequence[str] = ("NA",)) -> list[Rule]:
    """Blank and sentinel checks for dimension key columns (the reference's
    gate: a blank or 'NA' account or product)."""
    rules: list[Rule] = []
    for c in cols:
        rules.append((f"{c} is blank", blank(c)))
        rules.append((f"{c} is {'/'.join(sentinels)}", is_sentinel(c, sentinels)))
    return rules


def reconcile_rule(gross: str, net: str, vat: str, tolerance: str = "0.01") -> Rule:
    """Gross must equal net + VAT (within a tolerance) when all three exist."""
    diff = F.abs(F.col(gross) - (F.col(net) + F.col(vat)))
    return ("amounts do not reconcile", diff > F.lit(tolerance).cast("decimal(18,2)"))


def gate(df: DataFrame, rules: Sequence[Rule], granularity: str = "row",
         file_col: str = "source_file", reason_col: str = REASON,
         max_files: int | None = None) -> DataFrame:
    """Tag rows with the first failing rule.

    ``granularity="row"`` rejects only failing rows.  ``"file"`` reproduces the
    reference's policy: one failing row rejects every row of its file.  The
    per-file verdict is a partial aggregate (cheap even when one file holds a
    third of all rows) joined back; it is broadcast only when ``max_files``
    (e.g. the length of the input listing) proves it small, otherwise the join
    is a shuffle join whose hot file AQE splits."""
    tagged = tag_reasons(df, rules, reason_col)
    if granularity == "row":
        return tagged
    if granularity != "file":
        raise ValueError(f"granularity must be 'row' or 'file', not {granularity!r}")
    return file_policy(tagged, reason_col, file_col, max_files)


def _with_file_verdict(tagged: DataFrame, reason_col: str, file_col: str,
                       max_files: int | None, hot_file_rows: int | None) -> DataFrame:
    """``tagged`` plus ``_file_bad`` (1 when any row of the file failed).
    Broadcast join when ``max_files`` bounds the verdicts, else a shuffle join
    with hot files salted."""
    from strata.operators.star import HOT_KEY_ROWS, SALT_BUCKETS, salted_left_join
    verdict = (tagged.groupBy(file_col)
               .agg(F.max(F.col(reason_col).isNotNull().cast("int")).alias("_file_bad")))
    if max_files is not None and max_files <= MAX_BROADCAST_FILES:
        return tagged.join(F.broadcast(verdict), file_col, "left")
    v = verdict.select(F.col(file_col).alias("_vf"), "_file_bad")
    return salted_left_join(tagged, file_col, v, "_vf", tagged.columns,
                            hot_file_rows or HOT_KEY_ROWS, SALT_BUCKETS).drop("_vf")


def file_policy(tagged: DataFrame, reason_col: str = REASON, file_col: str = "source_file",
                max_files: int | None = None, hot_file_rows: int | None = None) -> DataFrame:
    """Whole-file rejection over rows that already carry a row-level reason
    (e.g. the columnar staged table, so the raw text is parsed only once):
    every row of a file with a failing row gets "file rejected".

    The per-file verdicts are broadcast when ``max_files`` proves them few;
    otherwise the join is a shuffle join in which files holding at least
    ``hot_file_rows`` rows are salted over several tasks."""
    joined = _with_file_verdict(tagged, reason_col, file_col, max_files, hot_file_rows)
    return joined.withColumn(
        reason_col,
        F.when(F.col(reason_col).isNotNull(), F.col(reason_col))
         .when(F.col("_file_bad") == 1, F.lit("file rejected"))
    ).select(*tagged.columns)


def split_unresolved(fact: DataFrame, key_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, exception): a fact row with any unresolved surrogate key is an
    exception."""
    return fact.filter(all_present(key_cols)), fact.filter(any_missing(key_cols))


def conservation(n_input: Column, n_valid: Column, n_rejected: Column) -> Column:
    """input = valid + rejected."""
    return n_input == n_valid + n_rejected


def route_files(tagged: DataFrame, reason_col: str = REASON, file_col: str = "source_file",
                zone_col: str = "zone", max_files: int | None = None) -> DataFrame:
    """Whole-file routing (archive vs reject) as data: every row gets the zone
    of its file — ``reject`` when any row of the file failed a rule, else
    ``archive``.  Writing the result partitioned by zone replaces moving files
    between directories; the file identity stays a column."""
    return (_with_file_verdict(tagged, reason_col, file_col, max_files, None)
            .withColumn(zone_col, F.when(F.col("_file_bad") == 1, F.lit("reject")).otherwise(F.lit("archive")))
            .drop("_file_bad"))


# ---- all violations of a row, and what they mean for its file

def violations(rules: Sequence[Rule]) -> Column:
    """Bitmap of the rules that a row violates: bit i for the i-th rule (63 rules
    at most; a rule that is null for a row is not violated)."""
    if len(rules) > 63:
        raise ValueError("at most 63 rules fit a bitmap")
    bits = F.lit(0).cast("long")
    for i, (_, broken) in enumerate(rules):
        bits = bits + F.when(broken, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return bits


def _has(bitmap: str, bit: int) -> Column:
    return F.expr(f"{bitmap} & {1 << bit}L") != 0


def violation_report(tagged: DataFrame, rules: Sequence[Rule], bitmap: str = "violations",
                     file_col: str = "source_file") -> DataFrame:
    """(file, rule, n_rows, n_violations) for every rule, zeros included, from the
    bitmaps in one aggregate over the files (map-side combined)."""
    counts = [F.sum(_has(bitmap, i).cast("int")).cast("bigint").alias(f"_v{i}") for i in range(len(rules))]
    per_file = tagged.groupBy(file_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), *counts)
    return per_file.select(file_col, "n_rows", F.inline(F.array(*(
        F.struct(F.lit(reason).alias("rule"), F.col(f"_v{i}").alias("n_violations"))
        for i, (reason, _) in enumerate(rules)))))


def file_verdicts(tagged: DataFrame, rules: Sequence[Rule], max_percent: int, fatal: Sequence[str] = (),
                  bitmap: str = "violations", file_col: str = "source_file") -> DataFrame:
    """One row a file: n_rows, n_bad (rows with a violation), n_fatal (rows that
    violate one of the rules ``fatal``) and accepted, which holds when no row is
    fatal and at most ``max_percent`` of the rows are bad.  With 0 any bad row
    rejects the file; with 100 only a fatal one does."""
    names = [reason for reason, _ in rules]
    unknown = set(fatal) - set(names)
    if unknown:
        raise ValueError(f"no such rules: {sorted(unknown)}")
    deadly = F.lit(False)
    for reason in fatal:
        deadly = deadly | _has(bitmap, names.index(reason))
    n_bad, n_fatal = F.sum((F.col(bitmap) != 0).cast("int")), F.sum(deadly.cast("int"))
    return tagged.groupBy(file_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), n_bad.cast("bigint").alias("n_bad"),
        n_fatal.cast("bigint").alias("n_fatal"),
        ((n_fatal == 0) & (100 * n_bad <= max_percent * F.count(F.lit(1)))).alias("accepted"))
