"""Invoice fact: land -> contract -> gate -> star lookup -> quarantine ->
partition refresh -> retention -> gold contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import occurrence, wide_key
from strata.operators.contract import conform
from strata.operators.quality import REASON, reconcile_rule, required_key_rules, tag_reasons
from strata.operators.refresh import retain
from strata.operators.star import Lookup, resolve_keys
from strata.session import scratch_path
from strata.sources.files import HEADER_OK, MALFORMED, SOURCE, file_contract, header_files, scan_landed, typed_rows
from strata.sources.tables import read_table
from strata.sources.testdata import INVOICE_SOURCE_SCHEMA
from strata.sources.writers import write_table

REASON_HEADER = "header mismatch"
REASON_MALFORMED = "malformed record"
KEY_COLS = ("AccountSkey", "ProductSkey", "TimeSkey")

GOLD_SCHEMA = T.StructType([
    T.StructField("FactInvoiceSkey", T.StringType()),
    T.StructField("AccountSkey", T.LongType()),
    T.StructField("ProductSkey", T.LongType()),
    T.StructField("TimeSkey", T.IntegerType()),
    T.StructField("InvoiceNumber", T.StringType()),
    T.StructField("InvoiceLineItemNumber", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("GrossValue", T.DecimalType(18, 2)),
    T.StructField("NetValue", T.DecimalType(18, 2)),
    T.StructField("VATvalue", T.DecimalType(18, 2)),
])


def bronze(spark: SparkSession, landed: str) -> DataFrame:
    """Raw all-string rows of every landed file (one scan)."""
    return scan_landed(spark, landed, INVOICE_SOURCE_SCHEMA)


def contract(raw: DataFrame) -> DataFrame:
    return file_contract(raw)


def typed(raw: DataFrame, good: DataFrame | None = None) -> DataFrame:
    rows = typed_rows(raw, INVOICE_SOURCE_SCHEMA, good=good)
    return rows.withColumns({
        "Account": F.nullif(F.trim("Account"), F.lit("")),
        "Product": F.nullif(F.trim("Product"), F.lit("")),
    })


def gate_rules():
    return ([(REASON_HEADER, ~F.col(HEADER_OK)), (REASON_MALFORMED, F.col(MALFORMED))]
            + required_key_rules(["Account", "Product"])
            + [reconcile_rule("GrossValue", "NetValue", "VAT")])


def gated(rows: DataFrame) -> DataFrame:
    return tag_reasons(rows, gate_rules())


def stage_batch(dst: str):
    """``foreachBatch`` handler: type and gate one micro-batch of landed rows
    and write it under ``dst/batch=<id>`` partitioned by outcome.  Overwriting
    the batch's own directory makes a replayed batch idempotent.  The headers of
    the batch's files (a row a file) are stored first, so that Spark knows their
    size before it joins the rows with them."""
    def process(batch: DataFrame, batch_id: int) -> None:
        headers = scratch_path(batch.sparkSession, "batch-headers")
        write_table(header_files(batch), headers)
        g = gated(typed(batch, read_table(batch.sparkSession, headers)))
        out = g.withColumn("outcome", F.when(F.col(REASON).isNull(), "valid").otherwise("rejected"))
        write_table(out, f"{dst}/batch={batch_id}", partition_by=["outcome"], clustered=True)
    return process


# The natural key of an invoice line, and what orders lines that share one.
LINE_KEY = ("InvoiceNumber", "LineItem", "Product", "Date")
LINE_ORDER = ("Quantity", "GrossValue", "NetValue", "VAT", "Account")


# Natural keys that occur more than once, up to which they are broadcast.
REPEATED_BROADCAST_ROWS = 500_000


def with_line_key(lines: DataFrame, name: str) -> DataFrame:
    """128-bit key of every line: natural key and occurrence number."""
    return _keyed(lines.withColumn("_occurrence", occurrence(LINE_KEY, LINE_ORDER)), name)


def _keyed(numbered: DataFrame, name: str) -> DataFrame:
    day = F.date_format("Date", "yyyy-MM-dd")
    return (numbered.withColumn(name, wide_key("InvoiceNumber", "LineItem", "Product", day, "_occurrence"))
            .drop("_occurrence"))


def with_occurrence(lines: DataFrame) -> DataFrame:
    """``_occurrence`` of the rows of a stored table.  Hashes of the natural keys tell
    which may occur more than once (equal keys have equal hashes); the window runs
    over the rows of those, any other row is the first of its key.  Where repeats
    are no exception it runs over all rows."""
    spark = lines.sparkSession
    path = scratch_path(spark, "repeated-lines")
    found = (lines.select(F.xxhash64(*LINE_KEY).alias("_line")).groupBy("_line")
             .agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select("_line"))
    write_table(found, path)
    repeated = spark.read.schema(found.schema).parquet(path)
    number = occurrence(LINE_KEY, LINE_ORDER)
    if repeated.count() > REPEATED_BROADCAST_ROWS:
        return lines.withColumn("_occurrence", number)
    hashed = lines.withColumn("_line", F.xxhash64(*LINE_KEY))
    once = hashed.join(F.broadcast(repeated), "_line", "left_anti").withColumn("_occurrence", F.lit(1))
    more = hashed.join(F.broadcast(repeated), "_line", "left_semi").withColumn("_occurrence", number)
    return once.unionByName(more).drop("_line")


def lookup(valid: DataFrame, accounts: DataFrame, products: DataFrame, days: DataFrame,
           clustered: bool = False) -> DataFrame:
    """Resolve the three surrogate keys and shape the silver fact.  ``clustered``
    brings the rows of a month together, before the wide key is made."""
    resolved = resolve_keys(with_occurrence(valid), [
        Lookup(accounts, "Account", "AccountNo", "AccountSkey", "AccountSkey"),
        Lookup(products, "Product", "SkuCode", "ProductSkey", "ProductSkey"),
        Lookup(days, "Date", "Date", "TimeSkey", "TimeSkey"),
    ], spread_by=["InvoiceNumber", "LineItem", "Date"])
    rows = resolved.select(
        "InvoiceNumber", "LineItem", "Product", "_occurrence", "Date", "Quantity", "GrossValue", "NetValue",
        F.col("VAT").alias("VATvalue"), *KEY_COLS,
        F.year("Date").cast("int").alias("Year"), F.month("Date").cast("int").alias("Month"), SOURCE)
    if clustered:
        rows = rows.hint("rebalance", "Year", "Month")
    return _keyed(rows, "FactInvoiceSkey").select(
        "FactInvoiceSkey",
        "InvoiceNumber", "LineItem",
        F.concat("InvoiceNumber", "LineItem").alias("InvoiceLineItemNumber"),
        "Date", "Quantity", "GrossValue", "NetValue", "VATvalue",
        *KEY_COLS, "Year", "Month", SOURCE)


def gold(silver_valid: DataFrame, as_of: str, months: int = 36) -> DataFrame:
    return conform(retain(silver_valid, "Date", months, as_of, year_col="Year", month_col="Month"),
                   GOLD_SCHEMA)


__all__ = ["bronze", "contract", "typed", "gated", "lookup", "gold", "GOLD_SCHEMA", "REASON",
           "KEY_COLS"]
