"""Fixture views over the driver's TPC-H-style tables.

The reference's own inputs (invoice CSVs, account and product extracts) are
re-created from ``lineitem``/``orders``/``customer``/``nation``/``part`` so that
every query's work grows with the tables.  Dirty values are injected
deterministically into *values* (never by dropping rows) so that each quality
rule has cases at every scale.  The same definitions exist as SQL CTEs in
``strata.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEC_MONEY = T.DecimalType(18, 2)

# Fixed parameters of the fixture mapping.
ROOT_ID = "ROOT"
UNKNOWN_GROUP = "G99"
VERSION_EFFECTIVE_YEARS = {0: 1995, 1: 1998, 2: 2000}
CLOSED_AT = "2001-06-30 00:00:00"

# The invoice file layout (header names) of the source system.
INVOICE_SOURCE_SCHEMA = T.StructType([
    T.StructField("Invoice.Number", T.StringType()),
    T.StructField("Line.Item", T.StringType()),
    T.StructField("Date", T.TimestampNTZType()),
    T.StructField("Account", T.StringType()),
    T.StructField("Product", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("Gross.Value", DEC_MONEY),
    T.StructField("Net.Value", DEC_MONEY),
    T.StructField("VAT", DEC_MONEY),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_invoice``: one invoice line per lineitem, in the source system's
    vocabulary, plus the file it arrives in (one file per ship day)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    net4 = (F.col("l_extendedprice").cast("decimal(12,2)")
            * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")
    net = net4.cast(DEC_MONEY)
    vat = (net4 * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,6)").cast(DEC_MONEY)
    k = F.col("l_orderkey")
    return j.select(
        _s(k).alias("InvoiceNumber"),
        F.concat(F.lit("LN"), F.lpad(_s(F.col("l_linenumber")), 3, "0")).alias("LineItem"),
        F.col("l_shipdate").alias("Date"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 89 == 0, F.lit("NA"))
         .otherwise(_s(F.col("o_custkey"))).alias("Account"),
        F.when(k % 83 == 0, F.lit("")).otherwise(_s(F.col("l_partkey"))).alias("Product"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        (net + vat + F.when(k % 79 == 0, F.lit(1)).otherwise(F.lit(0))).cast(DEC_MONEY).alias("GrossValue"),
        net.alias("NetValue"),
        vat.alias("VAT"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("source_file"),
    )


def invoice_source_rows(lines: DataFrame) -> DataFrame:
    """The invoice lines laid out as the source files are (dotted header
    names, ``yyyy-MM-dd`` dates), ready to be landed as CSV.  Some invoices
    arrive with a quantity that is no number."""
    return lines.select(
        F.col("InvoiceNumber").alias("Invoice.Number"),
        F.col("LineItem").alias("Line.Item"),
        F.date_format("Date", "yyyy-MM-dd").alias("Date"),
        "Account", "Product",
        F.when(F.col("InvoiceNumber").cast("bigint") % 73 == 0, F.lit("many"))
         .otherwise(_s(F.col("Quantity"))).alias("Quantity"),
        F.col("GrossValue").alias("Gross.Value"),
        F.col("NetValue").alias("Net.Value"),
        "VAT", "source_file")


def header_variants(rows: DataFrame) -> dict[str, DataFrame]:
    """``invoice_source_rows`` split by the day of the month of their file:
    files with two header names swapped, with an extra and with a missing
    column, and good ones."""
    kind = F.substring("source_file", 9, 2).cast("int") % 10
    parts = {name: rows.where(kind == i) for i, name in enumerate(("swapped", "extra", "missing"))}
    swap = {"Account": "Product", "Product": "Account"}
    return {
        "swapped": parts["swapped"].select(*[F.col(f"`{c}`").alias(swap.get(c, c)) for c in rows.columns]),
        "extra": parts["extra"].withColumn("Extra", F.lit("x")),
        "missing": parts["missing"].drop("VAT"),
        "good": rows.where(kind > 2),
    }


def _raw_desc(name: Column, key: Column) -> Column:
    """Version-0 spelling of a customer name: every third one arrives in
    lower case with stray spaces and a legal suffix."""
    return F.when(key % 3 == 0,
                  F.concat(F.lit("  "), F.lower(name), F.lit("   inc."))).otherwise(name)


def account_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_account``: three extracts (versions 0..2) of the account source.

    Group rows come from ``nation`` (no parent, no dates) and are present in
    every extract; account rows come from ``customer`` with the first order
    date as opening date.  Version 0 holds customers with key % 5 <> 0;
    version 1 brings new customers (key % 5 = 0) and renamed ones (key % 11 =
    0); version 2 renames key % 33 = 0 again and closes key % 13 = 0."""
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    first_order = (table(spark, sf_dir, "orders")
                   .groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order")))
    groups = nation.select(
        F.concat(F.lit("N"), _s(F.col("n_nationkey"))).alias("RowId"),
        F.concat(F.lit("G"), _s(F.col("n_nationkey"))).alias("AccountNo"),
        F.col("n_name").alias("AccountDesc"),
        F.lit(None).cast("string").alias("ParentRowId"),
        F.lit(None).cast("timestamp_ntz").alias("DateOpened"),
        F.lit(None).cast("timestamp_ntz").alias("DateClosed"),
        F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("version"),
    )
    k = F.col("c_custkey")
    base = customer.join(first_order, customer.c_custkey == first_order.o_custkey, "left")
    raw = _raw_desc(F.col("c_name"), k)
    member_of = F.array_compact(F.array(
        F.when(k % 5 != 0, F.lit(0)),
        F.when((k % 5 == 0) | (k % 11 == 0), F.lit(1)),
        F.when((k % 33 == 0) | (k % 13 == 0), F.lit(2))))
    children = base.select("*", F.explode(member_of).alias("version"))
    v = F.col("version")
    desc = (F.when(v == 0, raw)
            .when(v == 1, F.when(k % 11 == 0, F.concat(F.col("c_name"), F.lit(" Global"))).otherwise(raw))
            .otherwise(F.when(k % 33 == 0, F.concat(F.col("c_name"), F.lit(" Holdings inc."))).otherwise(raw)))
    children = children.select(
        F.concat(F.lit("C"), _s(k)).alias("RowId"),
        _s(k).alias("AccountNo"),
        desc.alias("AccountDesc"),
        F.when(k % 37 == 0, F.lit(None).cast("string"))
         .when(k % 41 == 0, F.lit(UNKNOWN_GROUP))
         .otherwise(F.concat(F.lit("G"), _s(F.col("c_nationkey")))).alias("ParentRowId"),
        F.col("first_order").alias("DateOpened"),
        F.when((v == 2) & (k % 13 == 0), F.lit(CLOSED_AT).cast("timestamp_ntz"))
         .otherwise(F.lit(None).cast("timestamp_ntz")).alias("DateClosed"),
        v.alias("version"),
    )
    return groups.unionByName(children)


def version_effective(version: Column) -> Column:
    """Load time of an extract: 1995-01-01, 1998-01-01, 2000-01-01."""
    year = (F.when(version == 0, F.lit(VERSION_EFFECTIVE_YEARS[0]))
            .when(version == 1, F.lit(VERSION_EFFECTIVE_YEARS[1]))
            .otherwise(F.lit(VERSION_EFFECTIVE_YEARS[2])))
    return F.make_date(year, F.lit(1), F.lit(1)).cast("timestamp_ntz")


def product_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_product``: the product adjacency list (SKU -> Pack -> Brand ->
    House -> Group -> ROOT).  SKUs are parts; packs are brand x type; houses
    are brand number mod 5; groups are house mod 2.  SKUs get a missing level
    (key % 101 = 0), a missing parent (% 53), the root as parent (% 59), an
    unknown parent (% 61) or a parent of the wrong level (% 67: the brand,
    skipping the pack)."""
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    brand_no = F.substring("p_brand", 7, 10).cast("int")
    pack_id = F.concat(F.lit("P"), F.col("p_brand"), F.lit("|"), F.col("p_type"))
    null_s = F.lit(None).cast("string")
    null_i = F.lit(None).cast("int")
    null_d = F.lit(None).cast("double")

    def node(df, sid, code, desc, level, parent):
        return df.select(sid.alias("Source_System_Id"), code.alias("Product_Code"),
                         desc.alias("Product_Desc"), level.alias("Product_Level"),
                         parent.alias("Par_Row_Id"), null_s.alias("Traded_Unit"),
                         null_i.alias("Sticks_Per_Traded_Unit"),
                         null_i.alias("Packs_Per_Traded_Unit"),
                         null_i.alias("Outers_Per_Traded_Unit"),
                         null_d.alias("Grams_Per_Traded_Unit"))

    skus = part.select(
        F.concat(F.lit("S"), _s(k)).alias("Source_System_Id"),
        _s(k).alias("Product_Code"),
        F.col("p_name").alias("Product_Desc"),
        F.when(k % 101 == 0, null_s).otherwise(F.lit("Product_SKU")).alias("Product_Level"),
        F.when(k % 53 == 0, null_s)
         .when(k % 59 == 0, F.lit(ROOT_ID))
         .when(k % 61 == 0, F.concat(F.lit("PX"), _s(k)))
         .when(k % 67 == 0, F.concat(F.lit("B"), F.col("p_brand")))
         .otherwise(pack_id).alias("Par_Row_Id"),
        F.when(F.col("p_size") > 25, F.lit("CASE")).otherwise(F.lit("CARTON")).alias("Traded_Unit"),
        (F.col("p_size") * 10).cast("int").alias("Sticks_Per_Traded_Unit"),
        F.col("p_size").cast("int").alias("Packs_Per_Traded_Unit"),
        (F.col("p_size") % 4 + 1).cast("int").alias("Outers_Per_Traded_Unit"),
        F.col("p_retailprice").cast("double").alias("Grams_Per_Traded_Unit"),
    )
    packs = node(part.select("p_brand", "p_type").distinct(),
                 pack_id, F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")),
                 F.concat(F.col("p_type"), F.lit(" pack")), F.lit("Product_Pack"),
                 F.concat(F.lit("B"), F.col("p_brand")))
    brands_src = part.select("p_brand").distinct()
    brands = node(brands_src, F.concat(F.lit("B"), F.col("p_brand")), F.col("p_brand"),
                  F.concat(F.lit("Brand "), _s(brand_no)), F.lit("Product_Brand"),
                  F.concat(F.lit("H"), _s(brand_no % 5)))
    houses_src = brands_src.select((brand_no % 5).alias("h")).distinct()
    h = F.col("h")
    houses = node(houses_src, F.concat(F.lit("H"), _s(h)), F.concat(F.lit("HOUSE"), _s(h)),
                  F.concat(F.lit("House "), _s(h)), F.lit("Product_House"),
                  F.concat(F.lit("GR"), _s(h % 2)))
    groups_src = houses_src.select((h % 2).alias("g")).distinct()
    g = F.col("g")
    groups = node(groups_src, F.concat(F.lit("GR"), _s(g)), F.concat(F.lit("GROUP"), _s(g)),
                  F.concat(F.lit("Group "), _s(g)), F.lit("Product_Group"), F.lit(ROOT_ID))
    root = node(groups_src.select(F.lit(1).alias("r")).distinct(), F.lit(ROOT_ID), F.lit(ROOT_ID),
                F.lit("All products"), F.lit("Product_Root"), null_s)
    return skus.unionByName(packs).unionByName(brands).unionByName(houses) \
        .unionByName(groups).unionByName(root)


def referrals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_referral``: which account brought which, a ragged adjacency list.  A
    customer was referred by the one before (chains of up to about a hundred);
    every 97th by nobody, every 101st by an account that is not listed, and every
    89th by one three numbers later, which closes a ring unless a top lies between."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), _s(k)).alias("node"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 101 == 0, F.concat(F.lit("X"), _s(k)))
         .when(k % 89 == 0, F.concat(F.lit("A"), _s(k + 3)))
         .otherwise(F.concat(F.lit("A"), _s(k - 1))).alias("parent"))


ACCOUNT_SOURCE_SCHEMA = T.StructType([
    *(T.StructField(c, T.StringType()) for c in ("RowId", "AccountNo", "AccountDesc", "ParentRowId")),
    T.StructField("DateOpened", T.TimestampNTZType()), T.StructField("DateClosed", T.TimestampNTZType())])

PRODUCT_SOURCE_SCHEMA = T.StructType([
    *(T.StructField(c, T.StringType()) for c in (
        "Source_System_Id", "Product_Code", "Product_Desc", "Product_Level", "Par_Row_Id", "Traded_Unit")),
    *(T.StructField(f"{c}_Per_Traded_Unit", T.IntegerType()) for c in ("Sticks", "Packs", "Outers")),
    T.StructField("Grams_Per_Traded_Unit", T.DoubleType())])


def account_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The account extracts as they arrive, a source file a version, and two that
    break the contract: ``accountv3`` has two names swapped, ``accountv4`` a column
    too many."""
    rows = account_versions(spark, sf_dir)
    good = rows.withColumn("source_file", F.concat(F.lit("accountv"), _s(F.col("version")))).drop("version")
    last = rows.where("version = 2").drop("version")
    swap = {"AccountNo": "AccountDesc", "AccountDesc": "AccountNo"}
    return {
        "good": good,
        "swapped": last.select(*(F.col(c).alias(swap.get(c, c)) for c in last.columns)).withColumn(
            "source_file", F.lit("accountv3")),
        "extra": last.withColumns({"Region": F.lit("x"), "source_file": F.lit("accountv4")}),
    }


def product_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The product list as it arrives, an update in which every 43rd SKU has a
    count that is no number, and an older layout without its last column."""
    rows = product_nodes(spark, sf_dir)
    code = F.col("Product_Code").try_cast("bigint")
    update = rows.where(code.isNotNull()).withColumn(
        "Packs_Per_Traded_Unit", F.when(code % 43 == 0, F.lit("a few")).otherwise(_s(F.col("Packs_Per_Traded_Unit"))))
    return {
        "good": rows.withColumn("source_file", F.lit("product")),
        "update": update.withColumn("source_file", F.lit("product_update")),
        "missing": rows.drop("Grams_Per_Traded_Unit").withColumn("source_file", F.lit("product_old")),
    }
