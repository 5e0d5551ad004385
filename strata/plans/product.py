"""Product dimension: SKU level -> exceptions -> 4-hop hierarchy flatten ->
surrogate key -> gold labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import row_hash, stable_key
from strata.functions.predicates import first_reason
from strata.functions.text import label
from strata.operators.hierarchy import flatten_hierarchy, level_rows

SKU_LEVEL = "Product_SKU"
LEVELS = ("Pack", "Brand", "House", "Group")
ATTRS = ("Traded_Unit", "Outers_Per_Traded_Unit", "Sticks_Per_Traded_Unit",
         "Packs_Per_Traded_Unit", "Grams_Per_Traded_Unit")
ROOT_IDS = ("ROOT",)

# Fixed values that must equal the reference's exception reasons.
REASON_LEVEL_MISSING = "Product_Level is missing"
REASON_DESC_MISSING = "Product_Desc is missing"
REASON_CODE_MISSING = "Product_Code is missing"
REASON_PARENT_MISSING = "Par_Row_Id is missing"
REASON_ROOT_PARENT = "Not able to achieve next hierarchy"


def sku_rows(nodes: DataFrame) -> DataFrame:
    return level_rows(nodes, "Product_Level", SKU_LEVEL)


def sku_tagged(nodes: DataFrame) -> DataFrame:
    rules = [
        (REASON_DESC_MISSING, F.col("Product_Desc").isNull()),
        (REASON_CODE_MISSING, F.col("Product_Code").isNull()),
        (REASON_LEVEL_MISSING, F.col("Product_Level").isNull()),
        (REASON_PARENT_MISSING, F.col("Par_Row_Id").isNull()),
        (REASON_ROOT_PARENT, F.col("Par_Row_Id").isin(list(ROOT_IDS))),
    ]
    return sku_rows(nodes).withColumn("exception_reason", first_reason(rules))


def exceptions(nodes: DataFrame) -> DataFrame:
    """Nodes without a level, plus SKUs failing a rule (first reason wins)."""
    no_level = nodes.filter(F.col("Product_Level").isNull()) \
                    .withColumn("exception_reason", F.lit(REASON_LEVEL_MISSING))
    bad_skus = sku_tagged(nodes).filter(F.col("exception_reason").isNotNull())
    return no_level.unionByName(bad_skus)


def all_exceptions(nodes: DataFrame) -> DataFrame:
    """Rule exceptions plus the SKUs whose hierarchy breaks off: with product
    silver, every SKU is in exactly one of the two tables."""
    broken = incomplete(nodes).select(F.col("SourceSystemSKUId").alias("_id"), "exception_reason").distinct()
    skus = sku_rows(nodes)
    return exceptions(nodes).unionByName(
        skus.join(broken, skus["Source_System_Id"] == broken["_id"]).drop("_id"))


# Level each hop must reach when the optional level check is on.
EXPECTED_LEVELS = {"Pack": "Product_Pack", "Brand": "Product_Brand",
                   "House": "Product_House", "Group": "Product_Group"}


def flattened(nodes: DataFrame, check_levels: bool = False) -> DataFrame:
    valid = sku_tagged(nodes).filter(F.col("exception_reason").isNull()).select(
        F.col("Source_System_Id").alias("SourceSystemSKUId"),
        F.col("Product_Code").alias("SkuCode"), F.col("Product_Desc").alias("SkuDesc"),
        "Par_Row_Id", *ATTRS)
    return flatten_hierarchy(valid, nodes, id_col="Source_System_Id", parent_col="Par_Row_Id",
                             levels=LEVELS, attrs={"Product_Code": "Code", "Product_Desc": "Desc"},
                             level_col="Product_Level" if check_levels else None,
                             expected_levels=EXPECTED_LEVELS if check_levels else None) \
        .drop("Par_Row_Id")


HIERARCHY_COLS = ["SourceSystemSKUId", "SkuCode", "SkuDesc"] + \
    [f"{lv}{a}" for lv in LEVELS for a in ("Code", "Desc")]


def complete(nodes: DataFrame) -> DataFrame:
    return flattened(nodes).filter(F.col("incomplete_at").isNull()).drop("incomplete_at")


def incomplete(nodes: DataFrame) -> DataFrame:
    f = flattened(nodes).filter(F.col("incomplete_at").isNotNull())
    return f.select("SourceSystemSKUId", "SkuCode", "incomplete_at",
                    F.concat(F.lit("hierarchy incomplete at "), F.col("incomplete_at")).alias("exception_reason"))


def silver(nodes: DataFrame) -> DataFrame:
    c = complete(nodes)
    return c.withColumns({
        "ProductSkey": stable_key("SourceSystemSKUId"),
        "RowHash": row_hash("SkuCode", "SkuDesc", *ATTRS),
    })


def gold(silver_df: DataFrame) -> DataFrame:
    return silver_df.select(
        "ProductSkey", "SourceSystemSKUId", "SkuCode",
        label("SkuCode", "SkuDesc").alias("SKU"),
        "PackCode", label("PackCode", "PackDesc").alias("Packing"),
        "BrandCode", label("BrandCode", "BrandDesc").alias("Brand"),
        "HouseCode", label("HouseCode", "HouseDesc").alias("House"),
        "GroupCode", label("GroupCode", "GroupDesc").alias("ProductGroup"),
        *ATTRS)
