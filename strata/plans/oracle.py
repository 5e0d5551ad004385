"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The fixture views and pipeline stages are CTEs; each query names the CTEs it
needs and the transitive closure is emitted in definition order.
"""

from __future__ import annotations


def _key(*parts: str) -> str:
    """SQL form of ``strata.functions.keys.stable_key``."""
    return f"CAST(('0x' || substr({_wide_key(*parts)}, 1, 15)) AS BIGINT)"


def _wide_key(*parts: str) -> str:
    """SQL form of ``strata.functions.keys.wide_key``."""
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    marked = " || ".join(f"coalesce('V' || CAST(length({t}) AS VARCHAR) || ':' || {t}, 'N')" for t in texts)
    return f"md5({marked})"


def _line_key(t: str) -> str:
    """SQL form of ``strata.plans.invoice.with_line_key`` over columns of ``t``."""
    key = ", ".join(f"{t}.{c}" for c in ("InvoiceNumber", "LineItem", "Product", "Date"))
    order = ", ".join(f"{t}.{c} NULLS FIRST" for c in ("Quantity", "GrossValue", "NetValue", "VAT", "Account"))
    return _wide_key(f"{t}.InvoiceNumber", f"{t}.LineItem", f"{t}.Product", f"strftime({t}.Date, '%Y-%m-%d')",
                     f"row_number() OVER (PARTITION BY {key} ORDER BY {order})")


def _clean(c: str) -> str:
    return (f"regexp_replace(regexp_replace(trim(upper({c})), '\\s+', ' ', 'g'), "
            f"'\\s*INC\\.$', ' INC', 'g')")


_NET4 = ("CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))"
         " AS DECIMAL(18,4))")
_BRANDNO = "CAST(substr(p_brand, 7, 10) AS INTEGER)"
_ATTRS = ("Traded_Unit, Outers_Per_Traded_Unit, Sticks_Per_Traded_Unit, "
          "Packs_Per_Traded_Unit, Grams_Per_Traded_Unit")
_NULL_ATTRS = ("CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), "
               "CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE)")

# name -> (deps, body); definition order is dependency order.
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


_cte("fx_invoice", (), f"""
SELECT CAST(l.l_orderkey AS VARCHAR) AS InvoiceNumber,
       'LN' || lpad(CAST(l.l_linenumber AS VARCHAR), 3, '0') AS LineItem,
       l.l_shipdate AS Date,
       CASE WHEN l.l_orderkey % 97 = 0 THEN NULL WHEN l.l_orderkey % 89 = 0 THEN 'NA'
            ELSE CAST(o.o_custkey AS VARCHAR) END AS Account,
       CASE WHEN l.l_orderkey % 83 = 0 THEN '' ELSE CAST(l.l_partkey AS VARCHAR) END AS Product,
       CAST(l.l_quantity AS INTEGER) AS Quantity,
       CAST(CAST({_NET4} AS DECIMAL(18,2)) + CAST(CAST({_NET4} * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(18,6)) AS DECIMAL(18,2))
            + CASE WHEN l.l_orderkey % 79 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS GrossValue,
       CAST({_NET4} AS DECIMAL(18,2)) AS NetValue,
       CAST(CAST({_NET4} * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(18,6)) AS DECIMAL(18,2)) AS VAT,
       strftime(l.l_shipdate, '%Y-%m-%d') AS source_file
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

_cte("inv_rows", ("fx_invoice",), """
SELECT InvoiceNumber, LineItem, Date, NULLIF(TRIM(Account), '') AS Account,
       NULLIF(TRIM(Product), '') AS Product,
       CASE WHEN CAST(InvoiceNumber AS BIGINT) % 73 = 0 THEN NULL ELSE Quantity END AS Quantity,
       GrossValue, NetValue, VAT, source_file
FROM fx_invoice""")

_cte("inv_gated", ("inv_rows",), """
SELECT *, CASE
    WHEN CAST(InvoiceNumber AS BIGINT) % 73 = 0 THEN 'malformed record'
    WHEN Account IS NULL OR TRIM(Account) = '' THEN 'Account is blank'
    WHEN TRIM(Account) IN ('NA') THEN 'Account is NA'
    WHEN Product IS NULL OR TRIM(Product) = '' THEN 'Product is blank'
    WHEN TRIM(Product) IN ('NA') THEN 'Product is NA'
    WHEN abs(GrossValue - (NetValue + VAT)) > 0.01 THEN 'amounts do not reconcile'
  END AS reason
FROM inv_rows""")

_cte("inv_valid", ("inv_gated",), "SELECT * FROM inv_gated WHERE reason IS NULL")

_cte("routed", ("inv_gated",), """
SELECT *, CASE WHEN max(CASE WHEN reason IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY source_file) = 1
               THEN 'reject' ELSE 'archive' END AS zone
FROM inv_gated""")

_cte("first_order", (), "SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey")

_cte("fx_cust", ("first_order",), """
SELECT c.c_custkey, c.c_name, c.c_nationkey, f.first_order,
       CASE WHEN c.c_custkey % 3 = 0 THEN '  ' || lower(c.c_name) || '   inc.' ELSE c.c_name END AS raw_desc
FROM customer c LEFT JOIN first_order f ON c.c_custkey = f.o_custkey""")

_cte("fx_cust_v", ("fx_cust",), """
SELECT *, 0 AS version FROM fx_cust WHERE c_custkey % 5 <> 0
UNION ALL SELECT *, 1 AS version FROM fx_cust WHERE c_custkey % 5 = 0 OR c_custkey % 11 = 0
UNION ALL SELECT *, 2 AS version FROM fx_cust WHERE c_custkey % 33 = 0 OR c_custkey % 13 = 0""")

_cte("fx_account", ("fx_cust_v",), """
SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS RowId, 'G' || CAST(n_nationkey AS VARCHAR) AS AccountNo,
       n_name AS AccountDesc, CAST(NULL AS VARCHAR) AS ParentRowId,
       CAST(NULL AS TIMESTAMP) AS DateOpened, CAST(NULL AS TIMESTAMP) AS DateClosed,
       CAST(UNNEST([0, 1, 2]) AS INTEGER) AS version
FROM nation
UNION ALL
SELECT 'C' || CAST(c_custkey AS VARCHAR), CAST(c_custkey AS VARCHAR),
       CASE WHEN version = 0 THEN raw_desc
            WHEN version = 1 THEN CASE WHEN c_custkey % 11 = 0 THEN c_name || ' Global' ELSE raw_desc END
            ELSE CASE WHEN c_custkey % 33 = 0 THEN c_name || ' Holdings inc.' ELSE raw_desc END END,
       CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN 'G99'
            ELSE 'G' || CAST(c_nationkey AS VARCHAR) END,
       first_order,
       CASE WHEN version = 2 AND c_custkey % 13 = 0 THEN TIMESTAMP '2001-06-30 00:00:00' END,
       version
FROM fx_cust_v""")

_cte("acc_clean", ("fx_account",), f"""
SELECT RowId, AccountNo, {_clean('AccountDesc')} AS AccountDesc, ParentRowId, DateOpened,
       DateClosed, version
FROM fx_account""")

_cte("acc_groups", ("acc_clean",), """
SELECT * FROM acc_clean WHERE ParentRowId IS NULL AND DateOpened IS NULL AND DateClosed IS NULL""")

_cte("acc_members", ("acc_clean",), """
SELECT *, CASE WHEN RowId IS NULL THEN 'RowId is missing'
               WHEN AccountNo IS NULL THEN 'AccountNo is missing'
               WHEN AccountDesc IS NULL THEN 'AccountDesc is missing'
               WHEN ParentRowId IS NULL THEN 'ParentRowId is missing'
               WHEN DateOpened IS NULL THEN 'DateOpened is missing' END AS exception_reason
FROM acc_clean WHERE NOT (ParentRowId IS NULL AND DateOpened IS NULL AND DateClosed IS NULL)""")

_cte("acc_parents", ("acc_groups",), """
SELECT version, AccountNo, min(AccountDesc) AS AccountDesc FROM acc_groups GROUP BY version, AccountNo""")

_cte("acc_with_parents", ("acc_members", "acc_parents"), """
SELECT m.RowId AS SourceSystemId, m.AccountNo, m.AccountDesc, m.ParentRowId AS PrimaryGroupNo,
       coalesce(p.AccountDesc, 'Unknown') AS PrimaryGroupDesc, m.DateOpened, m.DateClosed, m.version
FROM acc_members m LEFT JOIN acc_parents p ON m.version = p.version AND m.ParentRowId = p.AccountNo
WHERE m.exception_reason IS NULL""")

_cte("acc_lagged", ("acc_with_parents",), """
SELECT *, lag(version) OVER w AS _pv, lag(AccountDesc) OVER w AS _p1, lag(PrimaryGroupNo) OVER w AS _p2,
       lag(DateOpened) OVER w AS _p3, lag(DateClosed) OVER w AS _p4
FROM acc_with_parents WINDOW w AS (PARTITION BY AccountNo ORDER BY version)""")

_cte("acc_kept", ("acc_lagged",), """
SELECT * EXCLUDE (_pv, _p1, _p2, _p3, _p4),
       CAST(make_date(CASE version WHEN 0 THEN 1995 WHEN 1 THEN 1998 ELSE 2000 END, 1, 1) AS TIMESTAMP) AS ValidFrom
FROM acc_lagged
WHERE _pv IS NULL OR AccountDesc IS DISTINCT FROM _p1 OR PrimaryGroupNo IS DISTINCT FROM _p2
   OR DateOpened IS DISTINCT FROM _p3 OR DateClosed IS DISTINCT FROM _p4""")

_cte("acc_silver", ("acc_kept",), f"""
SELECT *, CASE WHEN ValidTo IS NULL THEN 1 ELSE 0 END AS isActive,
       CASE WHEN DateClosed IS NOT NULL THEN 0 ELSE 1 END AS AccountStatus,
       {_key('AccountNo', 'version')} AS AccountSkey
FROM (SELECT *, lead(ValidFrom) OVER (PARTITION BY AccountNo ORDER BY version) AS ValidTo FROM acc_kept)""")

_cte("acc_gold", ("acc_silver",), """
SELECT concat_ws('-', AccountNo, AccountDesc) AS Account,
       concat_ws('-', PrimaryGroupNo, PrimaryGroupDesc) AS AccountGroup,
       AccountNo, AccountDesc, PrimaryGroupNo, PrimaryGroupDesc, DateOpened, DateClosed,
       isActive, AccountStatus, AccountSkey
FROM acc_silver WHERE isActive = 1""")

_cte("fx_product", (), f"""
SELECT 'S' || CAST(p_partkey AS VARCHAR) AS Source_System_Id, CAST(p_partkey AS VARCHAR) AS Product_Code,
       p_name AS Product_Desc,
       CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE 'Product_SKU' END AS Product_Level,
       CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 59 = 0 THEN 'ROOT'
            WHEN p_partkey % 61 = 0 THEN 'PX' || CAST(p_partkey AS VARCHAR)
            WHEN p_partkey % 67 = 0 THEN 'B' || p_brand
            ELSE 'P' || p_brand || '|' || p_type END AS Par_Row_Id,
       CASE WHEN p_size > 25 THEN 'CASE' ELSE 'CARTON' END AS Traded_Unit,
       CAST(p_size * 10 AS INTEGER) AS Sticks_Per_Traded_Unit,
       CAST(p_size AS INTEGER) AS Packs_Per_Traded_Unit,
       CAST(p_size % 4 + 1 AS INTEGER) AS Outers_Per_Traded_Unit,
       CAST(p_retailprice AS DOUBLE) AS Grams_Per_Traded_Unit
FROM part
UNION ALL
SELECT 'P' || p_brand || '|' || p_type, p_brand || '/' || p_type, p_type || ' pack', 'Product_Pack',
       'B' || p_brand, {_NULL_ATTRS}
FROM (SELECT DISTINCT p_brand, p_type FROM part)
UNION ALL
SELECT 'B' || p_brand, p_brand, 'Brand ' || CAST({_BRANDNO} AS VARCHAR), 'Product_Brand',
       'H' || CAST({_BRANDNO} % 5 AS VARCHAR), {_NULL_ATTRS}
FROM (SELECT DISTINCT p_brand FROM part)
UNION ALL
SELECT 'H' || CAST(h AS VARCHAR), 'HOUSE' || CAST(h AS VARCHAR), 'House ' || CAST(h AS VARCHAR),
       'Product_House', 'GR' || CAST(h % 2 AS VARCHAR), {_NULL_ATTRS}
FROM (SELECT DISTINCT {_BRANDNO} % 5 AS h FROM part)
UNION ALL
SELECT 'GR' || CAST(g AS VARCHAR), 'GROUP' || CAST(g AS VARCHAR), 'Group ' || CAST(g AS VARCHAR),
       'Product_Group', 'ROOT', {_NULL_ATTRS}
FROM (SELECT DISTINCT ({_BRANDNO} % 5) % 2 AS g FROM part)
UNION ALL
SELECT 'ROOT', 'ROOT', 'All products', 'Product_Root', CAST(NULL AS VARCHAR), {_NULL_ATTRS}
FROM (SELECT DISTINCT 1 FROM part)""")

_cte("prod_sku", ("fx_product",), "SELECT * FROM fx_product WHERE Product_Level = 'Product_SKU'")

_cte("prod_sku_tagged", ("prod_sku",), """
SELECT *, CASE WHEN Product_Desc IS NULL THEN 'Product_Desc is missing'
               WHEN Product_Code IS NULL THEN 'Product_Code is missing'
               WHEN Product_Level IS NULL THEN 'Product_Level is missing'
               WHEN Par_Row_Id IS NULL THEN 'Par_Row_Id is missing'
               WHEN Par_Row_Id IN ('ROOT') THEN 'Not able to achieve next hierarchy' END AS exception_reason
FROM prod_sku""")

_cte("prod_exceptions", ("fx_product", "prod_sku_tagged"), """
SELECT *, 'Product_Level is missing' AS exception_reason FROM fx_product WHERE Product_Level IS NULL
UNION ALL SELECT * FROM prod_sku_tagged WHERE exception_reason IS NOT NULL""")

_cte("prod_valid", ("prod_sku_tagged",), f"""
SELECT Source_System_Id AS SourceSystemSKUId, Product_Code AS SkuCode, Product_Desc AS SkuDesc,
       Par_Row_Id, {_ATTRS}
FROM prod_sku_tagged WHERE exception_reason IS NULL""")

# Every hop reads the small table of inner nodes, built once.
_cte("prod_inner", ("fx_product",), """
SELECT Source_System_Id, Product_Code, Product_Desc, Product_Level, Par_Row_Id FROM fx_product
WHERE Product_Level IS NULL OR Product_Level <> 'Product_SKU'
   OR Source_System_Id IN (SELECT Par_Row_Id FROM fx_product)""")

_cte("prod_flat", ("prod_valid", "prod_inner"), """
SELECT v.*, k.Product_Code AS PackCode, k.Product_Desc AS PackDesc,
       b.Product_Code AS BrandCode, b.Product_Desc AS BrandDesc,
       h.Product_Code AS HouseCode, h.Product_Desc AS HouseDesc,
       g.Product_Code AS GroupCode, g.Product_Desc AS GroupDesc,
       CASE WHEN k.Source_System_Id IS NULL THEN 'Pack' WHEN b.Source_System_Id IS NULL THEN 'Brand'
            WHEN h.Source_System_Id IS NULL THEN 'House' WHEN g.Source_System_Id IS NULL THEN 'Group'
       END AS incomplete_at
FROM prod_valid v
LEFT JOIN prod_inner k ON v.Par_Row_Id = k.Source_System_Id
LEFT JOIN prod_inner b ON k.Par_Row_Id = b.Source_System_Id
LEFT JOIN prod_inner h ON b.Par_Row_Id = h.Source_System_Id
LEFT JOIN prod_inner g ON h.Par_Row_Id = g.Source_System_Id""")

_cte("prod_flat_checked", ("prod_valid", "fx_product"), """
SELECT v.SourceSystemSKUId, v.SkuCode,
       CASE WHEN k.Source_System_Id IS NULL THEN 'Pack' WHEN b.Source_System_Id IS NULL THEN 'Brand'
            WHEN h.Source_System_Id IS NULL THEN 'House' WHEN g.Source_System_Id IS NULL THEN 'Group'
       END AS incomplete_at
FROM prod_valid v
LEFT JOIN fx_product k ON v.Par_Row_Id = k.Source_System_Id AND k.Product_Level = 'Product_Pack'
LEFT JOIN fx_product b ON k.Par_Row_Id = b.Source_System_Id AND b.Product_Level = 'Product_Brand'
LEFT JOIN fx_product h ON b.Par_Row_Id = h.Source_System_Id AND h.Product_Level = 'Product_House'
LEFT JOIN fx_product g ON h.Par_Row_Id = g.Source_System_Id AND g.Product_Level = 'Product_Group'""")

_cte("prod_silver", ("prod_flat",), f"""
SELECT *, {_key('SourceSystemSKUId')} AS ProductSkey FROM prod_flat WHERE incomplete_at IS NULL""")

_cte("prod_gold", ("prod_silver",), f"""
SELECT ProductSkey, SourceSystemSKUId, SkuCode, concat_ws('-', SkuCode, SkuDesc) AS SKU,
       PackCode, concat_ws('-', PackCode, PackDesc) AS Packing,
       BrandCode, concat_ws('-', BrandCode, BrandDesc) AS Brand,
       HouseCode, concat_ws('-', HouseCode, HouseDesc) AS House,
       GroupCode, concat_ws('-', GroupCode, GroupDesc) AS ProductGroup, {_ATTRS}
FROM prod_silver""")


def _calendar_from(bounds_cte: str) -> str:
    return f"""
SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS TimeSkey, CAST(day AS TIMESTAMP) AS Date,
       strftime(day, '%A') AS DayOfWeek,
       CASE WHEN day = DATE '2001-11-04' THEN 1 ELSE 0 END AS CurrentDay,
       CASE WHEN isodow(day) < 6 THEN 1 ELSE 0 END AS WorkingDay,
       CAST(year(day) * 100 + month(day) AS INTEGER) AS MonthId,
       strftime(day, '%B %Y') AS MonthDesc,
       CAST(year(day) * 10 + quarter(day) AS SMALLINT) AS QuarterId,
       'Q' || CAST(quarter(day) AS VARCHAR) AS QuarterDesc,
       CAST(year(day) AS INTEGER) AS Year
FROM (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
      FROM {bounds_cte})"""


_cte("time_bounds", (), """
SELECT s, CAST(s + INTERVAL 120 MONTH AS DATE) AS e
FROM (SELECT CAST(min(o_orderdate) AS DATE) AS s FROM orders)""")

_cte("dim_time", ("time_bounds",), _calendar_from("time_bounds"))

_cte("time_bounds_wide", ("time_bounds",), """
SELECT least(a.s, b.s) AS s, greatest(a.e, b.e) AS e
FROM time_bounds a, (SELECT s, CAST(s + INTERVAL 120 MONTH AS DATE) AS e
                     FROM (SELECT CAST(min(l_shipdate) AS DATE) AS s FROM lineitem)) b""")

_cte("dim_time_wide", ("time_bounds_wide",), _calendar_from("time_bounds_wide"))

_cte("star", ("inv_valid", "acc_gold", "prod_gold", "dim_time"), f"""
SELECT {_line_key('v')} AS FactInvoiceSkey,
       v.InvoiceNumber, v.LineItem, v.InvoiceNumber || v.LineItem AS InvoiceLineItemNumber, v.Date,
       v.Quantity, v.GrossValue, v.NetValue, v.VAT AS VATvalue,
       a.AccountSkey, p.ProductSkey, t.TimeSkey,
       CAST(year(v.Date) AS INTEGER) AS Year, CAST(month(v.Date) AS INTEGER) AS Month
FROM inv_valid v
LEFT JOIN (SELECT AccountNo, max(AccountSkey) AS AccountSkey FROM acc_gold GROUP BY AccountNo) a
       ON v.Account = a.AccountNo
LEFT JOIN (SELECT SkuCode, max(ProductSkey) AS ProductSkey FROM prod_gold GROUP BY SkuCode) p
       ON v.Product = p.SkuCode
LEFT JOIN (SELECT Date, max(TimeSkey) AS TimeSkey FROM dim_time GROUP BY Date) t
       ON v.Date = t.Date""")

_cte("fact_valid", ("star",), """
SELECT * FROM star WHERE AccountSkey IS NOT NULL AND ProductSkey IS NOT NULL AND TimeSkey IS NOT NULL""")

_cte("fact_product", ("fact_valid", "prod_gold"), """
SELECT f.*, p.BrandCode, p.PackCode FROM fact_valid f JOIN prod_gold p ON f.ProductSkey = p.ProductSkey""")


# CTEs that several others read: computed once.
MATERIALIZED = {"fx_product", "prod_inner", "prod_valid", "prod_flat"}


def _with(names: tuple[str, ...], body: str) -> str:
    needed: set[str] = set()

    def visit(n: str) -> None:
        if n in needed:
            return
        for d in CTES[n][0]:
            visit(d)
        needed.add(n)

    for n in names:
        visit(n)
    ordered = [n for n in CTES if n in needed]
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({CTES[n][1].strip()}\n)"
                       for n in ordered)
    return f"WITH {parts}\n{body.strip()}"


_ACC_COLS = "RowId, AccountNo, AccountDesc, ParentRowId, DateOpened, DateClosed"
_GROUP_FILTER = "ParentRowId IS NULL AND DateOpened IS NULL AND DateClosed IS NULL"
_STAR_COLS = ("FactInvoiceSkey, InvoiceNumber, LineItem, InvoiceLineItemNumber, Date, Quantity, "
              "GrossValue, NetValue, VATvalue, AccountSkey, ProductSkey, TimeSkey, Year, Month")
_UPSERT_COLS = ["SkuCode", "SkuDesc", "Traded_Unit", "Outers_Per_Traded_Unit",
                "Sticks_Per_Traded_Unit", "Packs_Per_Traded_Unit", "Grams_Per_Traded_Unit"]


def _upsert_sql() -> str:
    upd = ",\n       ".join(
        f"CASE WHEN s.SourceSystemSKUId IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _UPSERT_COLS)
    diff = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in _UPSERT_COLS)
    return _with(("prod_valid",), f"""
, base AS (SELECT SourceSystemSKUId, SkuCode, SkuDesc, {_ATTRS} FROM prod_valid),
tgt AS (SELECT *, TIMESTAMP '2001-01-01 00:00:00' AS InsertedDateTime,
               TIMESTAMP '2001-01-01 00:00:00' AS ModifiedDateTime
        FROM base WHERE TRY_CAST(SkuCode AS BIGINT) % 10 <> 0),
src AS (SELECT SourceSystemSKUId, SkuCode,
               CASE WHEN TRY_CAST(SkuCode AS BIGINT) % 7 = 0 THEN SkuDesc || ' v2' ELSE SkuDesc END AS SkuDesc,
               {_ATTRS}
        FROM base WHERE TRY_CAST(SkuCode AS BIGINT) % 7 = 0 OR TRY_CAST(SkuCode AS BIGINT) % 10 = 0)
SELECT coalesce(s.SourceSystemSKUId, t.SourceSystemSKUId) AS SourceSystemSKUId,
       {upd},
       CASE WHEN t.SourceSystemSKUId IS NOT NULL THEN t.InsertedDateTime
            ELSE TIMESTAMP '2001-06-01 00:00:00' END AS InsertedDateTime,
       CASE WHEN s.SourceSystemSKUId IS NOT NULL AND (t.SourceSystemSKUId IS NULL OR {diff})
            THEN TIMESTAMP '2001-06-01 00:00:00' ELSE t.ModifiedDateTime END AS ModifiedDateTime
FROM tgt t FULL OUTER JOIN src s ON t.SourceSystemSKUId = s.SourceSystemSKUId""").replace(")\n, base", "),\nbase", 1)


ORACLE_SQL: dict[str, str] = {
    "monthly_brand_net": _with(("fact_product",), """
SELECT Year, Month, BrandCode, CAST(sum(NetValue) AS DECIMAL(38,2)) AS net_value,
       CAST(count(*) AS BIGINT) AS n_lines
FROM fact_product GROUP BY Year, Month, BrandCode"""),
    "csv_roundtrip_contract": _with(("fx_invoice",), """
SELECT source_file, true AS contract_ok, CAST(count(*) AS BIGINT) AS n_rows
FROM fx_invoice GROUP BY source_file"""),
    "csv_contract_reject": _with(("inv_gated",), """
SELECT source_file, good AS contract_ok, CAST(count(*) AS BIGINT) AS n_data_rows,
       CAST(sum(CASE WHEN good AND reason IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_staged,
       CAST(sum(CASE WHEN good THEN 0 ELSE 1 END) AS BIGINT) AS n_header_rejected
FROM (SELECT *, CAST(substr(source_file, 9, 2) AS INTEGER) % 10 > 2 AS good FROM inv_gated)
GROUP BY source_file, good"""),
    "source_file_counts": _with(("inv_rows",), """
SELECT source_file, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN Account IS NULL OR Product IS NULL OR Account = 'NA' OR Product = 'NA'
                     THEN 1 ELSE 0 END) AS BIGINT) AS n_blank_keys,
       max(Account IS NULL OR Product IS NULL OR Account = 'NA' OR Product = 'NA') AS any_blank
FROM inv_rows GROUP BY source_file"""),
    "invoice_row_gate": _with(("inv_gated",), """
SELECT InvoiceNumber, LineItem, Product, source_file, reason FROM inv_gated"""),
    "invoice_file_gate": _with(("inv_gated",), """
SELECT InvoiceNumber, LineItem, Product, source_file, NetValue FROM inv_gated
WHERE reason IS NULL
  AND source_file NOT IN (SELECT source_file FROM inv_gated WHERE reason IS NOT NULL)"""),
    "invoice_reject_reasons": _with(("inv_gated",), """
SELECT reason, CAST(count(*) AS BIGINT) AS n FROM inv_gated WHERE reason IS NOT NULL GROUP BY reason"""),
    "conservation": _with(("inv_gated",), """
SELECT n_input, n_valid, n_rejected, n_input = n_valid + n_rejected AS balanced
FROM (SELECT CAST(count(*) AS BIGINT) AS n_input,
             CAST(sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_valid,
             CAST(sum(CASE WHEN reason IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS n_rejected
      FROM inv_gated)"""),
    "text_clean": _with(("fx_account",), f"""
SELECT RowId, version, AccountDesc AS raw_desc, {_clean('AccountDesc')} AS clean_desc FROM fx_account"""),
    "account_parent_lookup": _with(("acc_with_parents",), "SELECT * FROM acc_with_parents"),
    "account_exceptions": _with(("acc_members",), """
SELECT version, RowId, AccountNo, exception_reason FROM acc_members WHERE exception_reason IS NOT NULL"""),
    "account_new_keys": _with(("acc_with_parents",), """
SELECT n.version, n.AccountNo, n.AccountDesc FROM acc_with_parents n
WHERE n.version > 0
  AND NOT EXISTS (SELECT 1 FROM acc_with_parents o
                  WHERE o.version = n.version - 1 AND o.AccountNo = n.AccountNo)"""),
    "account_changed_keys": _with(("acc_with_parents",), """
SELECT n.version, n.AccountNo, o.AccountDesc AS old_AccountDesc, n.AccountDesc
FROM acc_with_parents n JOIN acc_with_parents o ON n.AccountNo = o.AccountNo AND o.version = n.version - 1
WHERE (n.AccountDesc IS DISTINCT FROM o.AccountDesc OR n.PrimaryGroupNo IS DISTINCT FROM o.PrimaryGroupNo
       OR n.DateOpened IS DISTINCT FROM o.DateOpened OR n.DateClosed IS DISTINCT FROM o.DateClosed)"""),
    "account_scd_versions": _with(("acc_silver",), "SELECT * FROM acc_silver"),
    "account_scd_incremental": _with(("acc_silver",), "SELECT * FROM acc_silver"),
    "account_gold": _with(("acc_gold",), "SELECT * FROM acc_gold"),
    "set_difference": _with(("fx_account",), f"""
SELECT {_ACC_COLS} FROM fx_account EXCEPT SELECT {_ACC_COLS} FROM fx_account WHERE {_GROUP_FILTER}"""),
    "set_difference_all": _with(("fx_account",), f"""
SELECT {_ACC_COLS} FROM fx_account EXCEPT ALL SELECT {_ACC_COLS} FROM fx_account WHERE {_GROUP_FILTER}"""),
    "product_level_sku": _with(("prod_sku",), "SELECT * FROM prod_sku"),
    "product_exceptions": _with(("prod_exceptions", "prod_flat", "prod_sku"), """
SELECT Source_System_Id, Product_Code, Product_Level, Par_Row_Id, exception_reason FROM prod_exceptions
UNION ALL
SELECT s.Source_System_Id, s.Product_Code, s.Product_Level, s.Par_Row_Id,
       'hierarchy incomplete at ' || f.incomplete_at
FROM prod_sku s JOIN prod_flat f ON s.Source_System_Id = f.SourceSystemSKUId
WHERE f.incomplete_at IS NOT NULL"""),
    "product_flatten": _with(("prod_flat",), """
SELECT SourceSystemSKUId, SkuCode, SkuDesc, PackCode, PackDesc, BrandCode, BrandDesc, HouseCode,
       HouseDesc, GroupCode, GroupDesc
FROM prod_flat WHERE incomplete_at IS NULL"""),
    "product_flatten_incomplete": _with(("prod_flat",), """
SELECT SourceSystemSKUId, SkuCode, incomplete_at, 'hierarchy incomplete at ' || incomplete_at AS exception_reason
FROM prod_flat WHERE incomplete_at IS NOT NULL"""),
    "product_attach_attributes": _with(("prod_flat", "prod_sku"), """
SELECT f.SourceSystemSKUId, f.SkuCode, f.SkuDesc, f.PackCode, f.PackDesc, f.BrandCode, f.BrandDesc,
       f.HouseCode, f.HouseDesc, f.GroupCode, f.GroupDesc, s.Traded_Unit, s.Outers_Per_Traded_Unit,
       s.Sticks_Per_Traded_Unit, s.Packs_Per_Traded_Unit, s.Grams_Per_Traded_Unit
FROM prod_flat f LEFT JOIN prod_sku s ON f.SourceSystemSKUId = s.Source_System_Id
WHERE f.incomplete_at IS NULL"""),
    "surrogate_keys": _with(("fx_invoice",), f"""
SELECT InvoiceNumber, LineItem, Product, Date,
       {_line_key('fx_invoice')} AS row_key
FROM fx_invoice"""),
    "product_upsert": _upsert_sql(),
    "product_gold": _with(("prod_gold",), "SELECT * FROM prod_gold"),
    "product_flatten_level_checked": _with(("prod_flat_checked",), "SELECT * FROM prod_flat_checked"),
    "account_invoiced": _with(("acc_gold", "fact_valid"), """
SELECT a.AccountNo, a.AccountSkey FROM acc_gold a
WHERE EXISTS (SELECT 1 FROM fact_valid f WHERE f.AccountSkey = a.AccountSkey)"""),
    "invoice_file_routing": _with(("routed",), """
SELECT zone, CAST(count(DISTINCT source_file) AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_rows,
       CAST((SELECT count(*) FROM (SELECT DISTINCT z.Date, z.Account, z.Product FROM routed z
             WHERE z.zone = r.zone AND z.Account IS NOT NULL AND z.Product IS NOT NULL)) AS BIGINT) AS n_details,
       CAST(sum(NetValue) AS DECIMAL(38,2)) AS net_value
FROM routed r GROUP BY zone"""),
    "dim_time_view": _with(("dim_time",), """
SELECT Year, CAST(count(*) AS BIGINT) AS n_days, CAST(sum(WorkingDay) AS BIGINT) AS working_days
FROM dim_time GROUP BY Year"""),
    "dim_time": _with(("dim_time",), "SELECT * FROM dim_time"),
    "dim_time_widened": _with(("dim_time_wide",), "SELECT * FROM dim_time_wide"),
    "star_lookup": _with(("star",), f"SELECT {_STAR_COLS} FROM star"),
    "star_lookup_as_of": _with(("inv_valid", "acc_silver"), """
SELECT v.InvoiceNumber, v.LineItem, v.Product, v.Date, v.Account, a.AccountSkey
FROM inv_valid v LEFT JOIN acc_silver a
  ON v.Account = a.AccountNo AND v.Date >= a.ValidFrom AND (a.ValidTo IS NULL OR v.Date < a.ValidTo)"""),
    "fact_valid": _with(("fact_valid",), f"SELECT {_STAR_COLS} FROM fact_valid"),
    "fact_unresolved": _with(("star",), f"""
SELECT {_STAR_COLS} FROM star WHERE AccountSkey IS NULL OR ProductSkey IS NULL OR TimeSkey IS NULL"""),
    "partition_keys": _with(("fact_valid",), "SELECT DISTINCT Year, Month FROM fact_valid"),
    "partition_refresh": _with(("fact_valid",), """
SELECT FactInvoiceSkey,
       Quantity + CASE WHEN Date >= TIMESTAMP '1999-07-01 00:00:00' THEN 1 ELSE 0 END AS Quantity,
       Year, Month
FROM fact_valid"""),
    "append_evolved": _with(("fact_valid",), """
SELECT FactInvoiceSkey, Year, NetValue, CASE WHEN Year >= 2000 THEN VATvalue END AS VATvalue FROM fact_valid"""),
    "retention_36m": _with(("fact_valid",), """
SELECT FactInvoiceSkey, Date FROM fact_valid WHERE Date >= DATE '2001-11-04' - INTERVAL 36 MONTH"""),
    "fact_gold": _with(("fact_valid",), """
SELECT FactInvoiceSkey, CAST(AccountSkey AS BIGINT) AS AccountSkey,
       CAST(ProductSkey AS BIGINT) AS ProductSkey, CAST(TimeSkey AS INTEGER) AS TimeSkey,
       InvoiceNumber, InvoiceLineItemNumber, CAST(Quantity AS INTEGER) AS Quantity,
       CAST(GrossValue AS DECIMAL(18,2)) AS GrossValue, CAST(NetValue AS DECIMAL(18,2)) AS NetValue,
       CAST(VATvalue AS DECIMAL(18,2)) AS VATvalue
FROM fact_valid WHERE Date >= DATE '2001-11-04' - INTERVAL 36 MONTH"""),
    "duplicate_lines": _with(("fx_invoice",), """
SELECT InvoiceNumber, LineItem, CAST(count(*) AS BIGINT) AS n FROM fx_invoice
GROUP BY InvoiceNumber, LineItem HAVING count(*) > 1"""),
    "gold_rollup": _with(("fact_product",), """
SELECT BrandCode, PackCode, CAST(sum(NetValue) AS DECIMAL(38,2)) AS net_value,
       CAST(count(*) AS BIGINT) AS n_lines
FROM fact_product GROUP BY ROLLUP (BrandCode, PackCode)"""),
    "audit_rows": _with(("inv_gated",), """
SELECT 'INFO' AS LogType, 'bronze rows scanned' AS LogMessage, 'invoice landing' AS LogMessageDetails,
       CAST(count(*) AS BIGINT) AS LogRowCount, 'run-0001' AS LogRunID FROM inv_gated
UNION ALL
SELECT 'INFO', 'rows staged', 'passed the row gate', CAST(count(*) AS BIGINT), 'run-0001'
FROM inv_gated WHERE reason IS NULL
UNION ALL
SELECT 'WARN', 'rows rejected', 'failed the row gate', CAST(count(*) AS BIGINT), 'run-0001'
FROM inv_gated WHERE reason IS NOT NULL"""),
    "stream_invoice_arrival": _with(("inv_gated",), """
SELECT CASE WHEN reason IS NULL THEN 'valid' ELSE 'rejected' END AS outcome, reason,
       CAST(count(*) AS BIGINT) AS n
FROM inv_gated GROUP BY 1, 2"""),
    "stream_file_arrival": """
SELECT event_type, CAST(count(*) AS BIGINT) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_value
FROM events GROUP BY event_type""".strip(),
}

# ---- late rows, trees of any depth, carried lookups, spliced versions, numbers, violations

ORACLE_SQL["star_lookup_as_of_carried"] = ORACLE_SQL["star_lookup_as_of"]
ORACLE_SQL["account_scd_late"] = ORACLE_SQL["account_scd_versions"]

ORACLE_SQL["account_scd_closed"] = _with(("acc_with_parents",), f"""
, seen AS (SELECT *, lead(version) OVER (PARTITION BY AccountNo ORDER BY version) AS nxt FROM acc_with_parents),
ends AS (SELECT AccountNo FROM seen WHERE version < 2 AND nxt IS NULL),
rows_ AS (
  SELECT *, false AS gone FROM acc_with_parents
  UNION ALL BY NAME SELECT AccountNo, 2 AS version, true AS gone FROM ends),
lagged AS (
  SELECT *, lag(version) OVER w AS _pv, lag(AccountDesc) OVER w AS _p1, lag(PrimaryGroupNo) OVER w AS _p2,
         lag(DateOpened) OVER w AS _p3, lag(DateClosed) OVER w AS _p4, lag(gone) OVER w AS _p5
  FROM rows_ WINDOW w AS (PARTITION BY AccountNo ORDER BY version)),
kept AS (
  SELECT * EXCLUDE (_pv, _p1, _p2, _p3, _p4, _p5),
         CAST(make_date(CASE version WHEN 0 THEN 1995 WHEN 1 THEN 1998 ELSE 2000 END, 1, 1) AS TIMESTAMP) AS ValidFrom
  FROM lagged
  WHERE _pv IS NULL OR AccountDesc IS DISTINCT FROM _p1 OR PrimaryGroupNo IS DISTINCT FROM _p2
     OR DateOpened IS DISTINCT FROM _p3 OR DateClosed IS DISTINCT FROM _p4 OR gone IS DISTINCT FROM _p5)
SELECT * EXCLUDE (gone), CASE WHEN ValidTo IS NULL THEN 1 ELSE 0 END AS isActive,
       CASE WHEN DateClosed IS NOT NULL THEN 0 ELSE 1 END AS AccountStatus,
       {_key('AccountNo', 'version')} AS AccountSkey
FROM (SELECT *, lead(ValidFrom) OVER (PARTITION BY AccountNo ORDER BY version) AS ValidTo FROM kept)
WHERE NOT gone""").replace(")\n, seen", "),\nseen", 1)

_TREE = """
WITH RECURSIVE ref AS MATERIALIZED (
  SELECT 'A' || CAST(c_custkey AS VARCHAR) AS node,
         CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 101 = 0 THEN 'X' || CAST(c_custkey AS VARCHAR)
              WHEN c_custkey % 89 = 0 THEN 'A' || CAST(c_custkey + 3 AS VARCHAR)
              ELSE 'A' || CAST(c_custkey - 1 AS VARCHAR) END AS parent
  FROM customer),
tops AS (
  SELECT r.node, CASE WHEN r.parent IS NULL THEN 'complete' ELSE 'parent missing' END AS outcome
  FROM ref r LEFT JOIN ref p ON r.parent = p.node WHERE p.node IS NULL),
walk(node, root, depth, path, outcome) AS (
  SELECT node, node, 0, node, outcome FROM tops
  UNION ALL SELECT c.node, w.root, w.depth + 1, w.path || '/' || c.node, w.outcome
  FROM walk w JOIN ref c ON c.parent = w.node),
stuck AS MATERIALIZED (SELECT node, parent FROM ref WHERE node NOT IN (SELECT node FROM walk)),
reach(node, up) AS (
  SELECT node, parent FROM stuck UNION SELECT r.node, s.parent FROM reach r JOIN stuck s ON s.node = r.up),
tree AS (
  SELECT node, root, CAST(depth AS INTEGER) AS depth, path, outcome FROM walk
  UNION ALL
  SELECT node, NULL, NULL, NULL,
         CASE WHEN EXISTS (SELECT 1 FROM reach r WHERE r.node = stuck.node AND r.up = stuck.node)
              THEN 'cycle' ELSE 'below a cycle' END
  FROM stuck)"""
ORACLE_SQL["account_tree_walk"] = (_TREE + "\nSELECT * FROM tree").strip()
ORACLE_SQL["account_tree_roots"] = (_TREE + """
SELECT root, outcome, CAST(count(*) AS BIGINT) AS n_nodes, max(depth) AS max_depth FROM tree GROUP BY root, outcome""").strip()

ORACLE_SQL["version_overlaps"] = _with(("acc_silver",), """
, v AS (
  SELECT AccountNo, AccountSkey, ValidFrom,
         CASE WHEN CAST(AccountNo AS BIGINT) % 2 = 0 THEN ValidTo + INTERVAL 400 DAY ELSE ValidTo END AS ValidTo
  FROM acc_silver),
n AS (
  SELECT AccountNo, AccountSkey AS earlier, ValidTo AS until, lead(AccountSkey) OVER w AS later,
         lead(ValidFrom) OVER w AS overlap_from, lead(ValidTo) OVER w AS later_until
  FROM v WINDOW w AS (PARTITION BY AccountNo ORDER BY ValidFrom, AccountSkey))
SELECT AccountNo, earlier, later, overlap_from, least(until, later_until) AS overlap_to
FROM n WHERE later IS NOT NULL AND (until IS NULL OR overlap_from < until)""").replace(")\n, v AS", "),\nv AS", 1)

ORACLE_SQL["fact_gold_numbered"] = _with(("fact_valid",), """
, numbered AS (
  SELECT FactInvoiceSkey, row_number() OVER (ORDER BY Year >= 1998, FactInvoiceSkey) AS FactInvoiceNo FROM fact_valid)
SELECT CAST(n.FactInvoiceNo AS BIGINT) AS FactInvoiceNo, f.FactInvoiceSkey, CAST(f.AccountSkey AS BIGINT) AS AccountSkey,
       CAST(f.ProductSkey AS BIGINT) AS ProductSkey, CAST(f.TimeSkey AS INTEGER) AS TimeSkey,
       CAST(f.NetValue AS DECIMAL(18,2)) AS NetValue
FROM fact_valid f JOIN numbered n ON n.FactInvoiceSkey = f.FactInvoiceSkey
WHERE f.Date >= DATE '2001-11-04' - INTERVAL 36 MONTH""").replace(")\n, numbered", "),\nnumbered", 1)

_BROKEN = {
    "header mismatch": "false",
    "malformed record": "CAST(InvoiceNumber AS BIGINT) % 73 = 0",
    "Account is blank": "Account IS NULL OR TRIM(Account) = ''",
    "Account is NA": "TRIM(Account) IN ('NA')",
    "Product is blank": "Product IS NULL OR TRIM(Product) = ''",
    "Product is NA": "TRIM(Product) IN ('NA')",
    "amounts do not reconcile": "abs(GrossValue - (NetValue + VAT)) > 0.01",
}
ORACLE_SQL["invoice_violations"] = _with(("inv_rows",), "\nUNION ALL\n".join(f"""
SELECT source_file, '{rule}' AS rule, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE {broken}) AS BIGINT) AS n_violations FROM inv_rows GROUP BY source_file""".strip()
    for rule, broken in _BROKEN.items()))
ORACLE_SQL["invoice_threshold_policy"] = _with(("inv_rows",), f"""
SELECT source_file, n_rows, n_bad, n_fatal, n_fatal = 0 AND 100 * n_bad <= 10 * n_rows AS accepted
FROM (SELECT source_file, CAST(count(*) AS BIGINT) AS n_rows,
             CAST(count(*) FILTER (WHERE {' OR '.join(f'({b})' for b in _BROKEN.values())}) AS BIGINT) AS n_bad,
             CAST(count(*) FILTER (WHERE {_BROKEN['malformed record']}) AS BIGINT) AS n_fatal
      FROM inv_rows GROUP BY source_file)""")

ORACLE_SQL["stream_late_quarantine"] = """
WITH e AS (
  SELECT event_type, CAST(value AS DECIMAL(18,2)) AS value, event_id % 7 = 0 AS again, event_id % 11 = 0 AS timeless,
         ts >= TIMESTAMP '2024-01-16' OR ts > (SELECT max(ts) FROM events) - INTERVAL 20 DAY AS stored
  FROM events)
SELECT event_type,
       CAST(count(*) + count(*) FILTER (WHERE again) + count(*) FILTER (WHERE timeless) AS BIGINT) AS n_arrived,
       CAST(count(*) FILTER (WHERE stored) AS BIGINT) AS n_stored,
       CAST(count(*) FILTER (WHERE NOT stored) + count(*) FILTER (WHERE NOT stored AND again) AS BIGINT) AS n_late,
       CAST(count(*) FILTER (WHERE timeless) AS BIGINT) AS n_no_time,
       CAST(sum(value) FILTER (WHERE stored) AS DECIMAL(38,2)) AS stored_value,
       CAST(count(*) FILTER (WHERE stored AND again) AS BIGINT) AS n_repeats
FROM e GROUP BY event_type""".strip()

ORACLE_SQL["account_bronze_outcome"] = _with(("fx_account",), """
, n AS (SELECT version, CAST(count(*) AS BIGINT) AS n FROM fx_account GROUP BY version)
SELECT 'accountv' || CAST(version AS VARCHAR) AS source_file, true AS contract_ok, n AS n_staged,
       CAST(0 AS BIGINT) AS n_malformed, n AS n_archived, CAST(0 AS BIGINT) AS n_rejected FROM n
UNION ALL
SELECT unnest(['accountv3', 'accountv4']), false, 0, 0, 0, n FROM n WHERE version = 2""").replace(")\n, n AS", "),\nn AS", 1)
ORACLE_SQL["account_bronze_staged"] = _with(("fx_account",), f"""
SELECT {_ACC_COLS}, 'accountv' || CAST(version AS VARCHAR) AS source_file FROM fx_account""")
_UPDATED = "TRY_CAST(Product_Code AS BIGINT)"
ORACLE_SQL["product_bronze_outcome"] = _with(("fx_product",), f"""
SELECT 'product' AS source_file, true AS contract_ok, CAST(count(*) AS BIGINT) AS n_staged,
       CAST(0 AS BIGINT) AS n_malformed, CAST(count(*) AS BIGINT) AS n_archived, CAST(0 AS BIGINT) AS n_rejected FROM fx_product
UNION ALL
SELECT 'product_update', true, count(*), count(*) FILTER (WHERE {_UPDATED} % 43 = 0), count(*), 0
FROM fx_product WHERE {_UPDATED} IS NOT NULL
UNION ALL
SELECT 'product_old', false, 0, 0, 0, count(*) FROM fx_product""")
ORACLE_SQL["product_bronze_staged"] = _with(("fx_product",), f"""
SELECT *, 'product' AS source_file, false AS malformed FROM fx_product
UNION ALL
SELECT * REPLACE (CASE WHEN {_UPDATED} % 43 = 0 THEN NULL ELSE Packs_Per_Traded_Unit END AS Packs_Per_Traded_Unit),
       'product_update', {_UPDATED} % 43 = 0
FROM fx_product WHERE {_UPDATED} IS NOT NULL""")

ORACLE_SQL["partition_merge"] = _with(("fact_valid",), """
SELECT FactInvoiceSkey, Quantity + CASE WHEN Year = 1997 AND Month = 5 THEN 1 ELSE 0 END AS Quantity,
       CASE WHEN Year = 1997 AND Month <= 2 THEN TIMESTAMP '2001-06-01 00:00:00'
            ELSE TIMESTAMP '2001-01-01 00:00:00' END AS InsertedDateTime,
       CASE WHEN Year = 1997 AND (Month <= 2 OR Month = 5) THEN TIMESTAMP '2001-06-01 00:00:00'
            ELSE TIMESTAMP '2001-01-01 00:00:00' END AS ModifiedDateTime,
       Year, Month, CAST((SELECT count(DISTINCT Month) FROM fact_valid WHERE Year = 1997 AND Month IN (1, 2, 5)) AS BIGINT) AS rewritten,
       CAST(0 AS BIGINT) AS rewritten_again
FROM fact_valid""")
ORACLE_SQL["file_compaction"] = _with(("fact_valid",), """
SELECT Year, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(NetValue) AS DECIMAL(38,2)) AS net_value,
       CAST(1 AS BIGINT) AS n_files FROM fact_valid GROUP BY Year""")

ORACLE_SQL["rollup_maintained"] = _with(("fact_product",), """
SELECT BrandCode, PackCode, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(NetValue) AS DECIMAL(38,2)) AS net_value,
       CAST(sum(Quantity + CASE WHEN Date >= TIMESTAMP '1999-07-01 00:00:00' THEN 1 ELSE 0 END) AS BIGINT) AS quantity
FROM fact_product GROUP BY CUBE (BrandCode, PackCode)""")

ORACLE_SQL["append_reconciled"] = _with(("fact_valid",), """
SELECT FactInvoiceSkey,
       CASE WHEN Year >= 1997 AND FactInvoiceSkey LIKE '0%' THEN NULL ELSE Year END AS Year,
       CASE WHEN Year >= 1997 AND FactInvoiceSkey LIKE '0%' THEN NULL ELSE CAST(Quantity AS BIGINT) END AS Quantity,
       CASE WHEN Year < 1997 THEN CAST(NetValue AS DECIMAL(20,4)) END AS NetValue,
       CASE WHEN Year < 1995 OR (Year >= 1997 AND FactInvoiceSkey LIKE '0%') THEN NULL ELSE VATvalue END AS VATvalue,
       CASE WHEN Year >= 1997 AND FactInvoiceSkey LIKE '0%' THEN 'Quantity' END AS unfit
FROM fact_valid""")
