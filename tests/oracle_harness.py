"""Own copy of the driver's comparison: a registered Spark query against its
DuckDB oracle on the same parquet tables (row count, column names, types by
family, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _canon(v.item())
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in records)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "spark_sec": round(t1 - t0, 2)}
    out["columns_match"] = sorted(scols) == sorted(dcols)
    if not out["columns_match"]:
        out["columns"] = (sorted(scols), sorted(dcols))
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    out["values_match"] = out["columns_match"] and a == b
    if not out["values_match"] and out["columns_match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
    return out


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from strata.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = build_session(cpus=8, shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            r = qs[n](spark, sf_dir).count()
            print(f"{n}: rows-only {r}")
            continue
        try:
            r = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{n}: ERROR {type(e).__name__}: {str(e)[:800]}")
            continue
        ok = r["values_match"] and r["spark_rows"] == r["oracle_rows"]
        bad += not ok
        print(("OK  " if ok else "FAIL"), r)
    print(f"failures: {bad}")


if __name__ == "__main__":
    main(sys.argv)
