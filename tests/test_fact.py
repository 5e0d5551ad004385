"""Star lookup (C10, J6, J9), quarantine (C11), refresh (C12), retention (C13),
contract (C14), audit (C16), sets (U3), duplicates (C19), streaming (S10)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.audit import audit_frame, observed
from strata.operators.contract import ContractError, assert_schema, conform
from strata.operators.quality import split_unresolved
from strata.operators.refresh import refresh_partitions, retain
from strata.operators.sets import duplicate_keys, set_difference, set_difference_all
from strata.operators.star import Lookup, resolve_as_of, resolve_keys
from strata.sources.tables import read_optional, settings_frame, settings_lookup
from strata.streaming.arrival import ingest_available

D = dt.datetime


def fact(spark):
    return spark.createDataFrame(
        [("1", "A1", "501", D(2020, 1, 5)), ("2", "A9", "501", D(2020, 1, 5)),
         ("3", "A1", "999", D(2020, 2, 1)), ("4", None, "501", D(2020, 2, 2))],
        "InvoiceNumber string, Account string, Product string, Date timestamp_ntz")


def test_star_lookup_preserves_rows_even_with_duplicate_dim_keys(spark):
    acc = spark.createDataFrame([("A1", 10), ("A1", 11), ("A2", 20)], "AccountNo string, AccountSkey long")
    prod = spark.createDataFrame([("501", 5)], "SkuCode string, ProductSkey long")
    out = resolve_keys(fact(spark), [Lookup(acc, "Account", "AccountNo", "AccountSkey", "AccountSkey"),
                                     Lookup(prod, "Product", "SkuCode", "ProductSkey", "ProductSkey")])
    got = {r.InvoiceNumber: (r.AccountSkey, r.ProductSkey) for r in out.collect()}
    assert got == {"1": (11, 5), "2": (None, 5), "3": (11, None), "4": (None, 5)}
    valid, exc = split_unresolved(out, ["AccountSkey", "ProductSkey"])
    assert valid.count() == 1 and exc.count() == 3


def test_as_of_lookup_picks_version_valid_at_date(spark):
    versions = spark.createDataFrame(
        [("A1", 1, D(2019, 1, 1), D(2020, 2, 1)), ("A1", 2, D(2020, 2, 1), None)],
        "AccountNo string, AccountSkey long, ValidFrom timestamp_ntz, ValidTo timestamp_ntz")
    out = resolve_as_of(fact(spark), versions, "Account", "Date", "AccountNo", "AccountSkey", "AccountSkey")
    got = {r.InvoiceNumber: r.AccountSkey for r in out.collect()}
    assert got == {"1": 1, "2": None, "3": 2, "4": None}


def test_refresh_replaces_only_incoming_partitions_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "fact")
    old = spark.createDataFrame([(1, 2020, 1, 10), (2, 2020, 2, 20), (3, 2020, 3, 30)],
                                "k int, Year int, Month int, q int")
    refresh_partitions(old, path, ["Year", "Month"])
    new = spark.createDataFrame([(2, 2020, 2, 21), (4, 2020, 4, 40)], "k int, Year int, Month int, q int")
    refresh_partitions(new, path, ["Year", "Month"])
    once = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "q").collect())
    refresh_partitions(new, path, ["Year", "Month"])
    twice = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "q").collect())
    assert once == twice == [(1, 10), (2, 21), (3, 30), (4, 40)]


def test_retention_window_boundary(spark):
    df = spark.createDataFrame([(D(1998, 11, 3),), (D(1998, 11, 4),), (D(2001, 11, 4),)], "Date timestamp_ntz")
    kept = [r.Date for r in retain(df, "Date", 36, "2001-11-04").collect()]
    assert kept == [D(1998, 11, 4), D(2001, 11, 4)]


def test_assert_schema_names_order_and_types(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(1, "x")], "b long, a string")
    with pytest.raises(ContractError):
        assert_schema(df, schema)
    with pytest.raises(ContractError):
        assert_schema(df.select("a", "b"), schema)
    assert assert_schema(conform(df.select(F.lit(1).alias("a"), F.lit("x").alias("b")), schema), schema)


def test_observed_counts_and_audit_rows(spark, tmp_path):
    df = spark.range(10).withColumn("bad", F.col("id") % 3 == 0)
    out, obs = observed(df, "t", {"bad": F.sum(F.col("bad").cast("int"))})
    out.write.parquet(str(tmp_path / "o"))
    assert obs.get["rows"] == 10 and obs.get["bad"] == 4
    log = audit_frame(spark, "r1", [("INFO", "m", "d", obs.get["rows"])])
    assert [(r.LogType, r.LogRowCount, r.LogRunID) for r in log.collect()] == [("INFO", 10, "r1")]


def test_set_difference_semantics(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "a int, b string")
    right = spark.createDataFrame([(1, None), (3, "y")], "a int, b string")
    assert sorted(tuple(r) for r in set_difference(left, right).collect()) == [(2, "x")]
    assert sorted(tuple(r) for r in set_difference_all(left, right).collect()) == [(1, None), (2, "x")]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("1", "LN001"), ("1", "LN001"), ("1", "LN002")], "i string, l string")
    assert [(r.i, r.l, r.n) for r in duplicate_keys(df, ["i", "l"]).collect()] == [("1", "LN001", 2)]


def test_settings_and_optional_table(spark, tmp_path):
    s = settings_frame(spark, [("SilverPath", "/silver/"), ("GoldPath", "/gold/")])
    assert settings_lookup(s) == {"SilverPath": "/silver/", "GoldPath": "/gold/"}
    assert read_optional(spark, str(tmp_path / "absent")) is None


def test_incremental_arrival_processes_each_file_once(spark, tmp_path):
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("v", T.DoubleType())])
    src, dst, chk = (str(tmp_path / n) for n in ("src", "dst", "chk"))
    spark.createDataFrame([(1, D(2024, 1, 1), 1.0), (2, D(2024, 1, 1), 2.0)], schema).write.parquet(src)
    ingest_available(spark, schema, src, dst, chk, dedup_keys=["event_id"], event_time="ts")
    assert spark.read.parquet(dst).count() == 2
    ingest_available(spark, schema, src, dst, chk, dedup_keys=["event_id"], event_time="ts")
    assert spark.read.parquet(dst).count() == 2                    # no new files -> no new rows
    spark.createDataFrame([(3, D(2024, 1, 2), 3.0), (1, D(2024, 1, 2), 9.0)], schema) \
        .write.mode("append").parquet(src)
    ingest_available(spark, schema, src, dst, chk, dedup_keys=["event_id"], event_time="ts")
    assert sorted(r.event_id for r in spark.read.parquet(dst).collect()) == [1, 2, 3]


def test_route_files_by_worst_row(spark):
    from strata.operators.quality import route_files
    df = spark.createDataFrame([("f1", None), ("f1", "bad"), ("f2", None)], "source_file string, reason string")
    got = sorted((r.source_file, r.zone) for r in route_files(df, max_files=2).collect())
    assert got == [("f1", "reject"), ("f1", "reject"), ("f2", "archive")]


def test_bounded_broadcast_only_within_bound(spark, capsys):
    from strata.operators.broadcast import bounded_broadcast
    big, small = spark.range(100), spark.range(3)
    j1 = spark.range(10).join(bounded_broadcast(small, max_rows=5), "id")
    j2 = spark.range(10).join(bounded_broadcast(big, max_rows=5), "id")
    j1.explain(); p1 = capsys.readouterr().out
    j2.explain(); p2 = capsys.readouterr().out
    assert "broadcast" in p1.lower()
    assert j2.count() == 10 and j1.count() == 3


def test_union_by_name_fills_missing_columns(spark):
    from strata.operators.sets import union_by_name
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2, 3.0)], "a string, k int, new double")
    got = sorted(tuple(r) for r in union_by_name(a, b).select("k", "a", "new").collect())
    assert got == [(1, "x", None), (2, "y", 3.0)]


def test_set_difference_all_chunks_hot_rows(spark):
    left = spark.range(2500).selectExpr("CAST(id % 3 AS INT) AS a", "IF(id % 2 = 0, NULL, 'x') AS b")
    right = spark.range(400).selectExpr("CAST(id % 3 AS INT) AS a", "IF(id % 2 = 0, NULL, 'x') AS b")
    key = lambda r: (r[0], r[1] or "")
    want = sorted((tuple(r) for r in left.exceptAll(right).collect()), key=key)
    got = sorted((tuple(r) for r in set_difference_all(left, right, copies_per_task=100).collect()), key=key)
    assert got == want and len(got) == 2100


def test_large_dimension_path_salts_hot_keys_exactly(spark):
    """Force the shuffle-join path (broadcast bound 0): a key holding half the
    fact and null keys resolve exactly as in the broadcast path."""
    fact = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS InvoiceNumber",
        "CASE WHEN id % 2 = 0 THEN 'HOT' WHEN id % 7 = 0 THEN NULL ELSE CONCAT('A', id % 50) END AS Account")
    dim = spark.range(50).selectExpr("CONCAT('A', id) AS AccountNo", "id AS AccountSkey") \
        .unionByName(spark.range(1).selectExpr("'HOT' AS AccountNo", "-1L AS AccountSkey")) \
        .unionByName(spark.range(1).selectExpr("'HOT' AS AccountNo", "-2L AS AccountSkey"))
    lk = [Lookup(dim, "Account", "AccountNo", "AccountSkey", "AccountSkey")]
    want = sorted(tuple(r) for r in resolve_keys(fact, lk).collect())
    salted = resolve_keys(fact, lk, spread_by=["InvoiceNumber"], broadcast_rows=0, hot_key_rows=100,
                          salt_buckets=8)
    got = sorted(tuple(r) for r in salted.collect())
    assert got == want and len(got) == 3000
    assert sum(1 for r in got if r[2] == -1) == 1500
