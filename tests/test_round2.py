"""Inputs that fixtures of the first round never held."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import session
from strata.functions.keys import key_text, wide_key
from strata.operators import hierarchy
from strata.operators.merge import upsert
from strata.operators.star import Lookup, current_members, resolve_keys
from strata.plans import invoice, product
from strata.plans.pipelines import Zones, merge_products
from strata.sources.files import file_contract, scan_landed, typed_rows
from strata.sources.testdata import invoice_lines, product_nodes
from strata.streaming.arrival import ingest_available

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("cap", [1000, 10, 3])
@pytest.mark.parametrize("repeat_days", [None, 0])
def test_late_files_lose_no_row_whatever_the_batch_size(spark, tmp_path, cap, repeat_days):
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    src, dst, chk = (str(tmp_path / n) for n in ("src", "dst", "chk"))
    days = 8
    for d in reversed(range(days)):         # the newest day arrives first
        rows = [(d * 10 + i, dt.datetime(2024, 1, 1 + d)) for i in range(10)]
        spark.createDataFrame(rows + rows[:2], schema).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(3, dt.datetime(2024, 1, 1))], schema).coalesce(1).write.mode("append").parquet(src)
    ingest_available(spark, schema, src, dst, chk, dedup_keys=["event_id"], event_time="ts",
                     repeat_days=repeat_days, max_files_per_batch=cap)
    assert sorted(r.event_id for r in spark.read.parquet(dst).collect()) == list(range(days * 10))


def test_keys_tell_delimiters_nulls_and_splits_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("N", "c"), ("\\N", "c"), ("", "c"), ("V1:a", ""), ("a", "V0:"),
            ("1:", "2"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(key_text("a", "b")).distinct().count() == df.select(wide_key("a", "b")).distinct().count() == len(rows)


@pytest.mark.parametrize("sf_dir", [SF, "/root/testdata/sf0.1"])
def test_line_keys_are_unique(spark, sf_dir):
    keyed = invoice.with_line_key(invoice_lines(spark, sf_dir), "k").select("k")
    assert keyed.count() == keyed.distinct().count()


def _ts(day):
    return F.lit(f"2024-01-{day:02d}").cast("timestamp_ntz")


def test_upsert_sees_moved_delimiters_and_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, "a|b", "c"), (2, "x", "y"), (None, "n", "n"), (4, "k", None)], "id int, p string, q string") \
        .withColumns({"InsertedDateTime": _ts(1), "ModifiedDateTime": _ts(1)})
    s = spark.createDataFrame([(1, "a", "b|c"), (2, "x", "y"), (3, "new", "1"), (3, "new", "2"), (None, "n", "m"), (4, "k", None)],
                              "id int, p string, q string")
    got = {r.id: r for r in upsert(t, s, ["id"], ["p", "q"], _ts(2)).collect()}
    assert {k: (r.p, r.q, r.InsertedDateTime.day, r.ModifiedDateTime.day) for k, r in got.items()} == {
        1: ("a", "b|c", 1, 2), 2: ("x", "y", 1, 1), 3: ("new", "2", 2, 2), None: ("n", "m", 1, 2), 4: ("k", None, 1, 1)}
    again = upsert(upsert(t, s, ["id"], ["p", "q"], _ts(2)), s, ["id"], ["p", "q"], _ts(3))
    assert {r.ModifiedDateTime.day for r in again.collect()} == {1, 2}


def test_upsert_reads_each_side_once(spark, tmp_path):
    for name in ("t", "s"):
        spark.range(100).selectExpr("id", "id as p", "timestamp_ntz'2024-01-01' as InsertedDateTime",
                                    "timestamp_ntz'2024-01-01' as ModifiedDateTime").write.parquet(str(tmp_path / name))
    t, s = (spark.read.parquet(str(tmp_path / n)) for n in ("t", "s"))
    plan = upsert(t, s.select("id", "p"), ["id"], ["p"], _ts(2))._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 3


SCHEMA = T.StructType([T.StructField("Account", T.StringType()), T.StructField("Product", T.StringType()),
                       T.StructField("N", T.IntegerType())])


def test_files_with_wrong_headers_are_told_apart_by_path(spark, tmp_path):
    files = {"a/x.csv": "Product,Account,N\nq,p,1\n", "b/x.csv": "Account,Product,N\np,q,1\n",
             "b/more.csv": "Account,Product,N,Extra\np,q,1,z\n", "b/less.csv": "Account,Product\np,q\n", "b/none.csv": "p,q,1\n",
             "d/source_file=2024-01-01/1.csv": "Account,Product,N\np,q,1\n",
             "d/source_file=2024-01-01/2.csv": "Product,Account,N\nq,p,2\n"}
    for name, text in files.items():
        path = tmp_path / name
        os.makedirs(path.parent, exist_ok=True)
        path.write_text(text)
    raw = scan_landed(spark, str(tmp_path), SCHEMA)
    assert {r.source_file: r.contract_ok for r in file_contract(raw).collect()} == {
        "a/x": False, "b/x": True, "b/more": False, "b/less": False, "b/none": False, "2024-01-01": False}
    rows = typed_rows(raw, SCHEMA).where("_header_ok").collect()
    assert sorted((r.source_file, r.Account, r.N) for r in rows) == [("2024-01-01", "p", 1), ("b/x", "p", 1)]


def test_every_sku_is_in_silver_or_in_the_exceptions(spark):
    nodes = product_nodes(spark, SF)
    skus = sorted(r[0] for r in product.sku_rows(nodes).select("Source_System_Id").collect())
    silver = [r[0] for r in product.silver(nodes).select("SourceSystemSKUId").collect()]
    bad = [r[0] for r in product.all_exceptions(nodes).where("Product_Level = 'Product_SKU'").select("Source_System_Id").collect()]
    assert sorted(silver + bad) == skus and any("hierarchy" in r.exception_reason for r in product.all_exceptions(nodes).collect())


def test_products_are_merged_on_a_rerun(spark, tmp_path):
    zones = Zones(str(tmp_path / "zones"))
    source = product.silver(product_nodes(spark, SF))
    merge_products(spark, source, zones, _ts(1))
    first = source.agg(F.min("SkuCode")).first()[0]
    moved = source.withColumn("SkuDesc", F.when(F.col("SkuCode") == first, F.lit("renamed")).otherwise(F.col("SkuDesc")))
    merge_products(spark, moved, zones, _ts(2))
    got = spark.read.parquet(zones.path("silver", "product"))
    assert {(r.InsertedDateTime.day, r.ModifiedDateTime.day, r.n) for r in got.groupBy(
        "InsertedDateTime", "ModifiedDateTime").agg(F.count("*").alias("n")).collect()} == {
        (1, 2, 1), (1, 1, source.count() - 1)}


def test_no_machine_local_scratch_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session._local_scratch(master)
    assert os.path.isdir(session._local_scratch("local[2]"))


def test_hot_and_null_parents_beyond_the_broadcast_bound(spark, monkeypatch):
    nodes = spark.createDataFrame(
        [(f"s{i}", "p1" if i % 3 else None, f"sku{i}") for i in range(60)]
        + [("p1", "b1", "pack"), ("b1", "gone", "brand"), ("s90", "p9", "sku90")], "id string, parent string, name string")
    leaves = nodes.where("id like 's%'")

    def walk():
        return sorted((tuple(r) for r in hierarchy.flatten_hierarchy(
            leaves, nodes, "id", "parent", ["L1", "L2"], {"name": "Name"}).collect()), key=str)
    small = walk()
    for name, value in (("PARENT_BROADCAST_ROWS", 0), ("HOT_KEY_ROWS", 10), ("SALT_BUCKETS", 4)):
        monkeypatch.setattr(hierarchy, name, value)
    assert walk() == small and len(small) == 61


def test_three_salted_lookups_read_the_fact_once_a_column(spark, tmp_path):
    fact = spark.range(400).selectExpr("cast(id as string) as id", "cast(id % 2 as string) as a", "cast(id % 5 as string) as b",
                                       "if(id % 7 = 0, null, cast(id % 3 as string)) as c")
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dims = spark.range(5).selectExpr("cast(id as string) as k", "id * 10 as s")
    look = [Lookup(dims, c, "k", "s", f"{c}_key") for c in "abc"]
    want = sorted(tuple(r) for r in resolve_keys(fact, look).select("id", "a_key", "b_key", "c_key").collect())
    salted = resolve_keys(fact, look, spread_by=["id"], broadcast_rows=0, hot_key_rows=50, salt_buckets=4)
    assert sorted(tuple(r) for r in salted.select("id", "a_key", "b_key", "c_key").collect()) == want
    text = salted._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [id") <= 7      # the fact, and a column of it twice a lookup


def test_the_current_member_is_the_active_and_latest_one(spark):
    dim = spark.createDataFrame([("a", 9, 0, 1), ("a", 1, 1, 2), ("b", 5, 1, 1), ("b", 3, 1, 2)],
                                "code string, skey int, isActive int, version int")
    assert {r.code: r.skey for r in current_members(dim, "code", "skey").collect()} == {"a": 1, "b": 3}
