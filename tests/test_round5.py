"""What queries leave on disk besides the tables they keep, on small rows made here."""

import datetime as dt
import glob
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.operators.merge import merge_partitions
from strata.operators.registry import register
from strata.session import work_dir
from strata.sources.compact import compact
from strata.sources.files import SOURCE
from strata.sources.writers import write_csv, write_table


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))

    def put(name, schema, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    put("nation", "n_nationkey int, n_name string", [(i, f"NATION {i}") for i in range(3)])
    put("customer", "c_custkey long, c_name string, c_nationkey int", [(k, f"Customer {k}", k % 3) for k in range(1, 30)])
    put("part", "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(k, f"part {k}", f"Brand#{1 + k % 3}{1 + k % 2}", f"TYPE {k % 4}", k % 50, 10.0 + k) for k in range(1, 30)])
    put("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
        [(k, 1 + k % 29, dt.datetime(1996 + k % 5, 1 + k % 12, 1 + k % 28)) for k in range(1, 200)])
    put("lineitem", "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_shipdate timestamp_ntz",
        [(k, 1 + (k + n) % 29, n, 1.0 + k % 40, 100.0 + k, 0.05, 0.02, dt.datetime(1996 + k % 5, 1 + k % 12, 1 + k % 9))
         for k in range(1, 200) for n in (1, 2)])
    return root


def _scratch(spark):
    root = work_dir(spark).replace("file:", "").replace("//", "/")
    return {name.rsplit("-", 1)[0] for name in os.listdir(f"{root}/strata")}, f"{root}/strata"


PASSING = {"product-merge", "registry-new", "merge-news", "merge-result", "compact-plan", "compact-result"}


NAMES = ["fact_valid", "star_lookup", "account_invoiced", "monthly_brand_net", "rollup_maintained", "file_compaction",
         "partition_merge", "fact_gold_numbered"]


def test_landing_and_layers_are_packed_and_passing_tables_go(tables):
    """In a session of its own: what other tests leave does not count."""
    import subprocess
    import sys
    code = f"""
import sys; sys.path.insert(0, {os.getcwd()!r})
from strata.session import build_session
spark = build_session(cpus=4, shuffle_partitions=4, extra={{"spark.checkpoint.dir": sys.argv[1]}})
from strata.plans.catalog import QUERIES
for name in {NAMES!r}:
    print(name, len(QUERIES[name](spark, {tables!r}).take(1)))
"""
    root = f"{tables}-kept"
    ran = subprocess.run([sys.executable, "-c", code, root], capture_output=True, text=True, timeout=600)
    assert ran.stdout.split()[-2 * len(NAMES):] == [x for n in NAMES for x in (n, "1")], ran.stderr[-2000:]
    kept = {os.path.basename(p).rsplit("-", 1)[0] for p in glob.glob(f"{root}/*/strata/*")}
    assert kept and not kept & PASSING
    landed = glob.glob(f"{root}/*/strata/landing-invoice-*/*/part-*")
    assert landed and all(p.endswith(".csv.gz") for p in landed)
    layers = glob.glob(f"{root}/*/strata/zones-*/*/gated/invoice/**/*.parquet", recursive=True)
    assert {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in layers} == {"ZSTD"}


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))


@pytest.mark.parametrize("write", [write_table, write_csv])
def test_a_write_leaves_no_shuffle_files(spark, tmp_path, write):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("v"))
    kept = rows.groupBy("k").count()        # keeps its shuffle files: it is no write of the library
    kept.collect()
    before = _shuffle_files(spark)
    write(rows.repartition(3, "v"), str(tmp_path / "t"), partition_by=["k"])
    until = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert len(kept.collect()) == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_operators_discard_their_scratch_tables(spark, tmp_path):
    stamp = F.lit("2001-01-01").cast("timestamp_ntz")
    rows = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 3).alias("p"), F.lit(1).alias("v"))
    before, _ = _scratch(spark) if os.path.isdir(f"{work_dir(spark).replace('file:', '')}/strata") else (set(), "")
    path = str(tmp_path / "merged")
    write_table(rows.withColumns({"InsertedDateTime": stamp, "ModifiedDateTime": stamp}), path, partition_by=["p"])
    changed = rows.withColumn("v", F.when(F.col("p") == 1, 2).otherwise(1))
    assert merge_partitions(spark, path, changed, ["k"], ["v"], ["p"], stamp) == 1
    assert merge_partitions(spark, path, changed, ["k"], ["v"], ["p"], stamp) == 0
    assert {(r.v, r.n) for r in spark.read.parquet(path).groupBy("v").agg(F.count("k").alias("n")).collect()} == {(1, 33), (2, 17)}
    keys = str(tmp_path / "keys")
    register(spark, rows, keys, ["k"])
    assert sorted(r.Skey for r in register(spark, rows, keys, ["k"]).collect()) == [*range(1, 51)]
    small = str(tmp_path / "small")
    rows.repartition(6).write.partitionBy("p").parquet(small)
    assert compact(spark, small, ["p"]) == 3 and compact(spark, small, ["p"]) == 0
    assert spark.read.parquet(small).count() == 50
    assert not (_scratch(spark)[0] - before) & PASSING


def test_packed_source_files_are_read_like_plain_ones(spark, tmp_path):
    from strata.plans import invoice
    from strata.sources.testdata import INVOICE_SOURCE_SCHEMA
    names = [f.name for f in INVOICE_SOURCE_SCHEMA]
    rows = spark.createDataFrame([(*map(str, range(len(names))), f"day{i % 2}") for i in range(6)],
                                 ", ".join(f"`{n}` string" for n in [*names, SOURCE]))
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    write_csv(rows, plain, partition_by=[SOURCE])
    write_csv(rows, packed, partition_by=[SOURCE], options={"compression": "gzip"})

    def verdicts(path):
        return {tuple(r) for r in invoice.contract(invoice.bronze(spark, path)).collect()}
    assert verdicts(packed) == verdicts(plain) == {("day0", True, 3), ("day1", True, 3)}
    one = glob.glob(f"{packed}/*/*.csv.gz")[0]
    os.makedirs(tmp_path / "flat")
    os.link(one, tmp_path / "flat" / "Invoice_1.csv.gz")
    assert [r[0] for r in invoice.contract(invoice.bronze(spark, str(tmp_path / "flat"))).collect()] == ["Invoice_1"]
