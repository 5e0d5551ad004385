"""Queries that build only the layers they read, and steps whose cost grows no faster
than their input, on small rows made here."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def accounts_only(spark, tmp_path_factory):
    """The tables that account queries read, and no lineitem or part."""
    root = str(tmp_path_factory.mktemp("accounts"))
    spark.createDataFrame([(i, f"NATION {i}") for i in range(3)], "n_nationkey int, n_name string").write.parquet(
        f"{root}/nation.parquet")
    spark.createDataFrame([(k, f"Customer {k}", k % 3) for k in range(1, 80)],
                          "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame([(k, k, dt.datetime(1994, 1, 1 + k % 28)) for k in range(1, 80)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(
        f"{root}/orders.parquet")
    return root


@pytest.mark.parametrize("name", ["set_difference", "text_clean", "account_bronze_outcome", "account_scd_closed"])
def test_account_queries_need_no_invoices(spark, accounts_only, name):
    from strata.plans.catalog import QUERIES
    assert QUERIES[name](spark, accounts_only).count() > 0


def test_a_walk_beyond_the_bound_broadcasts_nothing(spark, monkeypatch, capsys):
    from strata.operators import hierarchy
    parents = {"a": "b", "b": "c", "c": None, "m": "gone", "r0": "r1", "r1": "r0", "q": "r0", "p": "q"}
    parents |= {f"h{i:02}": "c" for i in range(20)}
    rows = spark.createDataFrame([*parents.items()], "id string, up string")

    def walk():
        return sorted((tuple(r) for r in hierarchy.walk_to_root(rows, "id", "up").collect()), key=str)
    small = walk()
    monkeypatch.setattr(hierarchy, "WALK_BROADCAST_ROWS", 0)
    assert walk() == small and len(small) == len(parents)
    seen = []
    write = hierarchy.stored

    def stored(df, name):
        capsys.readouterr()
        df.explain()
        seen.append("BroadcastHashJoin" in capsys.readouterr().out)
        return write(df, name)
    for name, value in (("stored", stored), ("HOT_KEY_ROWS", 10), ("SALT_BUCKETS", 4)):
        monkeypatch.setattr(hierarchy, name, value)
    assert walk() == small
    assert len(seen) > 9 and sum(seen) <= 4      # at most the few hot keys, beside the rows and their parents
