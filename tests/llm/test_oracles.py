"""The queries that SQL can express, against DuckDB on the whole sf0.001 tables."""

import pytest

from strata.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r
