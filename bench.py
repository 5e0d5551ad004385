"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then ``$BENCH_REPS`` timed runs (median
reported).  A run executes the whole plan into Spark's ``noop`` sink, so no
result is collected to the driver.  Landing the invoice source files (fixture
preparation) and the first build of the layer tables, which downstream queries
read as each layer reads the previous one, are reported as ``setup_sec``;
``pipeline_layers`` times a full rebuild of all layers.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.catalog import QUERIES, landed_invoices, layers  # noqa: E402
from strata.plans.pipelines import run_layers  # noqa: E402
from strata.session import build_session  # noqa: E402

HEADLINE = [
    "pipeline_layers", "monthly_brand_net", "invoice_row_gate", "invoice_file_gate", "conservation",
    "account_scd_versions", "account_gold", "product_flatten", "product_upsert",
    "product_gold", "dim_time", "star_lookup", "star_lookup_as_of", "fact_gold",
    "gold_rollup", "duplicate_lines", "surrogate_keys", "partition_refresh",
    "stream_file_arrival", "stream_invoice_arrival",
]


def pipeline_layers(spark, sf_dir):
    """The whole layered pipeline (stage -> silver -> gold -> audit) into a
    fresh zone root, from the landed source files."""
    run_layers(spark, sf_dir, landed=landed_invoices(spark, sf_dir))


def run(spark, name, sf_dir):
    t = time.perf_counter()
    if name == "pipeline_layers":
        pipeline_layers(spark, sf_dir)
    else:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(app="strata-bench", cpus=cpus, shuffle_partitions=cpus * 2)
    t = time.perf_counter()
    landed_invoices(spark, sf_dir)
    layers(spark, sf_dir)
    setup = time.perf_counter() - t
    results = {}
    for n in names:
        run(spark, n, sf_dir)
        results[n] = round(statistics.median(run(spark, n, sf_dir) for _ in range(reps)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum of median query seconds", "value": round(sum(results.values()), 3),
        "unit": "sec", "queries": results, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "reps": reps, "setup_sec": round(setup, 3),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
