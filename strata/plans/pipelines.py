"""The layered pipeline end to end: bronze -> silver -> gold, one write per
output, counts observed during the writes, one audit row per step.

A run is a set of steps (``STEPS``), each after those whose tables it reads;
``run_layers`` builds all of them: it lands the source files, stages the extracts, builds the
account, product and time dimensions, resolves the invoice fact against the
stored dimensions (as the fact step reads the dimension tables), refreshes the
fact partitions, applies retention for gold and appends the audit log.  Every
table is written under ``Zones.root`` — the shared scratch root of the session
by default — so a lost executor costs a task retry, not the pipeline.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.audit import audit_frame, observed
from strata.operators.contract import assert_schema
from strata.operators.merge import upsert
from strata.operators.quality import split_unresolved
from strata.operators.refresh import refresh_partitions
from strata.plans import account, extracts, invoice, product, time
from strata.session import discard, scratch_path
from strata.sources.files import MALFORMED, SOURCE, header_files
from strata.sources.tables import read_optional
from strata.sources.testdata import (ACCOUNT_SOURCE_SCHEMA, PRODUCT_SOURCE_SCHEMA, account_files, header_variants,
                                     invoice_lines, invoice_source_rows, product_files, table, version_effective)
from strata.sources.writers import write_control_table, write_csv, write_table

AS_OF = "2001-11-04"
RUN_ID = "run-0001"
LOAD_TS = "2001-11-04 06:00:00"


@dataclass
class Zones:
    root: str
    events: list = field(default_factory=list)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"


def _write(df: DataFrame, path: str, zones: Zones, step: str, partition_by=None,
           dynamic: bool = False, clustered: bool = False) -> None:
    out, obs = observed(df, step)
    write_table(out, path, partition_by=partition_by, dynamic=dynamic, clustered=clustered)
    zones.events.append(("INFO", step, path, obs.get["rows"]))


def land_invoices(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the invoice source files as they arrive: CSV with a header, one
    directory per arrival day; a day that holds a large share of the rows is
    written by several tasks, each of them a packed file."""
    write_csv(invoice_source_rows(invoice_lines(spark, sf_dir)), path, partition_by=[SOURCE],
              options={"compression": "gzip"})
    return path


def land_variants(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The invoice source files with wrong headers among them."""
    for rows in header_variants(invoice_source_rows(invoice_lines(spark, sf_dir))).values():
        write_csv(rows, path, partition_by=[SOURCE], mode="append")
    return path


@dataclass
class Run:
    """One run of the pipeline into ``zones``.  A step is built once, after the steps
    whose tables it reads, so a table that is asked for costs the steps it comes
    from and no others.  ``landed`` gives the folder of the invoice source files."""

    spark: SparkSession
    sf_dir: str
    zones: Zones
    landed: Callable[[], str]
    as_of: str = AS_OF
    load_ts: str = LOAD_TS
    built: set = field(default_factory=set)

    def build(self, name: str) -> None:
        if name not in self.built:
            for needed in STEPS[name].needs:
                self.build(needed)
            STEPS[name].build(self)
            self.built.add(name)

    def path(self, layer: str, name: str) -> str:
        """The path of a table, which is built if it is not yet."""
        self.build(STEP_OF[f"{layer}/{name}"])
        return self.zones.path(layer, name)

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))


def land(spark: SparkSession, sf_dir: str, zones: Zones) -> str:
    """Raw zone: the invoice source files."""
    return land_invoices(spark, sf_dir, zones.path("bronze", "raw/invoice"))


def ingest_extracts(run: Run, name: str, files: Callable[[SparkSession, str], dict[str, DataFrame]],
                    expected: T.StructType) -> extracts.Bronze:
    """Account or product files landed and taken in: contract, stage, archive and
    reject zones (see ``strata.plans.extracts``)."""
    landed = extracts.land(files(run.spark, run.sf_dir), run.zones.path("bronze", f"raw/{name}"))
    return extracts.ingest(run.spark, landed, expected, extracts.Bronze(run.zones.path("bronze", f"extracts/{name}")))


def stage_accounts(run: Run) -> None:
    bronze = ingest_extracts(run, "account", account_files, ACCOUNT_SOURCE_SCHEMA)
    accounts = extracts.staged(run.spark, bronze).drop(MALFORMED)
    version = F.regexp_extract(SOURCE, r"(\d+)$", 1).cast("int").alias("version")
    _write(accounts.select(*(c for c in accounts.columns if c != SOURCE), version),
           run.zones.path("bronze", "stage/account"), run.zones, "stage account extracts", partition_by=["version"])


def stage_products(run: Run) -> None:
    bronze = ingest_extracts(run, "product", product_files, PRODUCT_SOURCE_SCHEMA)
    products = extracts.staged(run.spark, bronze).where(F.col(SOURCE) == "product")
    _write(products.drop(SOURCE, MALFORMED), run.zones.path("bronze", "stage/product"), run.zones, "stage product nodes")


def merge_products(spark: SparkSession, source: DataFrame, zones: Zones, load_ts: Column) -> None:
    """Product silver is merged, not overwritten: a rerun keeps the insert time
    of known SKUs and moves the modification time of changed ones."""
    path = zones.path("silver", "product")
    target = read_optional(spark, path)
    if target is None:
        target = source.limit(0).withColumns({"InsertedDateTime": load_ts, "ModifiedDateTime": load_ts})
    merged = upsert(target, source, ["SourceSystemSKUId"],
                    [c for c in source.columns if c != "SourceSystemSKUId"], load_ts)
    # A table cannot be overwritten while it is read.
    staged = scratch_path(spark, "product-merge")
    write_table(merged, staged)
    _write(spark.read.parquet(staged), path, zones, "product silver")
    discard(spark, staged)


def _stamp(run: Run) -> Column:
    return F.lit(run.load_ts).cast("timestamp_ntz")


def account_silver(run: Run) -> None:
    staged = run.read("bronze", "stage/account")
    _write(account.exceptions(staged), run.zones.path("silver", "exception/account"), run.zones,
           "account exceptions")
    versions = account.silver(staged, version_effective)
    _write(versions.withColumns({
        "InsertedDateTime": _stamp(run), "ModifiedDateTime": _stamp(run),
        "EndDateTime": F.coalesce("DateClosed", "ValidTo")}), run.zones.path("silver", "account"), run.zones,
        "account silver")


def account_gold(run: Run) -> None:
    _write(account.gold(run.read("silver", "account")), run.zones.path("gold", "account"), run.zones, "account gold")


def product_silver(run: Run) -> None:
    nodes = run.read("bronze", "stage/product")
    _write(product.all_exceptions(nodes), run.zones.path("silver", "exception/product"), run.zones,
           "product exceptions")
    merge_products(run.spark, product.silver(nodes), run.zones, _stamp(run))


def product_gold(run: Run) -> None:
    _write(product.gold(run.read("silver", "product")), run.zones.path("gold", "product"), run.zones, "product gold")


def time_dimension(run: Run) -> None:
    days = time.dim_time(time.span_from(table(run.spark, run.sf_dir, "orders"), "o_orderdate"), run.as_of)
    _write(days, run.zones.path("silver", "time"), run.zones, "time dimension")


def invoice_contract(run: Run) -> None:
    _write(header_files(invoice.bronze(run.spark, run.landed())), run.zones.path("bronze", "contract/invoice"),
           run.zones, "invoice files with the contract's header")


def invoice_gate(run: Run) -> None:
    raw = invoice.bronze(run.spark, run.landed())
    gated = invoice.gated(invoice.typed(raw, run.read("bronze", "contract/invoice")))
    _write(gated.withColumn("outcome", F.when(F.col("reason").isNull(), "valid").otherwise("rejected")),
           run.zones.path("bronze", "gated/invoice"), run.zones, "invoice gate", partition_by=["outcome"],
           clustered=True)


def invoice_star(run: Run) -> None:
    valid_rows = run.read("bronze", "gated/invoice").filter(F.col("outcome") == "valid").drop("outcome", "reason")
    accounts = run.read("gold", "account").select("AccountNo", "AccountSkey")
    products = run.read("gold", "product").select("SkuCode", "ProductSkey")
    days = run.read("silver", "time").select("Date", "TimeSkey")
    _write(invoice.lookup(valid_rows, accounts, products, days, clustered=True), run.zones.path("silver", "star/invoice"),
           run.zones, "invoice star lookup")


def _split_star(run: Run) -> tuple[DataFrame, DataFrame]:
    return split_unresolved(run.read("silver", "star/invoice"), list(invoice.KEY_COLS))


def invoice_exceptions(run: Run) -> None:
    _write(_split_star(run)[1], run.zones.path("silver", "exception/invoice"), run.zones, "invoice exceptions")


def invoice_silver(run: Run) -> None:
    path = run.zones.path("silver", "fact/invoice")
    valid, obs = observed(_split_star(run)[0], "invoice silver refresh")
    refresh_partitions(valid, path, ["Year", "Month"], clustered=True)     # as the star table is
    run.zones.events.append(("INFO", "invoice silver refresh", path, obs.get["rows"]))


def invoice_gold(run: Run) -> None:
    gold = run.zones.path("gold", "fact/invoice")
    _write(invoice.gold(run.read("silver", "fact/invoice"), run.as_of), gold, run.zones, "invoice gold")
    assert_schema(run.spark.read.parquet(gold), invoice.GOLD_SCHEMA)


@dataclass(frozen=True)
class Step:
    build: Callable[[Run], None]
    tables: tuple[str, ...]         # what it writes
    needs: tuple[str, ...] = ()     # the steps whose tables it reads


STEPS = {
    "account extracts": Step(stage_accounts, ("bronze/extracts/account", "bronze/stage/account")),
    "product extracts": Step(stage_products, ("bronze/extracts/product", "bronze/stage/product")),
    "account silver": Step(account_silver, ("silver/exception/account", "silver/account"), ("account extracts",)),
    "account gold": Step(account_gold, ("gold/account",), ("account silver",)),
    "product silver": Step(product_silver, ("silver/exception/product", "silver/product"), ("product extracts",)),
    "product gold": Step(product_gold, ("gold/product",), ("product silver",)),
    "time": Step(time_dimension, ("silver/time",)),
    "invoice contract": Step(invoice_contract, ("bronze/contract/invoice",)),
    "invoice gate": Step(invoice_gate, ("bronze/gated/invoice",), ("invoice contract",)),
    "invoice star": Step(invoice_star, ("silver/star/invoice",),
                         ("invoice gate", "account gold", "product gold", "time")),
    "invoice exceptions": Step(invoice_exceptions, ("silver/exception/invoice",), ("invoice star",)),
    "invoice silver": Step(invoice_silver, ("silver/fact/invoice",), ("invoice star",)),
    "invoice gold": Step(invoice_gold, ("gold/fact/invoice",), ("invoice silver",)),
}
STEP_OF = {name: step for step, s in STEPS.items() for name in s.tables}


def finish(run: Run, run_id: str = RUN_ID) -> Zones:
    """Build every step that is not built yet and append the run's audit rows."""
    for name in STEPS:
        run.build(name)
    write_control_table(audit_frame(run.spark, run_id, run.zones.events), run.zones.path("logs", "audit"))
    return run.zones


def run_layers(spark: SparkSession, sf_dir: str, root: str | None = None,
               landed: str | None = None, as_of: str = AS_OF, run_id: str = RUN_ID) -> Zones:
    zones = Zones(root or scratch_path(spark, "zones"))
    landed = landed or land(spark, sf_dir, zones)
    return finish(Run(spark, sf_dir, zones, lambda: landed, as_of), run_id)


def main(argv: list[str] | None = None) -> None:
    """``python -m strata.plans.pipelines --sf-dir DIR [--root ROOT]``: run
    every layer and print the audit rows of the run."""
    import argparse

    from strata.session import build_session
    p = argparse.ArgumentParser(description=main.__doc__)
    p.add_argument("--sf-dir", required=True, help="directory of the source parquet tables")
    p.add_argument("--root", default=None, help="zone root (default: under spark.checkpoint.dir)")
    p.add_argument("--as-of", default=AS_OF)
    p.add_argument("--run-id", default=RUN_ID)
    a = p.parse_args(argv)
    spark = SparkSession.getActiveSession() or build_session(app="strata-pipeline")
    zones = run_layers(spark, a.sf_dir, root=a.root, as_of=a.as_of, run_id=a.run_id)
    print(f"zones: {zones.root}")
    for t, step, path, rows in zones.events:
        print(f"{t:5} {step:28} {rows:>10}  {path}")


if __name__ == "__main__":
    main()
