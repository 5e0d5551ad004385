"""CSV landing, header contract (C1), typed rows, quality gates (C2, C7, C20)."""

from pyspark.sql import functions as F

from strata.operators.quality import gate, split_valid
from strata.plans import invoice
from strata.sources.files import file_contract, scan_landed
from strata.sources.testdata import INVOICE_SOURCE_SCHEMA

GOOD = '''"Invoice.Number","Line.Item","Date","Account","Product","Quantity","Gross.Value","Net.Value","VAT"\r
100,"LN001",2020-01-05,"A1",501,2,24.00,20.00,4.00\r
100,"LN002",2020-01-05,"A9",501,1,12.00,10.00,2.00\r
101,"LN001",2020-02-01,"",502,1,6.00,5.00,1.00\r
102,"LN001",2020-02-02,"A2",502,3,NA,NA,NA\r
NA,NA,NA,NA,NA,NA,NA,NA,NA\r
'''
CLEAN = '''"Invoice.Number","Line.Item","Date","Account","Product","Quantity","Gross.Value","Net.Value","VAT"
200,"LN001",2020-03-01,"A1",501,1,12.00,10.00,2.00
'''
WRONG_HEADER = '''"Invoice","Line.Item","Date","Account","Product","Quantity","Gross.Value","Net.Value","VAT"
300,"LN001",2020-03-01,"A1",501,1,12.00,10.00,2.00
'''
EXTRA_COL = '''"Invoice.Number","Line.Item","Date","Account","Product","Quantity","Gross.Value","Net.Value","VAT","X"
400,"LN001",2020-03-01,"A1",501,1,12.00,10.00,2.00,7
'''
MISSING_COL = '''"Invoice.Number","Line.Item","Date","Account","Product","Quantity","Gross.Value","Net.Value"
500,"LN001",2020-03-01,"A1",501,1,12.00,10.00
'''


def _land(tmp_path, files):
    d = tmp_path / "raw"
    d.mkdir()
    for name, text in files.items():
        (d / name).write_text(text)
    return str(d)


def test_header_contract_per_file(spark, tmp_path):
    path = _land(tmp_path, {"Invoice_202001.csv": GOOD, "Invoice_202003.csv": CLEAN,
                            "Invoice_bad1.csv": WRONG_HEADER, "Invoice_bad2.csv": EXTRA_COL,
                            "Invoice_bad3.csv": MISSING_COL})
    raw = scan_landed(spark, path, INVOICE_SOURCE_SCHEMA)
    got = {r.source_file: (r.contract_ok, r.n_rows) for r in file_contract(raw).collect()}
    assert got == {"Invoice_202001": (True, 5), "Invoice_202003": (True, 1),
                   "Invoice_bad1": (False, 2), "Invoice_bad2": (False, 2),
                   "Invoice_bad3": (False, 2)}


def test_typed_rows_keep_dirty_values_as_null(spark, tmp_path):
    path = _land(tmp_path, {"Invoice_202001.csv": GOOD})
    rows = invoice.typed(scan_landed(spark, path, INVOICE_SOURCE_SCHEMA))
    assert "InvoiceNumber" in rows.columns and "GrossValue" in rows.columns
    by_no = {(r.InvoiceNumber, r.LineItem): r for r in rows.collect()}
    r = by_no[("102", "LN001")]
    assert r.GrossValue is None and r.NetValue is None and r.Quantity == 3 and not r._malformed
    assert by_no[("101", "LN001")].Account is None          # blank -> null at the boundary
    assert str(by_no[("100", "LN001")].NetValue) == "20.00"
    na = by_no[("NA", "NA")]
    assert na.Date is None and na.Quantity is None and na.Account == "NA"


def test_row_gate_reasons_and_conservation(spark, tmp_path):
    path = _land(tmp_path, {"Invoice_202001.csv": GOOD})
    tagged = invoice.gated(invoice.typed(scan_landed(spark, path, INVOICE_SOURCE_SCHEMA)))
    reasons = {(r.InvoiceNumber, r.LineItem): r.reason for r in tagged.collect()}
    assert reasons == {("100", "LN001"): None, ("100", "LN002"): None,
                       ("101", "LN001"): "Account is blank", ("102", "LN001"): None,
                       ("NA", "NA"): "Account is NA"}
    valid, rejected = split_valid(tagged)
    assert valid.count() + rejected.count() == tagged.count() == 5


def test_file_gate_rejects_whole_file(spark, tmp_path):
    path = _land(tmp_path, {"Invoice_202001.csv": GOOD, "Invoice_202003.csv": CLEAN})
    rows = invoice.typed(scan_landed(spark, path, INVOICE_SOURCE_SCHEMA))
    g = gate(rows, invoice.gate_rules(), granularity="file", max_files=10)
    kept = g.filter(F.col("reason").isNull()).select("source_file").distinct().collect()
    assert [r.source_file for r in kept] == ["Invoice_202003"]
    assert g.filter(F.col("reason") == "file rejected").count() == 3


def test_reconcile_rule_flags_mismatch(spark):
    from strata.operators.quality import reconcile_rule, tag_reasons
    df = spark.createDataFrame([(1, "12.00", "10.00", "2.00"), (2, "12.50", "10.00", "2.00")],
                               "id int, g string, n string, v string")
    df = df.select("id", *[F.col(c).cast("decimal(18,2)").alias(c) for c in "gnv"])
    out = {r.id: r.reason for r in tag_reasons(df, [reconcile_rule("g", "n", "v")]).collect()}
    assert out == {1: None, 2: "amounts do not reconcile"}


def test_streaming_csv_arrival_gates_each_file_once(spark, tmp_path):
    from strata.streaming.arrival import ingest_csv_available
    land = tmp_path / "landing"
    (land / "source_file=d1").mkdir(parents=True)
    (land / "source_file=d1" / "part-0.csv").write_text(GOOD)
    dst, chk = str(tmp_path / "stage"), str(tmp_path / "chk")
    run = lambda: ingest_csv_available(spark, f"{land}/*/", INVOICE_SOURCE_SCHEMA,
                                       invoice.stage_batch(dst), chk)
    run()
    staged = lambda: sorted((r.source_file, r.outcome) for r in spark.read.parquet(dst).collect())
    assert staged() == [("d1", "rejected")] * 2 + [("d1", "valid")] * 3
    run()                                                   # nothing new arrived
    assert len(staged()) == 5
    (land / "source_file=d2").mkdir()
    (land / "source_file=d2" / "part-0.csv").write_text(CLEAN)
    run()
    assert staged().count(("d2", "valid")) == 1 and len(staged()) == 6


def test_file_policy_salted_path_matches_broadcast_path(spark):
    from strata.operators.quality import file_policy
    df = spark.range(2000).selectExpr(
        "CAST(id AS STRING) AS n",
        "CASE WHEN id % 2 = 0 THEN 'hot' ELSE CONCAT('f', id % 40) END AS source_file",
        "CASE WHEN id = 7 OR id = 10 THEN 'bad' END AS reason")
    key = lambda r: (r.n, r.source_file, r.reason or "")
    want = sorted(file_policy(df, max_files=100).collect(), key=key)
    got = sorted(file_policy(df, max_files=None, hot_file_rows=100).collect(), key=key)
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert sum(1 for r in got if r.reason == "file rejected") == 999 + 49
