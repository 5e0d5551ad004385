"""Late extracts, carried lookups, trees of any depth, persisted numbers, late
rows and violation bitmaps, against plain versions on small data."""

import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from strata.operators.asof import carry_as_of, overlapping_versions
from strata.operators.hierarchy import root_report, walk_to_root
from strata.operators.merge import upsert
from strata.operators.quality import file_verdicts, violation_report, violations
from strata.operators.registry import register, resolve
from strata.operators.scd import history, splice_extract
from strata.operators.star import resolve_as_of
from strata.streaming.arrival import append_new_keys
from strata.streaming.late import REASON_LATE, REASON_NO_TIME, ingest_within_watermark, read_late


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


# ---- versions -------------------------------------------------------------------

def plain_history(extracts, full):
    """Walks through every key's extracts in order."""
    out = []
    for key in {k for _, rows in extracts.items() for k, _ in rows}:
        held = None
        for v in sorted(extracts):
            now = dict(extracts[v]).get(key, "absent")
            if now == "absent":
                if v in full and held is not None:
                    out.append((key, *held, v * 10, 0))
                    held = None
            elif held is None or held[0] != now:
                if held is not None:
                    out.append((key, *held, v * 10, 0))
                held = (now, v, v * 10)
        if held is not None:
            out.append((key, *held, None, 1))
    return sorted(out, key=repr)


EXTRACTS = {1: [("a", "x"), ("b", "x"), ("c", None)], 2: [("a", "y"), ("d", "x")],
            3: [("a", "x"), ("b", "x"), ("d", "x")], 4: [("b", "z"), ("c", None), ("d", "x"), ("e", "q")]}


@pytest.mark.parametrize("full", [(), (3,), (2, 4)])
def test_history_equals_a_plain_walk(spark, full):
    staged = spark.createDataFrame([(k, x, v) for v, rows in EXTRACTS.items() for k, x in rows], "k string, x string, v int")
    got = history(staged, "k", "v", ["x"], lambda v: v * 10, full)
    assert sorted((tuple(r) for r in got.select("k", "x", "v", "ValidFrom", "ValidTo", "isActive").collect()),
                  key=repr) == plain_history(EXTRACTS, full)


def test_any_order_of_arrival_gives_the_full_recompute(spark):
    rng = random.Random(5)
    for order in rng.sample(list(permutations(EXTRACTS)), 5):
        full = rng.choice([(), (3,), (2, 4)])
        seen, current = {}, None
        for v in order:
            seen[v] = EXTRACTS[v]
            staged = spark.createDataFrame([(k, x, w) for w, rows in seen.items() for k, x in rows], "k string, x string, v int")
            known = [f for f in full if f in seen]
            current = (history(staged, "k", "v", ["x"], lambda v: v * 10, known) if current is None else
                       splice_extract(current, staged, v, "k", "v", ["x"], lambda v: v * 10, known))
            rows = [tuple(r) for r in current.select("k", "x", "v", "ValidFrom", "ValidTo", "isActive").collect()]
            assert sorted(rows, key=repr) == plain_history(seen, known), (order, full, v)
            current = spark.createDataFrame(rows, "k string, x string, v int, ValidFrom int, ValidTo int, isActive int")


# ---- as of ------------------------------------------------------------------------

def versions_and_facts(spark, seed=3):
    rng = random.Random(seed)
    versions = [(f"k{k}", k * 100 + j, j * 10, (j + 1) * 10 if j < 4 else None)
                for k in range(5) for j in range(5) if (k + j) % 4]
    facts = [(i, f"k{rng.randrange(7)}" if i % 9 else None, rng.randrange(60) if i % 11 else None) for i in range(300)]
    facts += [(i, "k1", i % 60) for i in range(1000, 1400)] * 2         # a hot key, repeated rows
    return (spark.createDataFrame(versions, "nk string, key long, ValidFrom int, ValidTo int"),
            spark.createDataFrame(facts, "i long, k string, t int"))


@pytest.mark.parametrize("hot_rows", [100, 10_000])
def test_carried_lookup_equals_the_range_join(spark, hot_rows):
    versions, facts = versions_and_facts(spark)
    got = carry_as_of(facts, versions, "k", "t", "nk", "key", "out", hot_key_rows=hot_rows, buckets=4, spread_by=["i"])
    assert got.columns == [*facts.columns, "out"]
    assert rows_of(got) == rows_of(resolve_as_of(facts, versions, "k", "t", "nk", "key", "out"))


def test_a_hot_key_is_spread_over_its_parts(spark):
    versions, facts = versions_and_facts(spark)
    got = carry_as_of(facts, versions, "k", "t", "nk", "key", "out", hot_key_rows=100, buckets=8, spread_by=["i"])
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "windowspecdefinition(_asof_key" in plan and "_asof_part" in plan
    hot = facts.where("k = 'k1'").select(F.pmod(F.xxhash64("i"), F.lit(8)).alias("p")).groupBy("p").count().collect()
    assert len(hot) == 8 and max(r["count"] for r in hot) < 200


def test_overlaps_are_reported_and_the_later_version_decides(spark):
    versions = spark.createDataFrame([("a", 1, 0, 50), ("a", 2, 20, 30), ("a", 3, 30, None), ("b", 4, 0, 10), ("b", 5, 10, 20)],
                                     "nk string, key long, ValidFrom int, ValidTo int")
    assert rows_of(overlapping_versions(versions, "nk", "key")) == [(1, 2, "a", 20, 30)]
    facts = spark.createDataFrame([("a", 25), ("a", 10), ("a", 40), ("b", 25)], "k string, t int")
    got = {(r.k, r.t): r.out for r in carry_as_of(facts, versions, "k", "t", "nk", "key", "out").collect()}
    assert got == {("a", 25): 2, ("a", 10): 1, ("a", 40): 3, ("b", 25): None}


# ---- trees ------------------------------------------------------------------------

def plain_walk(parents):
    out = {}
    for node in parents:
        way, at = [node], parents[node]
        while at is not None and at in parents and at not in way:
            way.append(at)
            at = parents[at]
        if at in way:
            out[node] = (None, None, None, "cycle" if at == node else "below a cycle")
        else:
            out[node] = (way[-1], len(way) - 1, "/".join(reversed(way)), "complete" if at is None else "parent missing")
    return out


def test_walk_equals_plain_steps(spark):
    rng = random.Random(8)
    parents = {f"n{i}": rng.choice([None, f"n{rng.randrange(60)}", f"n{rng.randrange(60)}", "gone"]) for i in range(60)}
    parents |= {f"c{i}": f"c{i - 1}" if i else None for i in range(37)}         # a chain
    parents |= {"s": "s", "t": "s", "u": "t"}                                   # names itself
    rows = [*parents.items(), (None, "n1"), ("c5", "zzz")]                      # an id twice: the smaller parent
    got = walk_to_root(spark.createDataFrame(rows, "id string, up string").repartition(3), "id", "up")
    assert {r.node: (r.root, r.depth, r.path, r.outcome) for r in got.collect()} == plain_walk(parents)
    report = {(r.root, r.outcome): (r.n_nodes, r.max_depth) for r in root_report(got).collect()}
    assert report["c0", "complete"] == (37, 36)


def test_walk_of_an_empty_list(spark):
    assert walk_to_root(spark.createDataFrame([], "id string, up string"), "id", "up").count() == 0


# ---- numbers ----------------------------------------------------------------------

def test_numbers_are_dense_stable_and_ordered(spark, tmp_path):
    path = str(tmp_path / "registry")
    loads = [[("b", 1), ("a", 2), ("a", 2), (None, 1)], [("a", 2), ("c", None), ("a", 1)], [("b", 1)]]
    expected, held = {}, []
    for rows in loads:
        df = spark.createDataFrame(rows, "x string, y int").repartition(3)
        registry = register(spark, df, path, ["x", "y"], "n")
        for key in sorted(set(rows) - set(expected), key=lambda k: [(v is not None, v) for v in k]):
            expected[key] = len(expected) + 1
        held.append({(r.x, r.y): r.n for r in registry.collect()})
        assert held[-1] == expected
    found = resolve(spark.createDataFrame([(None, 1), ("q", 1)], "x string, y int"), registry, ["x", "y"], "n")
    assert {(r.x, r.y): r.n for r in found.collect()} == {(None, 1): expected[None, 1], ("q", 1): None}
    assert dict(registry.dtypes)["n"] == "bigint"


# ---- late rows --------------------------------------------------------------------

def test_stored_late_and_repeats_make_up_what_arrived(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, at timestamp_ntz, v int").schema
    src, root = str(tmp_path / "src"), str(tmp_path / "out")

    def day(n):
        return f"2024-01-{n:02d} 00:00:00"
    loads = [[(1, day(20), 1), (2, day(19), 1), (1, day(20), 2)],
             [(3, day(2), 1), (3, day(2), 2), (4, day(18), 1), (2, day(1), 9), (5, None, 1), (None, day(21), 1)],
             [(None, day(20), 3), (3, day(2), 3), (6, day(22), 1)]]
    for rows in loads:
        df = spark.createDataFrame([(i, t, v) for i, t, v in rows], "id long, at string, v int")
        df.withColumn("at", F.col("at").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(src)
        tables = ingest_within_watermark(spark, schema, src, root, ["id"], "at", "5 days")
    again = ingest_within_watermark(spark, schema, src, root, ["id"], "at", "5 days")
    stored = sorted((r.id for r in spark.read.parquet(again.stored).collect()), key=str)
    late = sorted(((r.id, r.late_reason) for r in read_late(spark, tables, schema).collect()), key=str)
    assert stored == [1, 2, 4, 6, None]
    assert late == sorted([(3, REASON_LATE)] * 3 + [(5, REASON_NO_TIME)], key=str)
    assert spark.read.parquet(tables.arrived).count() == sum(map(len, loads))


def test_nothing_arrived_yet(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, at timestamp, v int").schema
    (tmp_path / "src").mkdir()
    ingest_within_watermark(spark, schema, str(tmp_path / "src"), str(tmp_path / "out"), ["id"], "at", "1 day")


def test_a_replayed_batch_without_event_time_appends_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, None, "a"), (2, "2024-01-01", "b")], "id long, at string, v string")
    for _ in range(2):
        append_new_keys(path, ["id"], "at", repeat_days=3)(batch.withColumn("at", F.col("at").cast("timestamp")), 0)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]


# ---- violations and upsert --------------------------------------------------------

def test_every_violation_is_counted(spark):
    rules = [("no a", F.col("a").isNull()), ("big", F.col("a") > 5), ("b is x", F.col("b") == "x")]
    df = spark.createDataFrame([("f", None, "x"), ("f", 9, "x"), ("f", 1, None), ("g", 1, "y"), ("h", 7, "y"), ("h", 1, "y")],
                               "source_file string, a int, b string").withColumn("violations", violations(rules))
    assert sorted(r.violations for r in df.collect()) == [0, 0, 0, 2, 5, 6]
    report = {(r.source_file, r.rule): r.n_violations for r in violation_report(df, rules).collect()}
    assert report == {("f", "no a"): 1, ("f", "big"): 1, ("f", "b is x"): 2, ("g", "no a"): 0, ("g", "big"): 0,
                      ("g", "b is x"): 0, ("h", "no a"): 0, ("h", "big"): 1, ("h", "b is x"): 0}
    for percent, fatal, good in ((0, (), {"g"}), (50, (), {"g", "h"}), (100, (), {"f", "g", "h"}), (100, ("no a",), {"g", "h"})):
        verdicts = file_verdicts(df, rules, percent, fatal).collect()
        assert {r.source_file for r in verdicts if r.accepted} == good
    with pytest.raises(ValueError):
        file_verdicts(df, rules, 1, ["unknown"])


def test_upsert_keeps_columns_it_does_not_update(spark):
    target = spark.createDataFrame([(1, "a", "note", "t0", "t0"), (2, "b", None, "t0", "t0")],
                                   "k int, v string, extra string, InsertedDateTime string, ModifiedDateTime string")
    source = spark.createDataFrame([(1, "z"), (3, "c")], "k int, v string")
    got = {r.k: (r.v, r.extra, r.InsertedDateTime, r.ModifiedDateTime)
           for r in upsert(target, source, ["k"], ["v"], F.lit("t1")).collect()}
    assert got == {1: ("z", "note", "t0", "t1"), 2: ("b", None, "t0", "t0"), 3: ("c", None, "t1", "t1")}


# ---- files ------------------------------------------------------------------------

def test_a_header_must_be_the_first_row_and_empty_files_honour_no_contract(spark, tmp_path):
    from pyspark.sql import types as T

    from strata.sources.files import empty_files, file_contract, scan_landed, typed_rows
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    for name, body in (("good", "a,b\nx,1\n"), ("late", "x,1\na,b\ny,2\n"), ("empty", ""), ("bare", "x,1\n"), ("only", "a,b\n")):
        (tmp_path / f"{name}.csv").write_text(body)
    raw = scan_landed(spark, str(tmp_path), schema)
    contract = file_contract(raw, empty_files(raw, str(tmp_path)))
    assert {r.source_file: (r.contract_ok, r.n_rows) for r in contract.collect()} == {
        "good": (True, 1), "late": (False, 2), "empty": (False, 0), "bare": (False, 1), "only": (True, 0)}
    assert {(r.source_file, r._header_ok) for r in typed_rows(raw, schema).collect()} == {
        ("good", True), ("late", False), ("bare", False)}


def test_extract_zones_hold_whole_rows(spark, tmp_path):
    from pyspark.sql import types as T

    from strata.plans import extracts
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    files = {"good": spark.createDataFrame([("  x ", "1", "s1"), (None, "many", "s1")], "a string, b string, source_file string"),
             "bad": spark.createDataFrame([("q", "1", "more", "s2")], "a string, b string, c string, source_file string")}
    landed = extracts.land(files, str(tmp_path / "landed"))
    bronze = extracts.ingest(spark, landed, schema, extracts.Bronze(str(tmp_path / "bronze")))
    assert {tuple(r) for r in extracts.staged(spark, bronze).select("a", "b", "_malformed", "source_file").collect()} == {
        ("  x ", 1, False, "s1"), (None, None, True, "s1")}
    assert {tuple(r) for r in extracts.outcome(spark, bronze, schema).collect()} == {
        ("s1", True, 2, 1, 2, 0), ("s2", False, 0, 0, 0, 1)}


# ---- partitions and files -----------------------------------------------------------

def files_of(spark, path, column):
    out = {}
    for r in spark.read.parquet(path).select(column, F.col("_metadata.file_path").alias("f")).distinct().collect():
        out.setdefault(r[0], set()).add(r.f)
    return out


@pytest.mark.parametrize("find_moved", [True, False])
def test_merge_rewrites_only_partitions_that_differ(spark, tmp_path, find_moved):
    from strata.operators.merge import merge_partitions
    path = str(tmp_path / "t")
    rows = [(k, f"v{k}", "x", p, "t0", "t0") for p in (1, 2, 3) for k in range(p * 10, p * 10 + 4)]
    (spark.createDataFrame(rows, "k int, v string, extra string, p int, InsertedDateTime string, ModifiedDateTime string")
     .write.partitionBy("p").parquet(path))
    before = files_of(spark, path, "p")
    source = spark.createDataFrame([(10, "v10", 1), (20, "new", 2), (25, "added", 2), (40, "first", 4)], "k int, v string, p int")
    names = (["k"], ["v"], ["p"], F.lit("t1"))
    assert merge_partitions(spark, path, source, *names, find_moved=find_moved) == 2
    after = files_of(spark, path, "p")
    assert after[1] == before[1] and after[3] == before[3] and not after[2] & before[2] and 4 in after
    got = {r.k: (r.v, r.extra, r.InsertedDateTime, r.ModifiedDateTime) for r in spark.read.parquet(path).collect()}
    assert len(got) == 14 and got[20] == ("new", "x", "t0", "t1") and got[25] == ("added", None, "t1", "t1")
    assert got[10] == ("v10", "x", "t0", "t0")
    assert merge_partitions(spark, path, source, *names, find_moved=find_moved) == 0
    assert files_of(spark, path, "p") == after
    if find_moved:
        with pytest.raises(ValueError, match="another partition"):
            merge_partitions(spark, path, spark.createDataFrame([(10, "v10", 3)], "k int, v string, p int"), *names)


def test_compaction_keeps_rows_and_other_partitions(spark, tmp_path):
    from strata.sources.compact import compact, file_list
    path = str(tmp_path / "t")
    spark.range(400).selectExpr("id", "id % 2 p").repartition(8).write.partitionBy("p").parquet(path)
    spark.range(3).selectExpr("id", "CAST(7 AS BIGINT) p").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    before = files_of(spark, path, "p")
    size = file_list(spark.read.parquet(path), ["p"]).agg(F.max("bytes")).first()[0]
    assert compact(spark, path, ["p"], target=4 * size) == 2
    after = files_of(spark, path, "p")
    assert after[7] == before[7] and all(1 <= len(after[p]) <= 3 < len(before[p]) for p in (0, 1))
    assert sorted((r.id, r.p) for r in spark.read.parquet(path).collect()) == sorted(
        [(i, i % 2) for i in range(400)] + [(i, 7) for i in range(3)])
    assert compact(spark, path, ["p"], target=size // 4) == 0


def test_maintained_rollup_equals_the_full_one(spark, tmp_path):
    from strata.operators.rollup import merged, refresh_partials
    path = str(tmp_path / "partials")
    rows = [(i, i % 3, f"d{i % 5}" if i % 11 else None, i % 700, i) for i in range(6000)]
    fact = spark.createDataFrame(rows, "id int, p int, d string, who int, v long")
    names = (["p"], ["d"], ["v"], ["who"])
    refresh_partials(fact, path, *names)
    other = files_of(spark, path, "p")
    changed = fact.withColumn("v", F.when(F.col("p") == 1, F.col("v") * 2).otherwise(F.col("v")))
    for _ in range(2):
        refresh_partials(changed, path, *names, touched=spark.createDataFrame([(1,)], "p int"))
    now = files_of(spark, path, "p")
    assert now[0] == other[0] and now[2] == other[2] and now[1] != other[1]
    for sets in ("rollup", "cube", "groupBy"):
        got = {r.d if r.n_rows != 6000 else "all": (r.n_rows, r.v) for r in merged(spark, path, ["d"], ["v"], ["who"], sets).collect()}
        full = {r.d if r.n != 6000 else "all": (r.n, r.v) for r in getattr(changed, sets)("d").agg(
            F.count(F.lit(1)).alias("n"), F.sum("v").alias("v")).collect()}
        assert got == full
    total = merged(spark, path, ["d"], ["v"], ["who"], "rollup").where("n_rows = 6000").first()
    assert abs(total.n_who - 700) <= 35


def test_types_meet_without_losing_digits():
    from pyspark.sql import types as T

    from strata.sources.evolve import common_type
    dec = T.DecimalType
    for a, b, want in [
            (T.IntegerType(), T.LongType(), T.LongType()), (T.IntegerType(), dec(10, 2), dec(12, 2)),
            (T.LongType(), dec(10, 2), dec(22, 2)), (dec(18, 2), dec(20, 4), dec(20, 4)), (dec(38, 0), dec(10, 2), None),
            (T.FloatType(), T.DoubleType(), T.DoubleType()), (T.LongType(), T.DoubleType(), None),
            (T.IntegerType(), T.DoubleType(), T.DoubleType()), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
            (T.StringType(), T.IntegerType(), None), (T.StringType(), T.StringType(), T.StringType())]:
        assert common_type(a, b) == common_type(b, a) == want


def test_batches_of_changing_types(spark, tmp_path):
    from strata.sources.evolve import append_reconciled, contract_of
    path, contract, aside = (str(tmp_path / n) for n in ("t", "c", "q"))
    loads = [spark.createDataFrame([(1, 5, "x")], "k int, v int, s string"),
             spark.createDataFrame([("y", 1 << 40, 2, 1.5)], "s string, v bigint, k int, more double"),
             spark.sql("SELECT 3 k, CAST('7.25' AS DECIMAL(5,2)) v"),
             spark.createDataFrame([("4", 1, "n"), ("four", 1, "n"), (None, 1, "n")], "k string, v int, s string")]
    for df in loads:
        out = append_reconciled(spark, df, path, contract, aside)
    assert sorted((r.k is None, r.k, str(r.v), r.s, r.more) for r in out.collect()) == [
        (False, 1, "5.00", "x", None), (False, 2, f"{1 << 40}.00", "y", 1.5), (False, 3, "7.25", None, None),
        (False, 4, "1.00", "n", None), (True, None, "1.00", "n", None)]
    assert [(r.column, "four" in r.row) for r in spark.read.parquet(aside).collect()] == [("k", True)]
    assert contract_of(spark, contract).simpleString() == "struct<k:int,v:decimal(22,2),s:string,more:double>"
