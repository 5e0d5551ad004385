"""Dimension-sharded clustering (11), filter audit (12), factorisation machine (13)."""

import hashlib
import math
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import op11_lloyd as lloyd
from strata.llm import op13_quality_fm as fm
from strata.llm.op12_filter_audit import audit, contract, selectors

from .helpers import DOCS, ODD, documents, text, words
from .test_models import LABELS, crc

VECTORS = "vec_id long, embedding array<double>, `cluster.x` string"


# ---------------------------------------------------------------- op 11

def plain_lloyd(rows, dim, k, rounds):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    mark = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(((mark(i), v) for i, v in kept))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        cents = [[sum(x) // len(x) for x in zip(*(v for (_, v), o in zip(kept, own) if o == n))] if n in own else c
                 for n, c in enumerate(cents)]
    found = [(i, *nearest(v)) for i, v in kept]
    return sorted(((i, n, d, sum(e for _, e, m in found if m == n), sum(e for _, e, _ in found),
                    hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest()) for i, d, n in found),
                  key=repr)


def vectors(spark, rows):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS)
    return df.repartition(3) if rows else df


@pytest.mark.parametrize("dim", [5, 16, 37])
def test_clusters_equal_plain_lloyd(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(i, (rng.normal(0, 1, dim) + 3 * (i % 4)).tolist()) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(200, 230)]                # copies
    rows += [(7, rows[3][1]), (7, rows[7][1]), (None, rows[9][1]), (None, rows[9][1])]
    rows += [(300, None), (301, []), (302, [0.0] * (dim + 1)), (303, [None] * dim),
             (304, [math.nan] * dim), (305, [math.inf] + [0.0] * (dim - 1)), (306, [-0.0] * dim)]
    got = sorted((tuple(r) for r in lloyd.cluster(vectors(spark, rows), dim, rounds=6).collect()), key=repr)
    assert got == plain_lloyd(rows, dim, 8, 6)


def test_clusters_of_few_equal_and_no_vectors(spark):
    two = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 5.0])]
    assert sorted(map(tuple, lloyd.cluster(vectors(spark, two), 2).collect()), key=repr) == plain_lloyd(two, 2, 8, 10)
    none = lloyd.cluster(vectors(spark, [(1, None)]), 2)
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert none.count() == 0 and lloyd.cluster(vectors(spark, []), 2).count() == 0


def test_components_that_leave_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        lloyd.cluster(vectors(spark, [(1, [1e12, 0.0])]), 2).collect()


def test_cells_are_not_shuffled_in_a_round(spark, capsys):
    cells = lloyd.stage(vectors(spark, [(i, [float(i)] * 4) for i in range(9)]).select(
        "vec_id", F.col("embedding").alias("vector")).mapInArrow(
            lloyd.apply_bound(lloyd._cells, 4, pa.int64()),
            "chunk long, block int, ids array<long>, columns binary"), "test-cells")
    shards = lloyd._Shards(cells, 4, 2)
    sent = shards.nearest(np.zeros((2, 4), np.int64)).select(
        F.explode(F.sequence(F.lit(0), F.lit(1))).alias("block"), "chunk", "clusters")
    shards.cells.count()
    shards.cells.join(sent.hint("shuffle_hash"), ["block", "chunk"]).explain()
    plan = capsys.readouterr().out.split("ShuffledHashJoin", 1)[1]
    before = plan.split("InMemoryTableScan", 1)[0]
    shards.cells.unpersist()
    assert "Exchange" not in before


# ---------------------------------------------------------------- op 12

def plain_audit(rows, labels):
    ids = [(i, t or "", lang or "") for i, t, lang, _ in rows]
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}

    def fails(i, t):
        w = words(t)
        out = {"A"} if len(w) < 200 else set()
        out |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else set()
        out |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        out |= {"E"} if i is not None and any(j is not None and j < i and u == t for j, u, _ in ids) else set()
        return out
    judged = [(lang, fails(i, t), i is not None and i in good, i is not None and i in toxic) for i, t, lang in ids]
    out = {}
    for part in {lang for lang, *_ in judged}:
        own = [r[1:] for r in judged if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(f in r[0] for r in own) - len(gone), sum(r[0] == {f} for r in own),
                    sum(r[1] for r in gone), sum(r[2] for r in gone), f]
        for (p, *_), v in out.items():
            if p == part:
                v.append(shapley[v[6]])
    return out


def audited(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                               r.toxic_lost, r.filter, r.shapley] for r in df.collect()}


def test_audit_equals_every_order_run_on_its_own(spark):
    rows = ODD + [(i, text(i % 9, 150 + 20 * (i % 7), 60 if i % 3 else 4000), ["en", "de", None][i % 3], "s")
                  for i in range(100, 160)]
    rows += [(200 + i, t + ["", " $", " ABCDEFGHIJKLMNOP" * 9][i % 3], "fr", "s") for i, (_, t, _, _) in enumerate(rows[-20:])]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 230)]
    labels += [(100, 0, 1), (None, 1, 1), (101, None, None), (9999, 1, 1), (5, 1, 0)]
    docs = documents(spark, rows).withColumnsRenamed({"source": "sha", "n_chars": "pattern"}).withColumn("n", F.lit("x"))
    got = audited(audit(docs, spark.createDataFrame(labels, LABELS).withColumn("part", F.lit(0))))
    assert got == plain_audit(rows, labels)
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit(spark.createDataFrame([], DOCS), none).count() == 0
    assert audited(audit(documents(spark, ODD), none)) == plain_audit(ODD, [])


def test_selectors_contract_a_tensor_to_plain_counts():
    tensor = np.arange(64).reshape(2, 2, 2, 2, 2, 2)
    steps, chosen = selectors()
    at = steps.index(("DBACE", 2))
    assert contract(tensor, chosen["removed"])[1, at] == tensor[1, 1, 0, :, 0, :].sum()
    assert contract(tensor, chosen["kept"])[0, at] == tensor[0, 0, 0, :, 0, :].sum()
    assert contract(tensor, chosen["unique_fails"])[0, at] == tensor[0, 1, 0, 0, 0, 0]


# ---------------------------------------------------------------- op 13

def quality_rows(n=240):
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        t = text(i, 80)
        rows.append((i, " | ".join(t.split()) if bad else t, "en", "a"))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_machine_judges_held_out_rows(spark):
    rows, labels = quality_rows()
    docs = documents(spark, rows)
    for clash in ("score", "row", "used", "_text", "_score", "label", "a.b"):
        docs = docs.withColumn(clash, F.lit("caller's"))
    model = fm.fit(docs, spark.createDataFrame(labels, LABELS))
    out = fm.score(docs, model)
    assert sorted(out.columns) == sorted(docs.columns)
    got = {r["doc_id"]: r for r in out.collect()}
    held = [(i, q) for i, q, _ in labels if crc(i, 4) == 2]
    assert len(held) > 40
    assert [int(got[i]["score"] >= fm.THRESHOLD) for i, _ in held] == [q for _, q in held]
    assert all(r["_score"] == r["a.b"] == r["row"] == "caller's" for r in got.values())


def test_machine_does_not_depend_on_partitions_or_held_out_labels(spark):
    rows, labels = quality_rows(60)
    rows += [(5, "another text of id five", "en", "a"), (5, "one more text, of this id too", "en", "a"), (8, None, "en", "a")]
    models = []
    for parts, turn in ((1, 0), (4, 0), (7, 1)):
        docs = documents(spark, rows).repartition(parts)
        known = [(i, 1 - q if turn and crc(i, 4) == 2 else q, t) for i, q, t in labels]
        models.append(fm.fit(docs, spark.createDataFrame(known, LABELS).repartition(parts)))
    for other in models[1:]:
        assert other.intercept == models[0].intercept
        assert (other.weights == models[0].weights).all() and (other.factors == models[0].factors).all()


def test_identity_of_squares_equals_all_pairs():
    rng = np.random.default_rng(1)
    size = fm.size_of(["n_chars"])
    model = fm.Model(0.25, rng.normal(0, 1, size).astype(np.float32), rng.normal(0, 1, (size, fm.RANK)).astype(np.float32))
    part = pa.RecordBatch.from_pydict({
        "text": ["one two two three", None, "", "Ünïcode WORDS | & 12\nline"], "n_chars": pa.array([17, None, 0, -5], pa.int64())})
    doc, feature, value = fm.features(part, ["n_chars"])
    got = fm.logits(doc, feature, value, part.num_rows, model)
    for d in range(part.num_rows):
        f, x = feature[doc == d], value[doc == d]
        assert len(set(f.tolist())) == len(f)
        want = model.intercept + model.weights[f] @ x + sum(
            (model.factors[f[i]] @ model.factors[f[j]]) * x[i] * x[j] for i in range(len(f)) for j in range(i))
        assert got[d] == pytest.approx(want)
    trainer = fm.Trainer(size)
    trainer.w0, trainer.w, trainer.v = model.intercept, model.weights.astype(float), model.factors.astype(float)
    assert trainer.logit(feature[doc == 0], value[doc == 0]) == pytest.approx(got[0])


def test_one_step_lowers_the_loss_as_the_gradient_says():
    rng = np.random.default_rng(2)
    trainer = fm.Trainer(fm.size_of([]))
    f, x = np.array([3, 90, fm.size_of([]) - 1]), np.array([0.5, 0.7, 0.5])
    trainer.w[f] = rng.normal(0, 1, 3)
    before = trainer.logit(f, x)
    eps, at = 1e-6, trainer.v.copy()
    trainer.v[f[1], 2] += eps
    slope = (trainer.logit(f, x) - before) / eps
    trainer.v = at.copy()
    trainer.learn(f, x, 1.0)
    error = fm.sigmoid(before) - 1
    step = error * slope + fm.PENALTY * at[f[1], 2]
    assert trainer.v[f[1], 2] == pytest.approx(at[f[1], 2] - fm.RATE * step / math.sqrt(fm.FIRST + step * step), rel=1e-4)
    assert trainer.logit(f, x) > before


def test_machine_of_odd_rows_and_without_labels(spark):
    docs = documents(spark, ODD).drop("n_chars")
    none = fm.fit(docs, spark.createDataFrame([(1, 1, 1), (3, None, 1), (99, 1, 0)], LABELS))
    assert {r.score for r in fm.score(docs, none).collect()} == {0.5}
    good = fm.fit(docs, spark.createDataFrame([(6, 1, 0), (8, 1, 0)], LABELS))
    assert {round(r.score, 9) for r in fm.score(docs, good).collect()} == {1.0}
    labels = [(6, 1, 0), (6, 0, 1), (7, None, 1), (3, 0, 0), (None, 0, 1), (11, 1, 1), (11, 1, 1), (8, 1, 0)]
    model = fm.fit(docs, spark.createDataFrame(labels, LABELS))
    got = fm.score(docs, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert fm.score(spark.createDataFrame([], DOCS), model, ["doc_id"]).count() == 0


def test_training_texts_stop_at_the_byte_bound(spark):
    rows = [(i, f"text {i} " * 10, "en", "a") for i in range(50)]
    known = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, label int")
    docs = documents(spark, rows)
    all_of = fm.training_texts(docs, known, 50, 1 << 20).collect()
    some = fm.training_texts(docs.repartition(5), known, 50, 500).collect()
    assert len(all_of) == 50 and 0 < len(some) < 9 and all_of[:len(some)] == some
    assert sum(len(r.text) for r in some[:-1]) < 500 <= sum(len(r.text) for r in some)


# ---------------------------------------------------------------- clashing columns

ODD_NAMES = ["a.b", "_text", "_score", "_kept", "_pred", "_chunk", "_metadata", "row", "used", "chunk", "label", "n"]


@pytest.mark.parametrize("stored_first", [False, True])
def test_no_column_name_clashes(spark, tmp_path, stored_first):
    from strata.llm import op1_toxicity, op6_substring_dedup, op9_quality, op10_language_id
    rows, labels = quality_rows(40)
    docs = documents(spark, rows)
    for name in ODD_NAMES:
        docs = docs.withColumn(name, F.lit(f"{name} of the caller"))
    if stored_first:
        docs.write.parquet(str(tmp_path / "d"))
        docs = spark.read.parquet(str(tmp_path / "d"))
    known = spark.createDataFrame(labels, LABELS)
    results = [
        op1_toxicity.score(docs, op1_toxicity.fit(docs, known)),
        op6_substring_dedup.cut_repeats(docs), op6_substring_dedup.drop_repeats(docs),
        op9_quality.judge(docs, op9_quality.fit(docs, known)),
        op10_language_id.predict(docs, op10_language_id.fit(docs))]
    for out in results:
        assert set(docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
        got = out.collect()
        assert len(got) == len(rows)
        assert all(r[name] == f"{name} of the caller" for r in got for name in ODD_NAMES)


def test_models_do_not_depend_on_partitions(spark):
    from strata.llm import op1_toxicity, op9_quality
    rows, labels = quality_rows(60)
    labels = [(i, q, int(i % 4 == 0)) for i, q, _ in labels]
    rows += [(3, "another text of id three", "en", "a"), (3, "one more text, of this id too", "en", "a")]
    found = []
    for parts in (1, 4, 7):
        docs, known = documents(spark, rows).repartition(parts), spark.createDataFrame(labels, LABELS).repartition(parts)
        found.append((op1_toxicity.fit(docs, known), op9_quality.fit(docs, known)))
    for toxic, quality in found[1:]:
        assert all((a == b).all() for a, b in zip(toxic, found[0][0]))
        assert quality[1] == found[0][1][1] and (quality[0] == found[0][1][0]).all()


def test_languages_are_bounded(spark, monkeypatch):
    from strata.llm import op10_language_id
    monkeypatch.setattr(op10_language_id, "LANGUAGES", 3)
    rows = [(i, f"{'ab' if i % 2 else 'yz'} words here", lang, "s") for i, lang in
            enumerate(["en"] * 20 + ["de"] * 20 + [f"dirty{j}" for j in range(40)])]
    langs, table = op10_language_id.fit(documents(spark, rows))
    assert len(langs) == 3 and {"en", "de"} < set(langs) and table.shape == (1 << op10_language_id.BITS, 3)


def test_character_grams_are_of_characters():
    from strata.llm import op9_quality
    from strata.llm.words import Words
    texts = ["aé日🙂aé日🙂", "", "日", None, "é日", "plain ascii"]
    words = Words(pa.array(texts))
    code, offsets = op9_quality.characters(words)
    assert np.diff(offsets).tolist() == [len(t or "") for t in texts]
    number = {}
    for c, n in zip("".join(t or "" for t in texts), code.tolist()):
        assert number.setdefault(c, n) == n
    assert len(set(number.values())) == len(number)
    (pairs, lo, hi), (triples, low, high), *_ = op9_quality.families(words)
    assert (hi - lo).tolist() == [7, 0, 0, 0, 1, 10] and (high - low).tolist() == [6, 0, 0, 0, 0, 9]
    assert pairs[lo[0]] == pairs[lo[0] + 4] and pairs[lo[0] + 1] == pairs[lo[4]]
    assert len(set(pairs[lo[0]:lo[0] + 4].tolist())) == 4 and triples[low[0]] == triples[low[0] + 4]
