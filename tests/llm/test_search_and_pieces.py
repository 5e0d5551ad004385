"""Nearest neighbours (5) and SentencePiece coding (2)."""

import os

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import op2_sentencepiece as pieces
from strata.llm import op5_ann as ann

from .helpers import ODD, documents

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    valid = {}
    for i, v, _ in rows:
        if v and None not in v and np.isfinite(v).all() and any(v) and i is not None:
            valid[i] = np.asarray(v, np.float32).astype(float)
    out = {}
    for q in valid:
        if q % 20 == 0:
            near = sorted((-float((valid[q] * x).sum()), i) for i, x in valid.items() if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def vector_rows(n=600, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim))
    x = (centers[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, dim))) * rng.uniform(0.5, 2, (n, 1))
    return [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]


def nearest(df, k=20):
    out = {}
    for r in sorted(ann.search(df, F.col("vec_id") % 20 == 0, k).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def check_exact_fields(got, rows, k):
    want = brute(rows, k)
    vectors = {i: np.asarray(v, np.float32).astype(float) for i, v, _ in rows if v and None not in v}
    assert set(got) == set(want)
    hits = total = 0
    for q, found in got.items():
        assert [r for r, *_ in found] == list(range(1, len(want[q]) + 1))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        assert all(abs(s - float((vectors[q] * vectors[i]).sum())) < 1e-12 for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for i, _ in want[q]})
        total += len(want[q])
    return hits / total


def test_recall_against_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).withColumn("table", F.lit("clash")).repartition(4)
    assert check_exact_fields(nearest(df), rows, 20) >= 0.9


@pytest.mark.parametrize("shape", ["clustered", "lognormal", "tiny"])
def test_every_query_finds_most_of_its_neighbours(spark, shape):
    rng = np.random.default_rng(4)
    if shape == "clustered":
        x = rng.normal(0, 1, (40, 32))[rng.integers(0, 40, 4000)] + rng.normal(0, .15, (4000, 32))
    else:
        x = rng.normal(0, 1, (3000, 32)) * (rng.lognormal(0, 1, (3000, 1)) if shape == "lognormal" else 1e-170)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    asked = np.arange(0, len(x), 20)
    unit = x / np.abs(x).max()
    scores = unit[asked] @ unit.T
    scores[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-scores, axis=1)[:, :20]
    recall = [len(set(got[int(q)]) & set(map(int, n))) / 20 for q, n in zip(asked, near)]
    if shape == "tiny":     # all products are 0 in double precision: ties, but no query is lost
        assert sorted(got) == asked.tolist() and all(len(v) == 20 for v in got.values())
    else:
        assert np.mean(recall) >= 0.95 and min(recall) >= 0.5


def test_a_third_of_all_rows_share_one_vector(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 32)
    rows = [(i, rows_v if i % 3 else [1.0] * 8, 0) for i, rows_v, _ in vector_rows(300)]
    assert check_exact_fields(nearest(spark.createDataFrame(rows, VECTORS).repartition(4)), rows, 20) >= 0.9
    # Ties of the shared vector go to the smallest ids.
    got = nearest(spark.createDataFrame(rows, VECTORS))
    shared = [i for i, v, _ in rows if v == [1.0] * 8]
    tied = [i for _, i, s in got[0] if abs(s - 8.0) < 1e-12]
    assert tied == [i for i in shared if i != 0][:len(tied)]


def test_odd_vectors_and_too_few_candidates(spark):
    rows = [(0, [1.0, 0.0], 0), (20, [0.0, 0.0], 0), (40, None, 0), (60, [float("nan"), 1.0], 0), (80, [None, 1.0], 0),
            (100, [float("inf"), 1.0], 0), (1, [0.5, 0.5], 0), (2, [-1.0, 0.0], None), (3, [100.0, 3.0], 0), (4, [], 0),
            (None, [1.0, 1.0], 0), (5, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (6, [1.0, 2.0, 3.0], 0)]
    got = nearest(spark.createDataFrame(rows, VECTORS))
    assert got == {0: [(1, 3, 100.0), (2, 5, 1.0), (3, 1, 0.5), (4, 2, -1.0)]}
    assert nearest(spark.createDataFrame([], VECTORS)) == {}


@pytest.mark.parametrize("width", [1e9, 1e-9], ids=["buckets", "fallback"])
def test_repeated_ids_take_one_place(spark, monkeypatch, width):
    """An id repeated more than k times (as it is, or with other vectors) leaves
    the other places of its bucket, or of its part, to other ids."""
    build = ann.build

    def fixed(*args):
        index = build(*args)
        index.width = width         # one bucket holds all vectors, or one vector
        return index
    monkeypatch.setattr(ann, "build", fixed)
    rows = [(i, v, 0) for i, v, _ in vector_rows(100)]
    best = {q: found[0][0] for q, found in brute(rows, 1).items()}
    twice = rows + rows
    copies = rows + [r for r in rows if r[0] in best.values()] * 30
    others = rows + [(i, [c * (0.5 + j / 60) for c in v], 0) for i, v, _ in rows
                     if i in best.values() and i % 20 for j in range(30)]
    want = brute(rows, 20)
    for table in (twice, copies):
        assert check_exact_fields(nearest(spark.createDataFrame(table, VECTORS).repartition(4)), rows, 20) == 1
    got = nearest(spark.createDataFrame(others, VECTORS).repartition(4))
    for q in want:
        assert [r for r, *_ in got[q]] == list(range(1, 21)) and len({i for _, i, _ in got[q]}) == 20
        assert {i for i, s in want[q]} == {i for _, i, _ in got[q]}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-5, 5, width=32), min_size=1, max_size=4))
def test_probes_come_in_order_of_their_estimated_cost(cell):
    cell = np.array(cell, float)
    home = np.floor(cell)
    x = cell - home

    def cost(p):
        d = p - home
        return float((np.where(d < 0, x, np.where(d > 0, 1 - x, 0)) ** 2).sum())
    out = ann.probes(cell, 3 ** len(cell))
    assert len({tuple(p) for p in out}) == len(out) == 3 ** len(cell)
    costs = [cost(p) for p in out]
    assert costs[0] == 0 and all(a <= b + 1e-12 for a, b in zip(costs, costs[1:]))


# -- pieces -------------------------------------------------------------------

needs_model = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no tokenizer files")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def ids_of(texts, vocabulary):
    ids, offsets = pieces.encode_texts(pa.array(texts, pa.string()), vocabulary)
    assert [d.decode() for d in pieces.decode_ids(ids, offsets, vocabulary)] == \
        [(t or "").replace("▁", " ") for t in texts]
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


@needs_model
@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(
    st.none(), st.text(max_size=40), st.text(alphabet="abehinorst  \n▁é日", max_size=60),
    st.lists(st.sampled_from(["the", "er", "ing", " ", "  ", "ation", "==", "\n\n", "    "]), max_size=20).map("".join)),
    max_size=8))
def test_ids_equal_the_library(vocabulary, library, texts):
    assert ids_of(texts, vocabulary) == [library.encode(t or "") for t in texts]


@needs_model
def test_long_words_and_many_characters(vocabulary, library):
    texts = ["x" * 20_000, "abcthe" * 3000 + " end", "".join(map(chr, range(0x4E00, 0x4E00 + 400))), " " * 1000,
             "".join(map(chr, range(0x21, 0x2500)))]
    assert ids_of(texts, vocabulary) == [library.encode(t) for t in texts]


@needs_model
def test_encode_and_decode_tables(spark, vocabulary, library):
    docs = documents(spark, ODD).withColumn("n_ids", F.lit("clash"))
    encoded = pieces.encode(docs, vocabulary)
    got = pieces.decode(encoded, vocabulary).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert r.ids == library.encode(r.text or "") and r.n_ids == len(r.ids) and r.decoded == (r.text or "")
    assert all(r.round_trip for r in pieces.encode_checked(docs, vocabulary).collect())
    assert pieces.encode(docs.limit(0), vocabulary).count() == 0


@needs_model
def test_borders_match_plain_merging(vocabulary):
    """Pairs of pieces stay apart exactly if merging their joined text says so."""
    v, rank = vocabulary, {t: r for r, t in enumerate(vocabulary.texts)}
    rng = np.random.default_rng(5)
    a, b = rng.choice(v.usable[:4000], (2, 4000))
    for x, y, hold in zip(a, b, v.borders_hold(a, b)):
        parts, _ = pieces._merge(v.texts[x] + v.texts[y], rank)
        assert hold == (parts == [v.texts[x], v.texts[y]])
