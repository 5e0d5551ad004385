"""Learned operators: toxicity (1), quality rules (9), language ID (10)."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import op1_toxicity as toxicity
from strata.llm import op9_quality as quality
from strata.llm import op10_language_id as language
from strata.llm.words import Words

from .helpers import DOCS, ODD, documents, text, words

LABELS = "doc_id long, quality int, toxic int"


def crc(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def toxic_rows(n=240):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        w = text(i, 60).split()
        if bad:
            for k in range(3):
                w[5 + 11 * k] = ["zzidiot", "zzscum", "zztrash"][k]
        rows.append((i, " ".join(w), "en", "a"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_finds_held_out_cases_and_spares_clean_ones(spark):
    rows, labels = toxic_rows()
    docs = documents(spark, rows).drop("lang", "source").withColumn("score", F.lit("clash"))
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [(i, t) for i, _, t in labels if crc(i, 3) == 1]
    assert len(held) > 50
    assert [(got[i] >= toxicity.THRESHOLD) for i, _ in held] == [bool(t) for _, t in held]
    assert len(model[0]) < 2000         # L1 keeps few weights


def test_toxicity_learns_no_held_out_label(spark):
    rows, labels = toxic_rows(60)
    docs = documents(spark, rows)
    first = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    turned = [(i, q, 1 - t if crc(i, 3) == 1 else t) for i, q, t in labels]
    second = toxicity.fit(docs, spark.createDataFrame(turned, LABELS))
    assert all((a == b).all() for a, b in zip(first, second))


def test_toxicity_of_odd_rows_and_without_labels(spark):
    docs = documents(spark, ODD)
    none = toxicity.fit(docs, spark.createDataFrame([(1, None, None), (5, 1, 0)], LABELS))
    got = toxicity.score(docs, none).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.0}
    labels = [(5, 1, 0), (5, 1, 1), (6, None, 1), (7, 0, 0), (None, 0, 1), (11, 0, 1), (11, 0, 1)]
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(spark.createDataFrame([], DOCS), model).count() == 0


def test_ftrl_matches_its_closed_form():
    """One coordinate against the update rule written out plainly."""
    def weight(z, n):
        return 0.0 if abs(z) <= toxicity.L1 else -(z - np.sign(z) * toxicity.L1) / (
            (toxicity.BETA + n ** 0.5) / toxicity.ALPHA + toxicity.L2)

    m, z, n = toxicity.Ftrl(), 0.0, 0.0
    f, other = np.array([3]), np.array([4])
    for i in range(40):
        label = int(i % 4 == 0)
        w = weight(z, n)
        g = 1 / (1 + np.exp(-(m.intercept + w))) - label
        m.learn(f if label else other, label)
        if label:
            z, n = z + g - ((n + g * g) ** 0.5 - n ** 0.5) / toxicity.ALPHA * w, n + g * g
    assert np.isclose(m.z[3], z) and np.isclose(m.n[3], n) and np.isclose(m.weights(f)[0], weight(z, n))
    assert weight(z, n) > 0


# -- quality ------------------------------------------------------------------

def brute_statistics(t):
    t = t or ""
    w = words(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    counts = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    again = [False] * len(w)
    for i in range(len(w) - 7):
        if counts[tuple(w[i:i + 8])] > 1:
            again[i:i + 8] = [True] * 8
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, sum(again)]


def quality_rows():
    rows, labels = [], []
    for i in range(200):
        w = text(i, 50).split()
        bad = i % 5 == 0
        rows.append((i, " ".join(x + "###" if bad and k % 2 else x for k, x in enumerate(w)), "en", "a"))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_quality_statistics_match_brute_force(spark):
    rows = ODD + [(50, "a b c d e f g h\na b c d e f g h\n\n a\n a\na b", "en", "a"), (51, "é|<x>\r\né|<x>\r\n", "en", "a"),
                  (52, " ".join([text(1, 9)] * 5), "en", "a")]
    got = quality.judge(documents(spark, rows), None).collect()
    assert sorted([str(r.doc_id), *(r[s] for s in quality.STATISTICS)] for r in got) == \
        sorted([str(i), *brute_statistics(t)] for i, t, *_ in rows)
    for r in got:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert (r.base_failed, r.kept) == (failed, not failed)


def test_quality_classifier_on_unseen_rows(spark):
    rows, labels = quality_rows()
    docs = documents(spark, rows).withColumn("kept", F.lit("clash"))
    model = quality.fit(docs, spark.createDataFrame(labels[:150] + [(1, None, 0)], LABELS))
    got = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    assert all(got[i].kept == bool(q) for i, q, _ in labels[150:])
    p = [got[i].probability for i, q, _ in labels if q]
    assert 0.5 < min(p) and max(p) <= 1


def test_quality_without_both_labels_uses_statistics_alone(spark):
    rows, labels = quality_rows()
    docs = documents(spark, rows)
    assert quality.fit(docs, spark.createDataFrame([(i, 1, 0) for i in range(50)], LABELS)) is None
    assert quality.fit(docs, spark.createDataFrame([], LABELS)) is None
    assert quality.judge(spark.createDataFrame([], DOCS), None).count() == 0


def test_linear_scores_equal_the_feature_vectors():
    w = Words(pa.array(["", "a", "ab cd ab cd", None, "x y z " * 20]))
    weights = np.random.default_rng(0).normal(size=quality.FAMILIES << quality.BITS).astype(np.float32)
    want = [0.25 + float(weights[f].astype(np.float64) @ x) for f, x in quality.vectors(w)]
    assert np.allclose(quality.logits(w, weights, 0.25), want, atol=1e-3)


# -- language -----------------------------------------------------------------

def language_rows(n=160):
    """Three invented languages over different syllables."""
    sets = {"aa": ["ba", "lo", "mi"], "bb": ["strk", "ung", "ver"], "cc": ["ção", "que", "ñe"]}
    rows = []
    for i in range(n):
        lang = sorted(sets)[i % 3]
        w = ["".join(sets[lang][int(c) % 3] for c in str(7 ** 9 * (i + 1) * (k + 3))[:4]) for k in range(30)]
        rows.append((i, " ".join(w), lang, "a"))
    return rows


def test_language_of_held_out_rows(spark):
    rows = language_rows()
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in language.predict(docs.withColumn("score", F.lit("clash")), language.fit(docs)).collect()}
    held = [r for r in rows if crc(r[0], 4) == 2]
    assert len(held) > 20
    assert all(got[i].lang_pred == lang and got[i].score > 0.9 for i, _, lang, _ in held)


def test_language_learns_from_no_held_out_row(spark):
    rows = language_rows(60)
    model = language.fit(documents(spark, rows))
    other = language.fit(documents(spark, [(i, "zz " * 9 if crc(i, 4) == 2 else t, x, s) for i, t, x, s in rows]))
    assert model[0] == other[0] and (model[1] == other[1]).all()


def test_mixture_proportions(spark):
    rows = language_rows()
    a, b = rows[0][1], rows[1][1]
    docs = documents(spark, [(900, f"{a} {a} {a} {b}", None, "x"), (901, a + " " + b, None, "x")])
    got = {r.doc_id: r for r in language.predict(docs, language.fit(documents(spark, rows))).collect()}
    assert [x.lang for x in got[900].languages] == ["aa", "bb"]
    share = {x.lang: x.share for x in got[900].languages}
    assert abs(sum(share.values()) - 1) < 1e-9 and share["aa"] > share["bb"] > 0.1
    assert len(got[901].languages) == 2


def test_language_with_one_labelled_row_is_learned(spark):
    """Among more labelled rows than any sample of 20,000 holds."""
    rare = [i for i in range(50_000, 50_100) if crc(i, 4) != 2][:20]
    docs = (spark.range(40_000).selectExpr("id AS doc_id", "'ba bo bu' AS text", "'aa' AS lang")
            .unionByName(spark.createDataFrame([(i, "qiqi xexe", f"r{n:02}") for n, i in enumerate(rare)],
                                               "doc_id long, text string, lang string")))
    assert language.fit(docs)[0] == ["aa", *(f"r{n:02}" for n in range(20))]


def test_language_of_odd_rows(spark):
    docs = documents(spark, ODD)
    model = language.fit(documents(spark, language_rows(60)))
    got = language.predict(docs, model).collect()
    assert len(got) == len(ODD)
    for r in got:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letter) and 0 <= r.score <= 1
    none = language.fit(spark.createDataFrame([], DOCS))
    assert none[0] == [] and {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}


def test_grams_by_hand():
    doc, _, has = language.grams(pa.array(["ab", "a1b", "", None, "12"]))
    # "ab": a b; _a ab b_; _ab ab_.  "a1b": a b; _a a_ _b b_; _a_ _b_.
    assert np.bincount(doc, minlength=5).tolist() == [7, 2 + 4 + 2, 0, 0, 0]
    assert has.tolist() == [True, True, False, False, False]
