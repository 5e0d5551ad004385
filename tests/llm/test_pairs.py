"""Operators on repeated text: n-gram Jaccard join (8) and substring dedup (6)."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import op8_ngram_jaccard as op8
from strata.llm.components import components
from strata.llm.op6_substring_dedup import cut_repeats, decode, drop_repeats, encode

from .helpers import DOCS, ODD, documents, stored, text, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = words((t or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute_classes(rows):
    """doc row -> (set size, smallest id reachable by links), over all pairs."""
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids else None))
    return out


def near_rows():
    """A passage in all texts, near copies round the threshold, and a large
    group of variants of one text."""
    rows, base = [], text(1, 120).split()
    passage = text(99, 60)
    for i in range(60):                                     # variants of one text
        w = list(base)
        for k in range(i % 9):
            w[(i * 7 + k * 13) % len(w)] = f"edit{i}_{k}"
        rows.append((i, " ".join(w).upper() if i % 5 == 0 else " ".join(w)))
    for i in range(60, 100):                                # a shared passage
        rows.append((i, passage + " " + text(i, 5 * (i - 60))))
    for i in range(100, 130):                               # prefixes: sizes differ
        rows.append((i, " ".join(text(7, 200).split()[:60 + 4 * (i - 100)])))
    rows += [(130 + i, text(130, 3)) for i in range(3)]
    return [(i, t, "en", "a") for i, t in rows]


@pytest.mark.parametrize("rows", [ODD, near_rows()], ids=["odd", "near"])
def test_jaccard_classes_match_all_pairs(spark, rows):
    got = op8.jaccard_classes(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == \
        sorted(brute_classes(rows), key=str)


def test_long_columns_use_blocks_and_salts(spark, monkeypatch):
    """Columns beyond every size limit, split small: the same classes."""
    for name, value in (("BLOCK", 4), ("RUN", 8), ("LONG", 2)):
        monkeypatch.setattr(op8, name, value)
    rows = near_rows()
    got = op8.jaccard_classes(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_classes(rows))


@pytest.mark.parametrize("block", [1024, 4])
def test_all_links_are_found_and_counted(spark, monkeypatch, block):
    """Also those inside a group of near copies, which the classes do not need."""
    monkeypatch.setattr(op8, "BLOCK", block)
    rows = near_rows() + [(500, near_rows()[3][1], "en", "a"), (501, None, "en", "a"), (502, "", "en", "a")]
    sets = {i: shingles(t) for i, t, *_ in rows}
    links = {(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    docs = documents(spark, rows)
    got = op8.jaccard_counts(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_classes(rows))
    assert {r.doc_id: r.n_links for r in got} == {i: sum(i in pair for pair in links) for i in sets}
    of = {}
    for r in got:
        of.setdefault(r.node, []).append(r.doc_id)
    pairs = [(r.a, r.b) for r in op8.jaccard_links(docs).collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    assert {(min(i, j), max(i, j)) for a, b in pairs for i in of[a] for j in of[b]} == \
        {(i, j) for i, j in links if sets[i] != sets[j]}
    assert len(links) > 2 * len(rows)


def test_links_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert op8.jaccard_counts(empty).count() == 0 and op8.jaccard_links(empty).count() == 0


def test_one_document_of_each_class_stays(spark):
    rows = near_rows() + [near_rows()[0]]           # and a repeated row
    docs = documents(spark, rows).withColumn("node", F.lit("clash"))
    got = op8.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted({c for *_, c in brute_classes(rows)})


def test_jaccard_of_nothing(spark):
    assert op8.jaccard_classes(spark.createDataFrame([], DOCS)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_what_is_a_star_already_takes_no_round(spark, monkeypatch):
    """A round of ``components`` is two jobs of deep plans on the driver."""
    from strata.llm import components as module
    stored_names = []
    monkeypatch.setattr(module, "stage", lambda df, name: stored_names.append(name) or df.localCheckpoint())
    edges = [(1, 2), (1, 3), (7, 9), (9, 7), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 9: 7} and len(stored_names) == 1


def test_links_between_components_join_them(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (4, 4), (5, 4), (8, 8), (9, 8)], "node long, root long")
    more = spark.createDataFrame([(2, 5), (3, 9), (20, 21)], "a long, b long")
    got = sorted((r.node, r.root) for r in op8._joined(labels, more).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 1), (5, 1), (8, 3), (9, 3), (20, 20), (21, 20)]


def test_what_goes_to_every_task_is_small(spark):
    """Arrays of a fixed size travel packed, not as 8 or 16 MB a function."""
    bits = op8._bitmap(spark.createDataFrame([(3,), (64,), (op8.BITMAP - 1,)], "bit long"))
    assert len(bits) < 1 << 20
    got = op8._unpacked(bits, "int64")
    assert len(got) == op8.BITMAP // 64 and {i: int(got[i]) for i in got.nonzero()[0]} == \
        {0: 8, 1: 1, len(got) - 1: -(1 << 63)}
    none = spark.createDataFrame([], op8._SIGNATURES.format(id="long"))
    assert len(op8._frequent(none)) < 1 << 20


def test_each_node_of_a_block_is_labelled_once(spark):
    blocks = spark.createDataFrame([(1, 1, 9, b"")], "block long, node long, n int, columns binary")
    sketches = spark.createDataFrame([(1, b"")], "node long, sketch binary")
    labels = spark.createDataFrame([(1, 1)], "node long, root long")
    plan = op8._products(blocks, sketches, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join LeftOuter, (node" in line for line in plan.splitlines()) == 1


def test_counting_links_reads_the_texts_no_further_time(spark, monkeypatch):
    """The sets of linked nodes are there: each was compared."""
    scans, full_sets = [], op8._full_sets
    monkeypatch.setattr(op8, "_full_sets", lambda *args: scans.append(1) or full_sets(*args))
    rows = near_rows()[:40]
    got = op8.jaccard_counts(documents(spark, rows)).collect()
    assert len(got) == len(rows) and max(r.n_links for r in got) > 1 and len(scans) == 2


# -- substring dedup ----------------------------------------------------------

def brute_cut(rows, size=35):
    counts = Counter(tuple(w[i:i + size]) for _, t, *_ in rows for w in [words(t)] for i in range(len(w) - size + 1))
    out = []
    for doc_id, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if counts[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        kept = " ".join(a for a, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def repeat_rows():
    passage, other = text(1, 60), text(2, 36)
    rows = [(i, f"{text(i + 10, 20)}\n{passage}\t{text(i + 50, i)}", "en", "a") for i in range(12)]
    rows += [(20, f"{other} middle {other}", "en", "a"), (21, text(3, 34), "en", "a"), (22, text(3, 34), "en", "a")]
    rows += [(23, text(4, 35), "en", "a"), (24, text(4, 35).upper(), "en", "a"), (25, text(5, 36) + " " + text(5, 36), "en", "a")]
    return rows


@pytest.mark.parametrize("from_files", [True, False])
@pytest.mark.parametrize("rows", [ODD, repeat_rows()], ids=["odd", "repeats"])
def test_removed_windows_match_brute_force(spark, tmp_path, rows, from_files):
    docs = documents(spark, rows)
    if from_files:
        docs = stored(spark, docs, tmp_path / "docs")
    got = drop_repeats(docs)
    assert set(docs.columns) <= set(got.columns)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in got.collect()), key=str) == \
        sorted(brute_cut(rows), key=str)


@pytest.mark.parametrize("rows", [ODD, repeat_rows()], ids=["odd", "repeats"])
def test_only_the_removal_intervals_are_cut(spark, tmp_path, rows):
    rows = rows + [(900, "  def f():\n\n\treturn  1\n", "en", "a")]
    docs = stored(spark, documents(spark, rows), tmp_path / "d")
    got = cut_repeats(docs).collect()
    want = {}
    for r in brute_cut(rows):
        want.setdefault(r[0], []).append(r[1:])
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(t)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256, " ".join(words(r.text))) in want[r.doc_id]
        assert r.n_removed == sum(s.word_end - s.word_begin for s in r.spans)
        if not r.spans:
            assert r.text in texts[r.doc_id]
            continue
        (raw,) = {t.encode() for t in texts[r.doc_id]}
        left, at = b"", 0
        for s in r.spans:
            assert at <= s.byte_begin < s.byte_end
            assert words(raw[s.byte_begin:s.byte_end].decode()) == words(raw.decode())[s.word_begin:s.word_end]
            left, at = left + raw[at:s.byte_begin], s.byte_end
        assert r.text == (left + raw[at:]).decode()


def test_line_breaks_round_a_cut_stay(spark):
    passage = text(8, 40)
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate([
        f"one\n  two {passage}\n\nthree\tfour", f"five\n\n{passage} six", f"{passage}\nseven  x", f"y  eight\n{passage}\n", passage])])
    assert {r.doc_id: r.text for r in cut_repeats(docs).collect()} == {
        0: "one\n  two\n\nthree\tfour", 1: "five\n\nsix", 2: "seven  x", 3: "y  eight\n", 4: ""}


def test_cut_with_clashing_columns_and_empty_table(spark, tmp_path):
    docs = stored(spark, documents(spark, repeat_rows()).withColumn("n_words", F.lit("x")), tmp_path / "d")
    assert {r.n_words for r in drop_repeats(docs).collect()} == {w for _, w, *_ in brute_cut(repeat_rows())}
    assert drop_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_coded_hashes_round_trip():
    import numpy as np
    for top in (1, 1 << 20, (1 << 64) - 1):
        h = np.unique(np.random.default_rng(1).integers(0, top, 500, np.uint64, endpoint=True))
        assert (decode(encode(h, 0), 0) == h).all()
