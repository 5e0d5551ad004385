"""Batches of texts of which nothing is left."""

import pytest

from strata.llm.op6_substring_dedup import cut_repeats, drop_repeats
from tests.llm.helpers import documents, stored, text, words
from tests.llm.test_pairs import brute_cut


def copies():
    """Nothing but copies, a text without words among them."""
    return [(i, text(1 + i % 3, 35 + i % 3), "en", "a") for i in range(12)] + [(12, " \n", "en", "a")]


@pytest.mark.parametrize("rows", [copies(), [(1, " \t ", "en", "a")]], ids=["copies", "blank"])
def test_all_words_of_all_texts_go(spark, tmp_path, rows):
    got = drop_repeats(stored(spark, documents(spark, rows), tmp_path / "d")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in got) == sorted(brute_cut(rows))
    assert all(r.n_removed == r.n_words for r in got)


def test_all_texts_are_cut_away(spark, tmp_path):
    from corpus_pipeline import substring_dedup
    rows = copies()
    docs = stored(spark, documents(spark, rows), tmp_path / "d")
    cut = cut_repeats(docs).collect()
    assert {r.doc_id: r.text for r in cut} == {i: "" if words(t) else t for i, t, *_ in rows}
    assert all(len(r.spans) == bool(r.n_words) for r in cut)
    staged = substring_dedup(spark, docs, str(tmp_path)).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in staged} == {
        (i, "", 0) if words(t) else (i, t, len(t)) for i, t, *_ in rows}
