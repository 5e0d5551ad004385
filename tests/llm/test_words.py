import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.words import Words, chunks, covered

from .helpers import WORD

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té\x1c ", max_size=40)), max_size=12)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_windows_match_a_regular_expression(texts):
    w = Words(pa.array(texts, pa.string()))
    want = [WORD.findall(t or "") for t in texts]
    got = [[bytes(w.data[b:e]).decode() for b, e in zip(w.begin[lo:hi], w.end[lo:hi])]
           for lo, hi in zip(w.first[:-1], w.first[1:])]
    assert got == want
    hashes, at = w.windows(3)
    flat = [x for t in want for x in t]
    assert len(at) == sum(max(0, len(t) - 2) for t in want)
    seen = {}
    for h, a in zip(hashes.tolist(), at.tolist()):
        assert seen.setdefault(tuple(flat[a:a + 3]), h) == h
    assert len(set(seen.values())) == len(seen)


def test_chunks_cover_all_rows_once():
    batch = pa.record_batch({"text": pa.array(["a" * n for n in (0, 5, 50, 3, 0, 100, 1)])})
    parts = list(chunks(batch, "text", 20))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 2


def test_covered_is_the_union_of_windows():
    assert covered(np.array([1, 2, 7]), 3, 10).tolist() == [
        False, True, True, True, True, False, False, True, True, True]
