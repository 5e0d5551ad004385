"""Packing (3), sharding (4), chat formatting (7)."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import op4_sharding as sharding
from strata.llm import op7_chat_format as chat
from strata.llm.op3_packing import Bins, pack_documents

from .helpers import DOCS, ODD, documents, text, words

# -- packing ------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10), st.integers(0, 4), st.integers(0, 3)), max_size=40))
def test_bins_take_the_tightest_compatible_bin(pieces):
    bins, plain = Bins(10), []
    for size, source, cluster in pieces:
        s, c = (1 << source) >> 1, (1 << cluster) >> 1      # 0: conflicts with nothing
        fits = [(room, b) for b, (room, ss, cc) in enumerate(plain) if room >= size and not ss & s and not cc & c]
        want = min(fits)[1] if fits else len(plain)
        if not fits:
            plain.append((10, 0, 0))
        room, ss, cc = plain[want]
        assert bins.place(size, s, c) == (want, 10 - room)
        plain[want] = (room - size, ss | s, cc | c)


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_packing_is_whole_and_without_conflicts(spark, capacity):
    rows = ODD + [(100 + i, text(i % 9, 1 + i % 40), "en", f"s{i % 3 if i % 2 else 0}") for i in range(120)]
    got = pack_documents(documents(spark, rows).withColumn("block", F.lit("clash")), capacity).collect()
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.n_tokens
    want = Counter()
    for i, t, *_ in rows:
        want[i] += len(words(t))
    assert {k: v for k, v in tokens.items() if v} == {k: v for k, v in want.items() if v}
    assert set(tokens) == set(want)
    bins = defaultdict(list)
    for r in got:
        bins[r.bin_id].append(r)
        assert r.first_token == r.piece * capacity
    by_id = {i: (t, s) for i, t, _, s in rows}
    for b in bins.values():
        b.sort(key=lambda r: (r.bin_offset, r.n_tokens))
        at = 0
        for r in b:
            assert r.bin_offset == at
            at += r.n_tokens
        assert at <= capacity
        for part in (0, 1):     # one text and one source a bin
            seen = [by_id[r.doc_id][part] for r in b if by_id[r.doc_id][part] not in (None, "")]
            assert len(seen) == len(set(seen))


def test_packing_does_not_depend_on_how_rows_are_split(spark):
    rows = [(i % 300, text(i % 90, 30 + i % 40), "en", f"s{i % 4}") for i in range(500)] + [(1, "x", "en", "a")] * 40
    docs = documents(spark, rows)
    packed = [sorted(map(tuple, pack_documents(docs.repartition(n), 64).collect())) for n in (1, 7)]
    assert packed[0] == packed[1] and sum(r[3] for r in packed[0]) == sum(len(t.split()) for _, t, *_ in rows)


def test_packing_nothing(spark):
    assert pack_documents(spark.createDataFrame([], DOCS)).count() == 0


# -- sharding -----------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 50, 997])
def test_the_permutation_is_one_to_one(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, 42)).collect()]
    assert sorted(got) == list(range(n))
    assert n < 50 or got != sorted(got)


@pytest.mark.parametrize("rows", [ODD * 3, [(i, "same", "en", "a") for i in (1, 1, 1, 1, 2) for _ in range(40)]],
                         ids=["odd", "repeated"])
def test_shards_and_slots(spark, rows, monkeypatch):
    monkeypatch.setattr(sharding, "UNFOLD", 7)
    docs = documents(spark, rows).withColumn("_b", F.lit("clash"))
    got = sharding.shard_rows(docs).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert (r.law, r.grown_shard) == ("rows", None)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    again = {(r.row_number, r.shard, r.slot) for r in sharding.shard_rows(docs.repartition(5)).collect()}
    assert again == {(r.row_number, r.shard, r.slot) for r in got}


def test_sharding_nothing(spark):
    assert sharding.shard_rows(spark.createDataFrame([], DOCS)).count() == 0


# -- chat ---------------------------------------------------------------------

CONTROLS = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "\\1", "\\04", "\n", "%", "a", " ", "é", "🙂", "<", "[", "/s>"]
TURNS = "conv_id long, turn long, role string, text string"


def plain_digests(rows):
    out = {}
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t is not None, t or 0, r or "", x or ""))
    for c, turns in groups.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        lost = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(lost),
                  hashlib.sha256(lost.encode()).hexdigest())
    return out


def chat_rows():
    import random
    rnd, rows = random.Random(3), []
    for c in range(40):
        if c % 3 == 0:
            rows.append((c, 0, "system", "".join(rnd.choice(CONTROLS) for _ in range(rnd.randrange(400)))))
        for t in range(1, rnd.randrange(2, 30)):
            rows.append((c, t, rnd.choice(["user", "assistant", "tool <%0A>\n", None, "assistant"]),
                         " ".join("".join(rnd.choice(CONTROLS) for _ in range(rnd.randrange(6)))
                                  for _ in range(rnd.choice([0, 5, 80, 700])))))
    rows += [(50, 1, "user", "a"), (50, 1, "assistant", "b"), (50, 1, "assistant", "b"), (51, None, "system", None),
             (None, 0, "user", "x"), (52, 0, "system", "only"), (53, 5, "assistant", "w " * 20_000)]
    return rows


def test_reading_back_gives_every_turn_and_target_once(spark):
    rows = chat_rows()
    df = spark.createDataFrame(rows, TURNS).withColumn("cell", F.lit("clash")).repartition(4)
    windows = chat.format_windows(df)
    got = {r.conv_id: r for r in chat.digests(windows).collect()}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == plain_digests(rows)
    chars = Counter()
    for r in windows.collect():
        chars[r.conv_id] += len(r.formatted)
        assert r.formatted.count("</s>") == r.n_repeated + r.n_new == r.formatted.count("<s>")
        assert "[INST]" not in r.formatted and "[/INST]" not in r.formatted
    assert chars == {c: r.formatted_chars for c, r in got.items()}


def test_windows_keep_the_budget_the_system_turn_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, "assistant" if t % 2 else "user", text(t, 60)) for t in range(1, 60)]
    got = sorted(chat.format_windows(spark.createDataFrame(rows, TURNS)).collect(), key=lambda r: r.window)
    assert len(got) > 3 and [r.window for r in got] == list(range(len(got)))
    assert sum(r.n_new for r in got) == 60
    for r in got:
        assert r.n_tokens <= chat.BUDGET and r.formatted.startswith("<s>system\nbe kind</s>")
        assert r.n_repeated == (1 + chat.HISTORY_TURNS if r.window else 0)
        spans = [r.formatted[s.start - 1:s.start - 1 + s.length] for s in r.loss_spans]
        parts = r.formatted.split("</s>")[r.n_repeated:r.n_repeated + r.n_new]
        assert spans == [p.split("\n", 1)[1] for p in parts if p.startswith("<s>assistant\n")]


def test_only_a_turn_above_the_budget_makes_a_larger_window(spark):
    import random
    rnd, rows = random.Random(11), []
    for c in range(60):
        system = [None, 1, 60, 400, 636, 637, 900, 1500][c % 8]
        if system is not None:
            rows.append((c, 0, "system", text(c, system)))
        rows += [(c, t, "assistant" if t % 2 else "user", text(c * 40 + t, rnd.choice([1, 50, 200, 383, 500, 904, 1019, 1500])))
                 for t in range(1, rnd.randrange(2, 14))]
    windows = chat.format_windows(spark.createDataFrame(rows, TURNS).repartition(3))
    got = {(r.conv_id, r.window): r for r in windows.collect()}
    for r in got.values():
        assert r.n_tokens <= chat.BUDGET or r.n_repeated + r.n_new == 1
    for c in range(60):
        mine = [got[c, w] for w in range(sum(k[0] == c for k in got))]
        system = [None, 1, 60, 400, 636, 637, 900, 1500][c % 8]
        if system is not None and system + chat.TURN_TOKENS <= 640:      # repeated wherever it fits
            for r in mine:
                assert r.formatted.startswith("<s>system") or r.n_tokens + system + chat.TURN_TOKENS > chat.BUDGET
        elif system is not None:
            assert sum("<s>system" in r.formatted for r in mine) == 1
    plain = plain_digests(rows)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
            for r in chat.digests(windows).collect()} == plain


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(CONTROLS), max_size=30))
def test_escaping_is_reversible(parts):
    def run(t, pairs):
        for old, new in pairs:
            t = t.replace(old, new)
        return t
    raw = "".join(parts)
    for codes, banned in ((chat.CONTROL, ["<s>", "</s>", "[INST]", "[/INST]"]), (chat.ROLE_CODES, ["\n", "<"])):
        out = run(raw, codes)
        assert not any(b in out for b in banned)
        assert run(out, [(n, o) for o, n in reversed(codes)]) == raw


def test_no_conversation(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat.digests(chat.format_windows(empty)).count() == 0
