"""Substring dedup by Rabin-Karp window hashes counted in Spark.

Every window of 35 consecutive words of every text gets a rolling 64-bit hash.
A word goes when it lies in a window whose hash occurs at another place, in the
same text or another one; overlapping repeated windows merge into maximal
removal intervals.  All occurrences go, and all windows are judged on the input.

How the windows are counted without a row a window:

1. Rows are addressed by *chunk* (``CHUNK_ROWS`` neighbouring rows of one
   file; a text of ``LONG_BYTES`` is a chunk of its own, so a chunk's bytes are
   bounded too, but for a single text).  A chunk sorts its hashes, keeps two of equal ones at most, and sends
   each hash range to that range's *bucket* as one delta-coded row.
2. A bucket holds about a million windows at any corpus size (the number of
   buckets follows the input's text bytes); it finds the hashes that it
   received twice and sends each chunk its own, delta-coded too.
3. Chunks meet their repeated hashes in a co-group, where the texts are read
   again, cut and joined.

A passage or copy that a third of all texts hold costs a chunk one entry a
window, so no bucket and no chunk is hot.

``cut_repeats`` cuts the intervals' bytes and leaves everything else as it is;
``drop_repeats`` gives the kept words in the form of their digest.

Defined cases: null text counts as empty (``cut_repeats`` leaves it null); a text
without repeated windows keeps all its words; ``kept_sha256`` is taken of the kept
words joined by one space; repeated rows are separate texts (and so repeat each other); extra
columns pass through; rows that do not come from files are stored first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .io import apply_bound, carried, carry, stage
from .words import Words, chunks, covered

WINDOW = 35
CHUNK_ROWS = 1024
LONG_BYTES = 256 << 10
#: Text bytes of the corpus for one bucket of hashes.
BUCKET_BYTES = 8 << 20
#: Text bytes whose hashes a task holds at once.
HOLD_BYTES = 32 << 20
#: Fields of a removal interval.
SPAN = ("word_begin", "word_end", "byte_begin", "byte_end")


def addressed(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(row, used, chunk) of ``carry`` with a chunk number that a second scan repeats."""
    def number(text: str) -> Column:
        place = F.col("_metadata.row_index")
        return F.xxhash64("_metadata.file_path", F.floor(place / F.lit(CHUNK_ROWS)),
                          F.when(F.octet_length(text) >= LONG_BYTES, place))
    if "_metadata" not in docs.columns:
        try:
            return carry(docs, keep, ["text"], chunk=number("text"))
        except AnalysisException:
            pass        # not a plain file scan
    stored = stage(carry(docs, keep, ["text"]), "substring-input")
    return stored.withColumn("chunk", number(_text(keep)))


def _text(keep: Sequence[str]) -> str:
    return "row.text" if "text" in keep else "used.text"


def encode(hashes: np.ndarray, base: int) -> bytes:
    """Sorted hashes as byte planes of their differences."""
    steps = np.diff(hashes, prepend=np.uint64(base))
    planes = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([planes]) + steps.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def decode(payload: bytes, base: int) -> np.ndarray:
    planes = payload[0]
    packed = np.frombuffer(payload, np.uint8, offset=1).reshape(planes, -1)
    steps = np.zeros((packed.shape[1], 8), np.uint8)
    steps[:, :planes] = packed.T
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64) + np.uint64(base)


def _base(bucket: int, bits: int) -> int:
    return bucket << (64 - bits) if bits else 0


def _send(batches: Iterator[pa.RecordBatch], bits: int, window: int) -> Iterator[pa.RecordBatch]:
    """(bucket, chunk, hashes) of every chunk's windows."""
    held: list[np.ndarray] = []
    held_bytes, owner = 0, None

    def flush():
        nonlocal held, held_bytes
        hashes = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
        held, held_bytes = [], 0
        if not len(hashes):
            return
        third = np.zeros(len(hashes), bool)
        third[2:] = hashes[2:] == hashes[:-2]
        hashes = hashes[~third]
        cuts = np.searchsorted(hashes, np.array([_base(b, bits) for b in range(1 << bits)], np.uint64))
        cuts = np.append(cuts, len(hashes))
        filled = np.flatnonzero(np.diff(cuts))
        for part in np.array_split(filled, max(1, len(filled) // 1024)):
            yield pa.RecordBatch.from_arrays([
                pa.array(part.astype(np.int32)), pa.array(np.full(len(part), owner, np.int64)),
                pa.array([encode(hashes[cuts[b]:cuts[b + 1]], _base(int(b), bits)) for b in part],
                         pa.binary())], ["bucket", "chunk", "hashes"])

    for batch in batches:
        owners = batch.column(0).to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]])) if len(owners) else []
        for lo, hi in zip(begin, [*begin[1:], len(owners)]):
            if owner is not None and owners[lo] != owner:
                yield from flush()
            owner = int(owners[lo])
            for piece in chunks(batch.slice(lo, hi - lo), "text"):
                words = Words(piece.column("text"))
                hashes, _ = words.windows(window)
                held.append(hashes)
                held_bytes += len(words.data)
                if held_bytes > HOLD_BYTES:
                    yield from flush()
    if owner is not None:
        yield from flush()


def _repeated(bits: int) -> Callable:
    def repeated(key: tuple, rows: pa.Table) -> pa.Table:
        base = _base(key[0].as_py(), bits)
        owners = rows.column("chunk").to_numpy()
        sent = [decode(p.as_py(), base) for p in rows.column("hashes")]
        owner = np.repeat(owners, [len(s) for s in sent])
        hashes = np.concatenate(sent)
        del sent
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        equal = hashes[1:] == hashes[:-1]
        twice = np.zeros(len(hashes), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        hashes, owner = hashes[twice], owner[twice]
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
        begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
        return pa.table({
            "chunk": pa.array(owner[begin] if len(owner) else owner, pa.int64()),
            "bucket": pa.array([key[0].as_py()] * len(begin), pa.int32()),
            "hashes": pa.array([encode(np.unique(hashes[lo:hi]), base) for lo, hi
                                in zip(begin, [*begin[1:], len(owner)])], pa.binary())})
    return repeated


def join_words(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts made of the kept words, one space between."""
    begin, length = words.begin[keep], (words.end - words.begin)[keep] + 1
    to = np.cumsum(length)
    texts = np.append(0, np.cumsum(keep))[words.first]      # kept words before each text
    offsets = np.append(0, to)[texts]
    source = np.repeat(begin - (to - length), length) + np.arange(to[-1] if len(to) else 0)
    data = words.data[np.minimum(source, len(words.data) - 1)] if len(source) else np.zeros(0, np.uint8)
    data[to - 1] = 0x20
    return data, offsets


def removal_spans(words: Words, gone: np.ndarray) -> tuple[np.ndarray, ...]:
    """The maximal runs of ``gone`` words: text number, first word and word
    behind, first byte and byte behind (in the chunk).  A run takes one of the
    separators around it along, the one with fewer line breaks (if equal, the
    one behind); a run of all words takes the whole text."""
    m = len(gone)
    doc = np.repeat(np.arange(len(words.counts)), words.counts)
    edge = np.ones(m + 1, bool)
    edge[1:-1] = doc[1:] != doc[:-1]
    start, stop = gone & edge[:-1], gone & edge[1:]
    start[1:] |= gone[1:] & ~gone[:-1]
    stop[:-1] |= gone[:-1] & ~gone[1:]
    a, b = np.flatnonzero(start), np.flatnonzero(stop) + 1
    d = doc[a]
    head, tail = a == words.first[d], b == words.first[d + 1]
    breaks = np.append(0, np.cumsum(words.data == 0x0A))
    ahead, behind = words.end[np.maximum(a - 1, 0)], words.begin[np.minimum(b, m - 1)]
    low, high = words.begin[a], words.end[b - 1]
    more_ahead = breaks[low] - breaks[ahead] >= breaks[behind] - breaks[high]
    after = ~tail & (head | more_ahead)
    before = ~head & ~after
    whole = head & tail
    low = np.where(whole, words.offsets[d], np.where(before, ahead, low))
    high = np.where(whole, words.offsets[d + 1], np.where(after, behind, high))
    return d, a, b, low, high


def _without(words: Words, column: pa.Array, spans: tuple[np.ndarray, ...]) -> tuple[pa.Array, pa.Array]:
    """The texts without the spans' bytes (a text without spans as it is), and
    the spans of every text."""
    d, a, b, low, high = spans
    cut = np.zeros(len(words.data) + 1, np.int8)
    cut[low] += 1
    cut[high] -= 1
    keep = np.cumsum(cut[:-1], dtype=np.int8) == 0
    raw = words.data[keep].tobytes()
    to = np.append(0, np.cumsum(keep))[words.offsets].tolist()
    texts = [raw[o:e] if known else None for o, e, known in zip(to, to[1:], column.is_valid().to_pylist())]
    fields = (a - words.first[d], b - words.first[d], low - words.offsets[d], high - words.offsets[d])
    rows = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], list(SPAN))
    at = np.searchsorted(d, np.arange(len(words.counts) + 1)).astype(np.int32)
    return pa.array(texts, pa.binary()).cast(pa.string()), pa.ListArray.from_arrays(pa.array(at), rows)


def _cut(bits: int, window: int, with_text: bool, in_place: bool) -> Callable:
    def cut(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        sent = [decode(p.as_py(), _base(b, bits)) for p, b in zip(
            repeated.column("hashes"), repeated.column("bucket").to_pylist())]
        known = np.sort(np.concatenate(sent)) if sent else np.zeros(0, np.uint64)
        n_words, n_removed, digests, texts, spans = [], [], [], [], []
        if docs.num_rows:
            for piece in chunks(carried(docs, ["text"]), "text"):
                words = Words(piece.column("text"))
                hashes, at = words.windows(window)
                where = np.searchsorted(known, hashes)
                hit = known[np.minimum(where, len(known) - 1)] == hashes if len(known) else np.zeros(len(at), bool)
                gone = covered(at[hit], window, len(words.begin))
                data, offsets = join_words(words, ~gone)
                lengths = np.maximum(np.diff(offsets) - 1, 0)
                raw = data.tobytes()
                kept = [raw[o:o + k] for o, k in zip(offsets[:-1].tolist(), lengths.tolist())]
                n_words.append(words.counts)
                n_removed.append(np.diff(np.append(0, np.cumsum(gone))[words.first]))
                digests += [hashlib.sha256(k).hexdigest() for k in kept]
                if in_place:
                    left, own = _without(words, piece.column("text"), removal_spans(words, gone))
                    texts.append(left)
                    spans.append(own)
                elif with_text:
                    texts.append(pa.array(kept, pa.binary()).cast(pa.string()))
        none = [np.zeros(0, np.int64)]
        out = {"row": docs.column("row").combine_chunks()}
        if with_text and docs.num_rows:
            row = out["row"].chunk(0) if isinstance(out["row"], pa.ChunkedArray) else out["row"]
            left = pa.concat_arrays(texts)
            out["row"] = pa.StructArray.from_arrays(
                [left if f.name == "text" else row.field(f.name) for f in row.type], fields=list(row.type))
        out |= {"n_words": pa.array(np.concatenate(n_words or none), pa.int64()),
                "n_removed": pa.array(np.concatenate(n_removed or none), pa.int64()),
                "kept_sha256": pa.array(digests, pa.string())}
        if in_place:
            out["spans"] = pa.chunked_array(spans, pa.list_(pa.struct([(f, pa.int64()) for f in SPAN])))
        return pa.table(out)
    return cut


def drop_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """The columns of ``docs`` with ``text`` made of the kept words, one space
    between (or without ``text``), plus n_words and n_removed (long) and
    kept_sha256 (hex of the kept words)."""
    keep = [c for c in docs.columns if c not in ADDED and (with_text or c != "text")]
    return judged(docs, keep, window, False).select("row.*", *ADDED)


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` with only the removal intervals cut from ``text``,
    the columns of ``drop_repeats`` and ``spans``, the intervals of the text that
    was given: word_begin, word_end, byte_begin, byte_end (ends exclusive)."""
    keep = [c for c in docs.columns if c not in (*ADDED, "spans")]
    return judged(docs, keep, window, True).select("row.*", *ADDED, "spans")


#: The columns that both add.
ADDED = ["n_words", "n_removed", "kept_sha256"]


def judged(docs: DataFrame, keep: Sequence[str], window: int, in_place: bool) -> DataFrame:
    """(row, n_words, n_removed, kept_sha256 and, in place, spans): the columns
    ``keep`` as one struct, with what is left of the text if they have it."""
    rows = addressed(docs, keep)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, (int(size) // BUCKET_BYTES).bit_length())
    sent = rows.select("chunk", F.col(_text(keep)).alias("text")).mapInArrow(
        apply_bound(_send, bits, window), "bucket int, chunk long, hashes binary")
    repeated = stage(sent.groupBy("bucket").applyInArrow(
        _repeated(bits), "chunk long, bucket int, hashes binary"), "substring-repeats")
    schema = StructType([rows.schema["row"], StructField("n_words", LongType()), StructField("n_removed", LongType()),
                         StructField("kept_sha256", StringType())])
    if in_place:
        schema.add(StructField("spans", ArrayType(StructType([StructField(f, LongType()) for f in SPAN]))))
    return (rows.groupBy("chunk").cogroup(repeated.groupBy("chunk"))
            .applyInArrow(_cut(bits, window, "text" in keep, in_place), schema))
