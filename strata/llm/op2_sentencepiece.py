"""SentencePiece BPE encoding and decoding by suffix-array matching.

Encoding a batch of texts:

1. Spaces become word marks; no piece holds a mark behind another character, so
   a text splits before every run of marks, and only the batch's distinct words
   are encoded.
2. The words are concatenated and their suffixes sorted (as deep as the longest
   piece).  Every piece is binary-searched for its range of suffixes; each
   suffix in it is an *edge*: the piece, from that position.
3. The edges are sorted by end position and relaxed from left to right.  An edge
   extends the encoding of the prefix before it when BPE would never merge
   across the border between that prefix's last piece and the edge's piece
   (undoing the two pieces' merges, the latest first, meets no pair of higher
   priority).  A piece sequence is the BPE encoding exactly if all its borders
   hold, so exactly one edge survives at every position, and following the
   edges back gives the encoding.

A character without a piece becomes the byte pieces of its UTF-8 bytes.
Decoding is the reverse: pieces and bytes are joined and marks become spaces.
Texts equal their decoded encoding, except that a literal word mark (U+2581)
comes back as a space, as in the SentencePiece library.

Tokenizers are never trained here; ``load`` reads a model file, whose path is a
parameter, on the driver, and its vocabulary travels to the tasks.

Defined cases: null and empty texts have no pieces (and decode to empty);
repeated rows are separate texts; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from .io import apply_bound
from .words import buffers, chunks, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Text bytes encoded together, and characters of distinct words in one suffix array.
BATCH_BYTES = 8 << 20
INDEX_CHARS = 1 << 19
#: Code of the separator between words, beyond Unicode.
BREAK = 0x110000


class Vocabulary:
    """The pieces of a BPE model, numbered by merge priority (``rank``).

    Single characters come first; ``left`` and ``right`` are the two parts of a
    piece's last merge (itself for characters); ``pair_keys`` (sorted) and
    ``pair_ranks`` hold every two pieces that merge into a third.
    """

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], ids: list[int]):
        order = sorted(range(len(pieces)), key=lambda i: (len(pieces[i]) > 1, -scores[i], ids[i]))
        rank = {pieces[i]: r for r, i in enumerate(order)}
        self.texts = [pieces[i] for i in order]
        self.ids = np.array([ids[i] for i in order], np.int32)
        self.byte_ids = np.array(byte_ids, np.int32)
        self.size = len(order)
        self.lengths = np.array([len(t) for t in self.texts])
        self.longest = int(self.lengths.max())
        self.left = np.arange(self.size)
        self.right = np.arange(self.size)
        whole = np.ones(self.size, bool)
        for r, text in enumerate(self.texts):
            if len(text) > 1:
                parts, last = _merge(text, rank)
                whole[r] = len(parts) == 1
                if whole[r]:
                    self.left[r], self.right[r] = last
        pairs = {}
        for r, text in enumerate(self.texts):
            for cut in range(1, len(text)):
                a, b = rank.get(text[:cut]), rank.get(text[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = r
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self.usable = np.flatnonzero(whole)         # pieces that encode to themselves
        self.characters = {t: r for r, t in enumerate(self.texts) if len(t) == 1}

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that a and b merge into, ``size`` if there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], self.size)

    def borders_hold(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves a|b apart: undo the later merge of the two inner
        parts again and again; no pair met may come before the merge undone
        (of equal ones the left one comes first)."""
        out = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), self.size)
        while len(live):
            crossing = self.merged(a, b) < limit
            out[live[crossing]] = False
            undo_a = (a > b) & (self.left[a] != a)
            undo_a |= (self.left[b] == b) & (self.left[a] != a)
            undo_b = ~undo_a & (self.left[b] != b)
            go = ~crossing & (undo_a | undo_b)
            limit = np.where(undo_a, a, b + 1)[go]
            a, b, live = (np.where(undo_a, self.right[a], a)[go],
                          np.where(undo_b, self.left[b], b)[go], live[go])
        return out


def _merge(text: str, rank: dict[str, int]) -> tuple[list[str], tuple[int, int] | None]:
    """Plain BPE of a short text: its parts and the last merge."""
    parts, last = list(text), None
    while len(parts) > 1:
        best = min(((rank.get(parts[i] + parts[i + 1], len(rank)), i) for i in range(len(parts) - 1)))
        if best[0] == len(rank):
            break
        i = best[1]
        last = (rank[parts[i]], rank[parts[i + 1]])
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts, last


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.vocab_size()) if not (
        model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    return Vocabulary([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids],
                      [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], ids)


# -- edges ------------------------------------------------------------------

def edges(codes: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(position, piece) of every occurrence of a usable piece in ``codes``
    (words with a BREAK behind each), by a suffix array."""
    deep = vocabulary.longest
    present, dense = np.unique(codes, return_inverse=True)
    present, dense = present[present != BREAK], dense + 1       # BREAK is the largest code
    dense[codes == BREAK] = 0
    width = 1 if len(present) < 255 else 2 if len(present) < 65_535 else 3
    number = {c: i + 1 for i, c in enumerate(present.tolist())}

    padded = np.concatenate([dense, np.zeros(deep, dense.dtype)]).astype(np.uint32)
    raw = padded.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - width:]
    at = np.flatnonzero(dense)
    keys = np.empty((len(at), deep * width), np.uint8)
    for k in range(deep):
        keys[:, k * width:(k + 1) * width] = raw[at + k]
    # What follows a word's end belongs to another word.
    ended = np.zeros(len(at), bool)
    for k in range(1, deep):
        ended |= padded[at + k] == 0
        keys[ended, k * width:(k + 1) * width] = 0
    pad = -(deep * width) % 8
    if pad:
        keys = np.hstack([keys, np.zeros((len(keys), pad), np.uint8)])
    words = keys.view(">u8").astype(np.uint64)
    suffixes = np.lexsort(words.T[::-1])
    ordered = keys[suffixes].view(f"S{keys.shape[1]}").ravel()

    pieces, low, high = [], [], []
    for r in vocabulary.usable.tolist():
        numbers = [number.get(ord(c)) for c in vocabulary.texts[r]]
        if None not in numbers:
            key = b"".join(n.to_bytes(width, "big") for n in numbers)
            pieces.append(r)
            low.append(key)
            high.append(key.ljust(keys.shape[1], b"\xff"))
    if not pieces:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = f"S{keys.shape[1]}"
    begin = np.searchsorted(ordered, np.array(low, kind), "left")
    end = np.searchsorted(ordered, np.array(high, kind), "right")
    hits = end - begin
    total = np.cumsum(hits)
    take = np.arange(total[-1]) + np.repeat(begin - (total - hits), hits)
    return at[suffixes[take]], np.repeat(np.array(pieces), hits)


# -- relaxing ---------------------------------------------------------------

def relax(codes: np.ndarray, start: np.ndarray, length: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """For every position the last piece of the encoding of its word up to and
    including it; a character without a piece is ``size`` + its code."""
    v = vocabulary
    position, piece = edges(codes, v)
    last = v.size + codes.astype(np.int64)      # replaced wherever an edge survives
    word = np.repeat(np.arange(len(start)), length + 1)[position]
    end = position + v.lengths[piece] - 1
    offset = end - start[word]
    order = np.argsort(offset, kind="stable")
    cuts = np.searchsorted(offset[order], np.arange(int(length.max()) + 1))
    unknown = np.isin(codes, [ord(c) for c in v.characters], invert=True)
    position, piece, end = position[order], piece[order], end[order]
    first = start[word[order]] == position
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if lo == hi:
            continue
        s, t, e = position[lo:hi], piece[lo:hi], end[lo:hi]
        before = last[s - 1]
        free = first[lo:hi] | unknown[s - 1]
        test = np.flatnonzero(~free)
        if len(test):
            pair, back = np.unique(before[test] * v.size + t[test], return_inverse=True)
            free[test] = v.borders_hold(pair // v.size, pair % v.size)[back]
        last[e[free]] = t[free]
    return last


def follow(last: np.ndarray, start: np.ndarray, length: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all words, word by word, and the number of pieces of each."""
    at, word = start + length - 1, np.arange(len(start))
    words, pieces = [], []
    while len(word):
        piece = last[at]
        words.append(word)
        pieces.append(piece)
        at = at - np.where(piece < vocabulary.size, vocabulary.lengths[np.minimum(piece, vocabulary.size - 1)], 1)
        more = at >= start[word]
        at, word = at[more], word[more]
    words, pieces = np.concatenate(words[::-1]), np.concatenate(pieces[::-1])
    order = np.argsort(words, kind="stable")
    return pieces[order], np.bincount(words, minlength=len(start))


def encode_words(texts: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words (each a UTF-8 string with marks) and their numbers."""
    out_ids, out_counts = [], []
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size < INDEX_CHARS):
            size += len(texts[to])
            to += 1
        words = [t.decode("utf-8", "replace") for t in texts[at:to]]
        length = np.array([len(w) for w in words])
        joined = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        start = np.cumsum(length + 1) - (length + 1)
        codes = np.full(len(joined) + len(words), BREAK, np.int64)
        inside = np.ones(len(codes), bool)
        inside[start + length] = False
        codes[inside] = joined
        pieces, counts = follow(relax(codes, start, length, vocabulary), start, length, vocabulary)
        ids, counts = _to_ids(pieces, counts, vocabulary)
        out_ids.append(ids)
        out_counts.append(counts)
        at = to
    return np.concatenate(out_ids or [np.zeros(0, np.int32)]), np.concatenate(out_counts or [np.zeros(0, np.int64)])


def _to_ids(pieces: np.ndarray, counts: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Piece ranks to ids; a character without a piece becomes byte pieces."""
    odd = np.flatnonzero(pieces >= v.size)
    ids = v.ids[np.minimum(pieces, v.size - 1)]
    if not len(odd):
        return ids, counts
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in (pieces[odd] - v.size).tolist()]
    width = np.ones(len(pieces), np.int64)
    width[odd] = [len(r) for r in raw]
    word = np.repeat(np.arange(len(counts)), counts)
    out = np.repeat(ids, width)
    is_byte = np.repeat(pieces >= v.size, width)
    out[is_byte] = v.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.bincount(word, width, minlength=len(counts)).astype(np.int64)


# -- texts ------------------------------------------------------------------

def _marked(column: pa.Array) -> pa.Array:
    """Texts with marks as spaces and one more in front (empty ones stay so)."""
    text = pc.replace_substring(column.fill_null("").cast(pa.large_string()), MARK, " ")
    return pc.if_else(pc.equal(pc.binary_length(text), 0), "",
                      pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))


def encode_texts(column: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and the offsets of each."""
    data, offsets = buffers(_marked(column))
    space = data == 0x20
    opens = space.copy()
    opens[1:] &= ~space[:-1]
    opens[offsets[:-1][np.diff(offsets) > 0]] = True
    begin = np.flatnonzero(opens)
    end = np.append(begin[1:], len(data))
    step = 1 << 21
    hashes = np.concatenate([
        _hashes(data, begin[i:i + step // 8], end[i:i + step // 8]) for i in range(0, len(begin), step // 8)
    ] or [np.zeros(0, np.uint64)])
    _, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    raw = data.tobytes()
    distinct = [raw[b:e].replace(b" ", MARK.encode()) for b, e in zip(begin[where].tolist(), end[where].tolist())]
    ids, counts = encode_words(distinct, vocabulary)
    first = np.cumsum(counts) - counts
    n = counts[inverse]
    total = np.append(0, np.cumsum(n))
    take = np.arange(total[-1]) + np.repeat(first[inverse] - total[:-1], n)
    return ids[take], total[np.searchsorted(begin, offsets)]


def _hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    lo, hi = int(begin[0]), int(end[-1])
    return span_hashes(data[lo:hi], begin - lo, end - lo)


def decode_ids(ids: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> list[bytes]:
    """UTF-8 bytes of every text."""
    raw: dict[int, bytes] = {int(i): t.replace(MARK, " ").encode() for i, t in zip(vocabulary.ids, vocabulary.texts)}
    raw |= {int(i): bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
    size = max(raw) + 1
    lengths = np.zeros(size, np.int64)
    for i, r in raw.items():
        lengths[i] = len(r)
    table = np.frombuffer(b"".join(raw[i] for i in sorted(raw)), np.uint8)
    first = np.cumsum(lengths) - lengths
    n = lengths[ids]
    total = np.append(0, np.cumsum(n))
    take = np.arange(total[-1]) + np.repeat(first[ids] - total[:-1], n)
    data = table[take].tobytes()
    cuts = total[offsets].tolist()
    return [data[a + 1:b] if data[a:a + 1] == b" " and b > a else data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        others = [c for c in batch.schema.names if c != "_text"]
        for part in chunks(batch, "_text", BATCH_BYTES):
            ids, offsets = encode_texts(part.column("_text"), vocabulary)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in others] + [
                    pa.array(np.diff(offsets).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))],
                [*others, "_n", "_ids"])


def _decode(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        others = [c for c in batch.schema.names if c != "_ids"]
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            column = part.column("_ids").fill_null([])
            ids = column.flatten().to_numpy()
            offsets = np.append(0, np.cumsum(pc.list_value_length(column).to_numpy()))
            texts = [t.decode("utf-8", "replace") for t in decode_ids(ids, offsets, vocabulary)]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in others] + [pa.array(texts, pa.string())], [*others, "_decoded"])


def _schema(docs: DataFrame, keep: list[str], new: list[StructField]) -> StructType:
    return StructType([docs.schema[c] for c in keep] + new)


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``docs`` with n_ids and ids of every whole text."""
    keep = [c for c in docs.columns if c not in ("n_ids", "ids")]
    return (docs.select(*keep, F.col("text").alias("_text"))
            .mapInArrow(apply_bound(_encode, vocabulary), _schema(docs, keep, [
                StructField("_n", IntegerType()), StructField("_ids", ArrayType(IntegerType()))]))
            .withColumnsRenamed({"_n": "n_ids", "_ids": "ids"}))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encoded`` with the text of its ids in ``decoded`` (null ids: empty)."""
    keep = [c for c in encoded.columns if c != "decoded"]
    return (encoded.select(*keep, F.col("ids").alias("_ids"))
            .mapInArrow(apply_bound(_decode, vocabulary), _schema(encoded, keep, [
                StructField("_decoded", StringType())]))
            .withColumnRenamed("_decoded", "decoded"))


def _round_trip(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        others = [c for c in batch.schema.names if c != "_text"]
        for part in chunks(batch, "_text", BATCH_BYTES):
            column = part.column("_text").fill_null("")
            ids, offsets = encode_texts(column, vocabulary)
            texts = pc.replace_substring(column, MARK, " ").cast(pa.binary())
            same = pc.equal(texts, pa.array(decode_ids(ids, offsets, vocabulary), pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in others] + [
                    pa.array(np.diff(offsets).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)), same],
                [*others, "_n", "_ids", "_same"])


def encode_checked(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encode``, plus round_trip: whether decoding the ids gives the text."""
    keep = [c for c in docs.columns if c not in ("n_ids", "ids", "round_trip")]
    return (docs.select(*keep, F.col("text").alias("_text"))
            .mapInArrow(apply_bound(_round_trip, vocabulary), _schema(docs, keep, [
                StructField("_n", IntegerType()), StructField("_ids", ArrayType(IntegerType())),
                StructField("_same", BooleanType())]))
            .withColumnsRenamed({"_n": "n_ids", "_ids": "ids", "_same": "round_trip"}))
