"""Words and word-window hashes of text batches, vectorised over Arrow buffers.

A word is a run of ``[^\\x20\\x09-\\x0D]+``.  The six separators are single
bytes in UTF-8, so words are found on the bytes without decoding.  Hashes are
polynomial (Rabin-Karp) hashes modulo 2**64, taken from prefix sums and mixed;
equal words and equal windows always have equal hashes, different ones collide
with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators for words without ASCII punctuation.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD6E8FEB86659FD93 | 1
#: Text bytes handled at once (a longer text is handled alone).
CHUNK_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand; tables beyond
    the usual size are not kept."""

    KEEP = CHUNK_BYTES + 1

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.kept: tuple[np.ndarray, np.ndarray] | None = None

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        t = np.full(n, base, np.uint64)
        t[0] = 1
        return np.multiply.accumulate(t)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.KEEP:
            return self._table(self.base, n), self._table(self.inverse, n)
        if self.kept is None or len(self.kept[0]) < n:
            size = min(self.KEEP, max(n, 1 << 16))
            self.kept = self._table(self.base, size), self._table(self.inverse, size)
        return self.kept


_BYTES, _WORDS = _Powers(BYTE_BASE), _Powers(WORD_BASE)


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each (null: empty)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of up to ``limit`` text bytes (one text at least)."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """The words of a chunk of texts.

    ``begin`` and ``end`` are byte positions in ``data``; the words of text
    ``d`` are ``first[d]:first[d + 1]``; ``hash`` is one 64-bit hash a word.
    ``lower`` lower-cases A-Z; ``space`` names other separator bytes.
    """

    def __init__(self, column: pa.Array, lower: bool = False, space: np.ndarray = SPACE):
        self.data, self.offsets = buffers(column)
        data, n = self.data, len(self.data)
        if lower:
            data = self.data = LOWER[data]
        inside = ~space[data] if n else np.zeros(0, bool)
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1] | cut[1:-1]
        closes[:-1] &= ~inside[1:] | cut[1:-1]
        self.begin = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.begin, self.offsets)
        self.counts = np.diff(self.first)

    @property
    def hash(self) -> np.ndarray:
        if not hasattr(self, "_hash"):
            self._hash = span_hashes(self.data, self.begin, self.end)
        return self._hash

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of every run of ``size`` words of one text."""
        m = len(self.begin)
        last = np.repeat(self.first[1:], self.counts) - size
        at = np.flatnonzero(np.arange(m) <= last)
        if not len(at):
            return np.zeros(0, np.uint64), at
        power, inverse = _WORDS.upto(m + 1)
        sums = _sums(self.hash * power[:m])
        return mix((sums[at + size] - sums[at]) * inverse[at]), at

    def whole(self) -> np.ndarray:
        """A hash of each text's whole word sequence (0 words: meaningless);
        it never equals a window's hash but by chance."""
        m = len(self.begin)
        power, inverse = _WORDS.upto(m + 1)
        sums = _sums(self.hash * power[:m])
        h = (sums[self.first[1:]] - sums[self.first[:-1]]) * inverse[self.first[:-1]]
        return mix(h + np.uint64(0x5851F42D4C957F2D) * (self.counts.astype(np.uint64) + np.uint64(1)))

    def doc_of(self, word: np.ndarray) -> np.ndarray:
        """Text number of each word number."""
        return np.searchsorted(self.first, word, "right") - 1


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    n = len(data)
    power, inverse = _BYTES.upto(n + 1)
    sums = _sums((data.astype(np.uint64) + np.uint64(1)) * power[:n])
    h = (sums[end] - sums[begin]) * inverse[begin]
    return mix(h ^ ((end - begin).astype(np.uint64) << np.uint64(40)))


def covered(starts: np.ndarray, size: int, words: int) -> np.ndarray:
    """Which of ``words`` words lie in a window of ``size`` words that begins
    at one of ``starts`` (the union of the windows)."""
    edge = np.bincount(starts, minlength=words + size + 1)
    edge -= np.bincount(starts + size, minlength=words + size + 1)
    return np.cumsum(edge)[:words] > 0
