"""N-gram Jaccard join: exact links between texts by their word shingles.

A text's set holds the distinct runs of five lower-cased words (with fewer
words: the whole sequence as one element).  Two texts link when their sets'
Jaccard similarity is 0.75 or more.  The join is a blocked sparse product of
the text-by-shingle incidence matrix with itself:

1. *Signatures* (scan 1).  Every text gets its set's size, a hash of the set
   (``node``) and a parity sketch of at least a bit an element.  Copies share a node and
   are expanded only in the result.  The same scan counts shingles in a
   fixed-size hashed table; the buckets that stand out hold the frequent ones.
2. *Incidence* (scan 2).  In one global order, light shingles by hash before
   frequent ones by count, two sets of similarity ``t`` share an element among
   the first ``n - ceil(t n) + 1`` of each.  Only these entries of the
   incidence matrix are kept, so a passage that many texts share stays out of
   it unless it makes up most of a text.  Entries move once, sorted by column;
   a column is stored as one row, those with one node are dropped.
3. *Blocks.*  Columns with the same smallest node mostly hold the same nodes, so
   they form one block of columns: a node enters it once, with the list of its
   columns there (and with its sketch), however many columns they share.
4. *First product.*  In every column each node meets the column's smallest
   node and its predecessor, and in blocks the node whose sketch is the
   nearest; the promising partners that their sketches allow are compared on
   the full sets (scan 3), and the links found contract groups of near copies.
5. *Full product.*  Each block of columns multiplies its incidence matrix with
   itself (blocks of many nodes in pairs of node blocks), which gives the overlap
   of every pair of nodes of different components.  Three bounds discard pairs,
   each of which a link must meet: the sizes; the sketches, whose bits differ in
   no more places than the sets have elements apart; and the overlap plus all
   that may follow the kept entries.  The rest is compared on the full sets
   (scan 4).

Pairs inside a component need no comparison for the classes: they are connected
already.  The links themselves (``jaccard_links``, ``jaccard_counts``) are found
afterwards, by comparing the nodes of a component block by block.  So
the classes are exact (up to collisions of 64-bit hashes, 48-bit inside a pair): no candidate is dropped,
sampled or capped, and a group of k copies costs O(k).

Defined cases: a text that is null or has no word has an empty set, links with
nothing and is its own class; repeated ids are separate rows with the same id;
a null id counts as larger than any other; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from .components import components
from .io import apply_bound, carried, carry, stage
from .op6_substring_dedup import decode, encode
from .words import Words, chunks, mix

SHINGLE = 5
#: Link when PERCENT * union <= 100 * intersection.
PERCENT = 75
SKETCH = 1 << 22
SKETCH_RANGES = 256
#: Fewest bits of a set's parity sketch (a power of two; a set of n elements
#: has at least n).  Columns of more nodes go to blocks, shorter ones give pairs.
SKETCH_BITS = 512
LONG = 3
#: Leading bits of each hash in the sets that are compared.
SET_BITS = 48
#: Nodes of a block of columns that meet at once, and at most in one run of a column.
BLOCK = 1024
RUN = 1 << 16
#: Pairs gathered before they are added up and sent.
HELD = 1 << 19
#: Set elements of a block whose links are counted, and columns multiplied at once.
ELEMENTS = 1 << 20
STRIP = 1 << 11
#: Bits of the filter that picks the texts whose full sets are compared.
BITMAP = 1 << 26

_SIGNATURES = "doc_id {id}, n_shingles long, node long, sketch binary, range int, counts binary"
_ENTRIES = "h long, salts int, salt int, node long, n int"
_RUNS = "h long, salts int, nodes array<long>, ns array<int>"
_PAIRS = "a long, b long, na int, nb int, overlap int"
_SETS = "node long, hashes binary"


def shingle_sets(words: Words, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a chunk."""
    hashes, at = words.windows(size)
    starts = np.searchsorted(at, words.first)
    whole = words.whole()
    for d, m in enumerate(words.counts):
        if m >= size:
            yield np.unique(hashes[starts[d]:starts[d + 1]])
        else:
            yield whole[d:d + 1] if m else whole[:0]


def set_hash(s: np.ndarray) -> int:
    """Signed 64-bit hash of a set of 64-bit hashes."""
    total = np.add.reduce(mix(s ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)
    return int(mix(np.array([total ^ np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def parity_sketch(s: np.ndarray) -> bytes:
    """Each element flips one bit, so two sketches differ in at most as many
    bits as there are elements in one set only.  Halving a sketch (the exclusive
    or of its halves) gives the sketch of half the size."""
    size = max(SKETCH_BITS, 1 << (len(s) - 1).bit_length())
    bits = np.bincount((mix(s) & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((bits & 1).astype(np.uint8)).tobytes()


class Sketches:
    """Parity sketches of several sizes, compared at the smaller size of two."""

    def __init__(self, raw: list[bytes]):
        length = np.array([len(r) * 8 // SKETCH_BITS for r in raw], np.int64)
        self.level = np.array([n.bit_length() - 1 for n in length.tolist()], np.int64)
        self.row = np.zeros((int(self.level.max(initial=0)) + 1, len(raw)), np.int64)
        self.at: list[np.ndarray] = []
        above, members = None, np.zeros(0, np.int64)
        for level in reversed(range(len(self.row))):
            words = (SKETCH_BITS << level) // 64
            own = np.flatnonzero(self.level == level)
            part = np.frombuffer(b"".join(raw[i] for i in own), np.uint64).reshape(-1, words)
            if above is not None:
                part = np.concatenate([part, above[:, :words] ^ above[:, words:]])
            members = np.concatenate([own, members])
            self.row[level, members] = np.arange(len(members))
            above = part
            self.at.insert(0, part)

    def apart(self, i, others: np.ndarray) -> np.ndarray:
        """Differing bits of sketch ``i`` (one or an array) and each of ``others``."""
        i = np.broadcast_to(i, others.shape)
        out = np.zeros(len(others), np.int64)
        level = np.minimum(self.level[i], self.level[others])
        for v in np.unique(level):
            own = np.flatnonzero(level == v)
            for cut in np.array_split(own, len(own) * self.at[v].shape[1] // (1 << 20) + 1):
                x, y = self.at[v][self.row[v, i[cut]]], self.at[v][self.row[v, others[cut]]]
                out[cut] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        return out


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(42)).astype(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    sketch = np.zeros(SKETCH, np.uint32)
    names = ["doc_id", "n_shingles", "node", "sketch", "range", "counts"]
    for batch in batches:
        for part in chunks(batch, "text"):
            words = Words(part.column("text"), lower=True)
            sizes, nodes, sketches = [], [], []
            for s in shingle_sets(words):
                sizes.append(len(s))
                nodes.append(set_hash(s) if len(s) else None)
                sketches.append(parity_sketch(s) if len(s) else None)
                np.add.at(sketch, _bucket(s), 1)
            k = part.num_rows
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                pa.array(sketches, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
    ranges = sketch.reshape(SKETCH_RANGES, -1)
    filled = np.flatnonzero(ranges.any(axis=1))
    if len(filled):
        k = len(filled)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(k, id_type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
            pa.array(filled.astype(np.int32)),
            pa.array([zlib.compress(ranges[r].tobytes(), 1) for r in filled], pa.binary())], names)


def _add_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for r, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            more = np.frombuffer(zlib.decompress(counts.as_py()), np.uint32)
            total[r] = total[r] + more if r in total else more
    if total:
        yield pa.RecordBatch.from_arrays([
            pa.array(list(total), pa.int32()),
            pa.array([zlib.compress(c.tobytes(), 1) for c in total.values()], pa.binary())],
            ["range", "counts"])


def _packed(array: np.ndarray) -> bytes:
    """A mostly empty array as bytes that travel with a task; ``_unpacked`` reads them."""
    return zlib.compress(array.tobytes(), 1)


def _unpacked(packed: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), kind)


def _frequent(signatures: DataFrame) -> bytes:
    """Counts of the sketch's outstanding buckets, 0 elsewhere: an array of
    SKETCH entries (packed) whatever the corpus."""
    added = (signatures.where("range is not null").select("range", "counts")
             .repartition("range").mapInArrow(_add_sketches, "range int, counts binary"))
    sketch = np.zeros((SKETCH_RANGES, SKETCH // SKETCH_RANGES), np.uint32)
    for row in added.collect():     # SKETCH_RANGES rows, 16 MB at most
        sketch[row["range"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    sketch = sketch.ravel()
    mean = sketch.mean(dtype=np.float64)
    sketch[sketch <= mean + 8 * np.sqrt(mean) + 32] = 0
    return _packed(sketch)


def prefix_size(n):
    """Entries of a set of ``n`` that are kept (integers or arrays)."""
    return n - (PERCENT * n + 99) // 100 + 1


def _entries(batches: Iterator[pa.RecordBatch], outstanding: bytes) -> Iterator[pa.RecordBatch]:
    frequent = _unpacked(outstanding, np.uint32)
    names = ["h", "salts", "salt", "node", "n"]
    seen: set[int] = set()      # copies inside a task are sent once
    for batch in batches:
        for part in chunks(batch, "text"):
            hs, nodes, ns = [], [], []
            for s in shingle_sets(Words(part.column("text"), lower=True)):
                if not len(s) or (node := set_hash(s)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(node)
                keep = prefix_size(len(s))
                df = frequent[_bucket(s)]
                heavy = df > 0
                light = s[~heavy]
                if len(light) < keep:
                    late = np.flatnonzero(heavy)
                    late = late[np.lexsort((s[late], df[late]))][:keep - len(light)]
                    light = np.concatenate([light, s[late]])
                hs.append(light[:keep])
                nodes.append(node)
                ns.append(len(s))
            if not hs:
                continue
            lengths = [len(h) for h in hs]
            h = np.concatenate(hs)
            node = np.repeat(np.array(nodes, np.int64), lengths)
            salts = frequent[_bucket(h)].astype(np.int64) // RUN + 1
            salt = (mix(node.view(np.uint64)) % salts.astype(np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(h.view(np.int64)), pa.array(salts.astype(np.int32)), pa.array(salt),
                pa.array(node), pa.array(np.repeat(np.array(ns, np.int32), lengths))], names)


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list]:
    """Batches cut so that none splits a group of rows that are equal in the first
    ``keys`` columns (the rows are sorted by them): the columns and the group's begins."""
    held: list | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) if pa.types.is_integer(c.type) else
                   np.array(c, object) for c in batch.columns]
        if not len(columns[0]):
            continue
        if held is not None:
            columns = [np.concatenate(both) for both in zip(held, columns)]
        new = np.zeros(len(columns[0]), bool)
        new[0] = True
        for c in columns[:keys]:
            new[1:] |= c[1:] != c[:-1]
        begin = np.flatnonzero(new)
        held = [c[begin[-1]:] for c in columns]     # the last group may go on
        if len(begin) > 1:
            yield [[c[:begin[-1]] for c in columns], begin[:-1]]
    if held is not None:
        yield [held, np.zeros(1, np.int64)]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by column, salt and node: one row a column (and salt), its
    nodes ascending; columns of one node are dropped."""
    for (h, salt, node, salts, n), begin in _grouped(batches, 2):
        fresh = np.ones(len(h), bool)
        fresh[1:] = node[1:] != node[:-1]
        fresh[begin] = True
        node, n = node[fresh], n[fresh]
        k = np.add.reduceat(fresh, begin, dtype=np.int64)
        shared = (k > 1) | (salts[begin] > 1)
        inside = np.repeat(shared, k)
        offsets = pa.array(np.append(0, np.cumsum(k[shared])), pa.int32())
        if shared.any():
            yield pa.RecordBatch.from_arrays([
                pa.array(h[begin][shared]), pa.array(salts[begin][shared]),
                pa.ListArray.from_arrays(offsets, pa.array(node[inside])),
                pa.ListArray.from_arrays(offsets, pa.array(n[inside]))], ["h", "salts", "nodes", "ns"])


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of a batch of runs: each run's begin and length, all nodes and sizes."""
    k = batch.column("nodes").value_lengths().to_numpy()
    return (np.cumsum(k) - k, k, batch.column("nodes").flatten().to_numpy(), batch.column("ns").flatten().to_numpy())


def _added(*columns: np.ndarray, by: int = 2) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows distinct in the first ``by`` columns, and how often each occurs."""
    order = np.lexsort(columns[:by][::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns[:by]])
    begin = np.flatnonzero(new)
    return [c[order[begin]] for c in columns], np.diff(np.append(begin, len(order)))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, other, c): each node of a column with the column's first node and
    with the one before."""
    for batch in batches:
        begin, k, node, n = _flat(batch)
        if not len(node):
            continue
        first, before = np.repeat(node[begin], k), np.concatenate([node[:1], node[:-1]])
        before[begin] = node[begin]
        both, others = np.tile(node, 2), np.concatenate([first, before])
        apart = both != others
        if apart.any():
            (node, other, n), c = _added(both[apart], others[apart], np.tile(n, 2)[apart])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(n), pa.array(other), pa.array(c)], ["node", "n", "other", "c"])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, node, n, column) of the long columns: a column belongs to the block
    of its smallest node, one of several runs to a block of its own."""
    for batch in batches:
        begin, k, node, n = _flat(batch)
        if len(node):
            h, salts = batch.column("h").to_numpy(), batch.column("salts").to_numpy()
            block = np.where(salts > 1, h, node[begin])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(block, k)), pa.array(node), pa.array(n),
                pa.array(np.repeat(h.view(np.uint64) >> np.uint64(32), k).astype(np.uint32).view(np.int32))],
                ["block", "node", "n", "column"])


def _sizes_allow(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(np.int64), b.astype(np.int64)
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


def _pair_rows(a, b, na, nb) -> pa.RecordBatch:
    swap = a > b
    (a, b, na, nb), c = _added(np.where(swap, b, a), np.where(swap, a, b),
                               np.where(swap, nb, na), np.where(swap, na, nb))
    return pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), pa.array(na), pa.array(nb), pa.array(c.astype(np.int32))],
        ["a", "b", "na", "nb", "overlap"])


def _short_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of nodes of short columns that the sizes allow to link."""
    for batch in batches:
        begin, k, node, n = _flat(batch)
        run = np.repeat(np.arange(len(k)), k)
        found = []
        for d in range(1, LONG):        # all pairs at distance d
            i = np.flatnonzero(run[:-d] == run[d:]) if len(run) > d else np.zeros(0, np.int64)
            i = i[_sizes_allow(n[i], n[i + d])]
            found.append((node[i], node[i + d], n[i], n[i + d]))
        pairs = [np.concatenate(c) for c in zip(*found)]
        if len(pairs[0]):
            yield _pair_rows(*pairs)


def _bitmap(bits: DataFrame) -> bytes:
    """A bitmap of BITMAP bits (packed) with the numbers in ``bit`` set: fixed size, so it
    may travel to every task; a wrong hit only costs an unused row."""
    rows = (bits.select(F.shiftright("bit", 6).alias("word"), (F.col("bit") % 64).cast("int").alias("at"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits")).toArrow())
    out = np.zeros(BITMAP // 64, np.int64)      # at most BITMAP / 64 rows
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return _packed(out)


def _sets(batches: Iterator[pa.RecordBatch], marked: bytes) -> Iterator[pa.RecordBatch]:
    wanted = _unpacked(marked, np.int64)
    for batch in batches:
        bit = batch.column("bit").to_numpy()
        keep = batch.filter(pa.array((wanted[bit >> 6] >> (bit & 63) & 1).astype(bool)))
        for part in chunks(keep, "text"):
            sets = [s for s in shingle_sets(Words(part.column("text"), lower=True)) if len(s)]
            if sets:
                yield pa.RecordBatch.from_arrays([
                    pa.array([set_hash(s) for s in sets], pa.int64()),
                    pa.array([encode(s >> np.uint64(64 - SET_BITS), 0) for s in sets], pa.binary())],
                    ["node", "hashes"])


def _full_sets(texts: DataFrame, nodes: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, hashes) of the named nodes, from another scan of the texts: one
    text of each node is read, picked by its id's bit.  No shuffle."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP)).alias("bit")
    wanted = _bitmap(reps.join(nodes, "node", "left_semi").select(bit))
    return stage(texts.select("text", bit).mapInArrow(apply_bound(_sets, wanted), _SETS), "jaccard-sets")


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):
            x, y = decode(x.as_py(), 0), decode(y.as_py(), 0)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("sb"))
    return (pairs.select("a", "b").join(a, "a").join(b, "b")
            .mapInArrow(_compare, "a long, b long"))


def _allowed(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Drops the pairs (a, b, na, nb) whose sketches rule out a link."""
    for side in "ab":
        pairs = pairs.join(sketches.select(F.col("node").alias(side), F.col("sketch").alias(f"k{side}")), side)

    def check(batches):
        for batch in batches:
            sketches = Sketches(batch.column("ka").to_pylist() + batch.column("kb").to_pylist())
            rows = np.arange(batch.num_rows)
            apart = sketches.apart(rows, rows + batch.num_rows)
            n = batch.column("na").to_numpy().astype(np.int64) + batch.column("nb").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array((100 + PERCENT) * apart <= (100 - PERCENT) * n))
    return pairs.mapInArrow(check, "a long, b long")


class _Product:
    """One block of columns, or two node blocks of it: the nodes' incidence matrix
    times itself.  ``pairs`` gives the rows (i, j) of the nodes that share a
    column and may link by their sizes and sketches, and their overlaps."""

    def __init__(self, part, node, n, columns, sketch):
        self.node, self.n = node, n
        self.rows = [np.frombuffer(c, np.int32) for c in columns]
        self.sketches = Sketches(list(sketch))
        lo, hi = part.min(), part.max()
        self.left = np.flatnonzero(part == lo)
        self.right = self.left if lo == hi else np.flatnonzero(part == hi)

    def pairs(self, apart_from: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        left, right = self.left, self.right
        mine = [self.rows[i] for i in left]
        overlap = _shared(mine, mine if right is left else [self.rows[i] for i in right])
        x, y = np.nonzero(np.triu(overlap, 1) if right is left else overlap)
        i, j = left[x], right[y]
        ok = _sizes_allow(self.n[i], self.n[j])
        if apart_from is not None:
            ok &= apart_from[i] != apart_from[j]
        i, j, c = i[ok], j[ok], overlap[x[ok], y[ok]]
        apart = self.sketches.apart(i, j)
        ok = (100 + PERCENT) * apart <= (100 - PERCENT) * (self.n[i].astype(np.int64) + self.n[j])
        return i[ok], j[ok], c[ok], apart[ok]


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, other, apart): the nearest sketch that each node of a product meets."""
    for (_, _, _, part, node, n, columns, sketch), begin in _grouped(batches, 3):
        found = []
        for lo, hi in zip(begin, [*begin[1:], len(node)]):
            product = _Product(*(c[lo:hi] for c in (part, node, n, columns, sketch)))
            i, j, _, apart = product.pairs()
            a, b, d = np.concatenate([i, j]), np.concatenate([j, i]), np.tile(apart, 2)
            order = np.lexsort((product.node[b], d, a))
            a, b, d = a[order], b[order], d[order]
            first = np.flatnonzero(np.diff(a, prepend=-1))
            found.append((product.node[a[first]], product.node[b[first]], d[first]))
        columns = [np.concatenate(c) for c in zip(*found)]
        if len(columns[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "other", "apart"])


def _cross_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, na, nb, overlap) of the nodes of different components that a product
    allows to link."""
    names = ["a", "b", "na", "nb", "overlap"]

    def emit(found: list) -> pa.RecordBatch:
        a, b, na, nb, c = (np.concatenate(x) for x in zip(*found))
        swap = a > b
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (
            np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb),
            c.astype(np.int32))], names)

    found, held = [], 0
    for (_, _, _, part, node, n, columns, sketch, root), begin in _grouped(batches, 3):
        for lo, hi in zip(begin, [*begin[1:], len(node)]):
            roots = root[lo:hi]
            if (roots == roots[0]).all():
                continue
            product = _Product(*(c[lo:hi] for c in (part, node, n, columns, sketch)))
            i, j, c, _ = product.pairs(roots)
            if len(i):
                found.append((product.node[i], product.node[j], product.n[i], product.n[j], c))
                held += len(i)
            if held > HELD:
                yield emit(found)
                found, held = [], 0
    if found:
        yield emit(found)


def _products(blocks: DataFrame, sketches: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The rows of every product, sorted by it: block, lo, hi, part, node, n, columns,
    sketch and, with ``labels``, the node's root."""
    more = [] if labels is None else ["root"]
    large = (blocks.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
             .where("parts > 1"))
    parts = F.coalesce("parts", F.lit(1))
    if labels is not None:      # once a row: the sizes above need no label
        blocks = _labelled(blocks, labels)
    return (blocks.join(large, "block", "left").join(sketches, "node")
            .withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
            .select("block", F.least("part", "with").alias("lo"), F.greatest("part", "with").alias("hi"),
                    "part", "node", "n", "columns", "sketch", *more)
            .repartition("block", "lo", "hi").sortWithinPartitions("block", "lo", "hi", "node"))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and node: one row each, with its columns as bytes."""
    for (block, node, n, column), begin in _grouped(batches, 2):
        ends = [*begin[1:], len(block)]
        yield pa.RecordBatch.from_arrays([
            pa.array(block[begin]), pa.array(node[begin]), pa.array(n[begin]),
            pa.array([np.unique(column[lo:hi]).tobytes() for lo, hi in zip(begin, ends)], pa.binary())],
            ["block", "node", "n", "columns"])


def _rest(n: str) -> Column:
    """Elements of a set of size ``n`` behind its kept entries."""
    return F.floor((F.col(n) * PERCENT + 99) / 100).cast("long") - 1


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    return (entries.join(labels, "node", "left")
            .withColumn("root", F.coalesce("root", "node")))


class _Solved(NamedTuple):
    """What both outputs start from: (doc_id, n_shingles, node) of every row, one
    row a node, the root of every node that has a link, and the full sets of all
    nodes that were compared (some twice)."""

    rows: DataFrame
    reps: DataFrame
    roots: DataFrame
    sets: DataFrame


def _solve(docs: DataFrame) -> _Solved:
    id_field = docs.select("doc_id").schema[0].dataType
    texts = docs.select("doc_id", "text")
    id_arrow = to_arrow_type(id_field)
    signatures = stage(texts.mapInArrow(
        apply_bound(_signatures, id_arrow),
        _SIGNATURES.format(id=id_field.simpleString())), "jaccard-signatures")
    rows = signatures.where("range is null").select("doc_id", "n_shingles", "node")
    reps = stage(signatures.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"),
        F.first("n_shingles").cast("int").alias("n"), F.count(F.lit(1)).alias("copies")), "jaccard-nodes")
    sketches = reps.select("node", "sketch")
    frequent = _frequent(signatures)

    # The kept entries of the incidence matrix, a row a column.
    runs = stage(
        texts.mapInArrow(apply_bound(_entries, frequent), _ENTRIES)
        .select("h", "salt", "node", "salts", "n")
        .repartition("h", "salt").sortWithinPartitions("h", "salt", "node")
        .mapInArrow(_runs, _RUNS), "jaccard-runs")
    long = (F.size("nodes") > LONG) | (F.col("salts") > 1)
    blocks = stage(
        runs.where(long).mapInArrow(_dealt, "block long, node long, n int, column int")
        .repartition("block", "node").sortWithinPartitions("block", "node")
        .select("block", "node", "n", "column")
        .mapInArrow(_listed, "block long, node long, n int, columns binary"), "jaccard-blocks")

    # First product: each node with the partner it meets most often, and with
    # the nearest one of its blocks.
    salted = runs.where("salts > 1").select(
        "h", F.element_at("nodes", 1).alias("node"), F.element_at("ns", 1).alias("n"))
    tops = salted.groupBy("h").agg(F.min("node").alias("top"))
    met = (runs.mapInArrow(_met, "node long, n int, other long, c long")
           .unionByName(salted.join(tops, "h").where("node <> top")
                        .select("node", "n", F.col("top").alias("other"), F.lit(1).cast("long").alias("c"))))
    often = (met.groupBy("node", "n", "other").agg(F.sum("c").alias("c"))
             .where((100 + PERCENT) * (F.col("c") + _rest("n")) >= 2 * PERCENT * F.col("n"))
             .groupBy("node").agg(F.max_by("other", F.struct("c", "other")).alias("other")))
    near = (_products(blocks, sketches).mapInArrow(_nearest, "node long, other long, apart long")
            .groupBy("node").agg(F.min_by("other", F.struct("apart", "other")).alias("other")))
    sized = (often.unionByName(near).select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        .join(reps.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
        .join(reps.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b"))
    pairs = stage(_allowed(sized, sketches), "jaccard-pairs")
    sets = _full_sets(texts, _nodes_of(pairs), reps)
    links = stage(_linked(pairs, sets), "jaccard-links")
    labels = components(links)

    # Full product over the nodes of different components.
    overlaps = (_products(blocks, sketches, labels).mapInArrow(_cross_pairs, _PAIRS)
                .unionByName(runs.where(~long).mapInArrow(_short_pairs, _PAIRS))
                .groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap")))
    rest = F.greatest(_rest("na"), _rest("nb"))
    open_pairs = overlaps.where(
        (100 + PERCENT) * (F.col("overlap") + rest) >= PERCENT * (F.col("na") + F.col("nb")))
    for side in "ab":       # those of short columns may lie in one component
        open_pairs = _labelled(open_pairs.withColumn("node", F.col(side)), labels).withColumnRenamed("root", f"r{side}")
    open_pairs = stage(_allowed(open_pairs.where("ra <> rb").select("a", "b", "na", "nb"), sketches), "jaccard-pairs")
    more_sets = _full_sets(texts, _nodes_of(open_pairs), reps)
    more = stage(_linked(open_pairs, more_sets), "jaccard-links")
    return _Solved(rows, reps, _joined(labels, more), sets.unionByName(more_sets))


def _joined(labels: DataFrame, more: DataFrame) -> DataFrame:
    """(node, root) after the links ``more`` between components of ``labels``: only
    the components that they join are solved again, a node each."""
    for side in "ab":
        more = _labelled(more.withColumnRenamed(side, "node"), labels).drop("node").withColumnRenamed("root", side)
    top = components(more)
    moved = labels.join(top.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select(
        "node", F.coalesce("top", "root").alias("root"))
    return stage(moved.unionByName(top.join(labels, "node", "left_anti")), "jaccard-roots")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_shingles, node (hash of its set, null when
    empty), component_id, the smallest doc_id reachable by links, and kept:
    whether the row is the one that stays of its class (see ``one_of_each``)."""
    return _classes(_solve(docs))


def _classes(solved: _Solved) -> DataFrame:
    rows, reps = solved.rows, solved.reps
    members = reps.select("node", "doc_id").join(solved.roots, "node")
    first = F.min_by("node", F.struct(F.col("doc_id").isNull(), "doc_id", "node"))
    lowest = members.groupBy("root").agg(F.min("doc_id").alias("least"), first.alias("first"))
    linked = solved.roots.join(lowest, "root").select("node", "root", "least", "first")
    alone = F.col("root").isNull()      # a node without a link
    classes = reps.join(linked, "node", "left").select(
        "node", F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        F.when(alone, F.col("node")).otherwise(F.col("first")).alias("kept_node"))
    empty = F.col("node").isNull()
    return (rows.join(classes, "node", "left")
            .withColumn("component_id", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", "n_shingles", "node", "component_id",
                    (empty | ((F.col("node") == F.col("kept_node"))
                              & F.col("doc_id").eqNullSafe(F.col("component_id")))).alias("kept")))


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Elements that each set of ``left`` has in common with each of ``right``:
    the product of the two incidence matrices, a strip of columns at a time."""
    def entries(sets):
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    (i, x), (j, y) = entries(left), entries(right)
    columns = np.intersect1d(x, y)
    if left is right:       # an element of one set only joins no pair
        columns, times = np.unique(x, return_counts=True)
        columns = columns[times > 1]
    out = np.zeros((len(left), len(right)), np.int64)
    if not len(columns):
        return out

    def placed(row, value):
        at = np.minimum(np.searchsorted(columns, value), len(columns) - 1)
        own = columns[at] == value
        order = np.argsort(at[own], kind="stable")
        return row[own][order], at[own][order]
    (i, x), (j, y) = placed(i, x), placed(j, y)
    for lo in range(0, len(columns), STRIP):
        strips = []
        for count, row, at in ((len(left), i, x), (len(right), j, y)):
            part = slice(*np.searchsorted(at, [lo, lo + STRIP]))
            strip = np.zeros((count, min(STRIP, len(columns) - lo)), np.float32)
            strip[row[part], at[part] - lo] = 1
            strips.append(strip)
        out += (strips[0] @ strips[1].T).astype(np.int64)
    return out


def _links_of(pairs: bool) -> Callable:
    """The links of a product of two blocks: (a, b), or (node, n) with the
    number of documents that a node links to."""
    def links(rows: pa.Table) -> pa.Table:
        root, block, node, copies = (rows.column(c).to_numpy() for c in ("root", "block", "node", "copies"))
        lo, hi = rows.column("lo")[0].as_py(), rows.column("hi")[0].as_py()
        sets = [decode(h.as_py(), 0) for h in rows.column("hashes")]
        size = np.array([len(s) for s in sets], np.int64)
        first: list[np.ndarray] = []
        second: list[np.ndarray] = []
        order = np.argsort(root, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(root[order])) + 1):
            a = own[block[own] == lo]
            b = a if lo == hi else own[block[own] == hi]
            if not len(a) or not len(b):
                continue
            mine = [sets[r] for r in a]
            both = _shared(mine, mine if lo == hi else [sets[r] for r in b])
            linked = 100 * both >= PERCENT * (size[a][:, None] + size[b][None, :] - both)
            if lo == hi:
                np.fill_diagonal(linked, False)
            if pairs:
                i, j = np.nonzero(np.triu(linked) if lo == hi else linked)
                first.append(np.minimum(node[a][i], node[b][j]))
                second.append(np.maximum(node[a][i], node[b][j]))
            else:
                first.append(node[a])
                second.append(linked @ copies[b])
                if lo != hi:
                    first.append(node[b])
                    second.append(copies[a] @ linked)
        none = [np.zeros(0, np.int64)]
        return pa.table(dict(zip(("a", "b") if pairs else ("node", "n"),
                                 (np.concatenate(first or none), np.concatenate(second or none)))))
    return links


def _linked_blocks(solved: _Solved, pairs: bool) -> DataFrame:
    """All links, found inside the components, which hold them all: a component
    is dealt in blocks that meet pairwise, small components share a group."""
    members = stage(solved.roots.distinct().join(
        solved.reps.select("node", "copies", F.col("n").cast("long").alias("n")), "node"), "jaccard-members")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / ELEMENTS)).cast("int")
    large = stage(members.groupBy("root").agg(blocks.alias("blocks")).where("blocks > 1"), "jaccard-large")
    groups = members.agg(F.coalesce(blocks, F.lit(1))).first()[0]
    sets = solved.sets.dropDuplicates(["node"])     # a linked node was compared: its set is there
    count = F.coalesce("blocks", F.lit(1))
    dealt = (members.join(large, "root", "left").join(sets, "node")
             .withColumn("block", F.pmod(F.xxhash64("node"), count).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), count - 1)))
             .select(F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64("root"), F.lit(groups)))
                     .otherwise(F.col("root")).alias("own"),
                     F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"),
                     "root", "block", "node", "copies", "hashes"))
    return dealt.groupBy("own", "lo", "hi").applyInArrow(
        _links_of(pairs), "a long, b long" if pairs else "node long, n long")


def jaccard_links(docs: DataFrame) -> DataFrame:
    """Every link between different sets once: (a, b), nodes with a < b.  The
    membership is the node of ``jaccard_classes``; copies share a node."""
    return _linked_blocks(_solve(docs), True)


def jaccard_counts(docs: DataFrame) -> DataFrame:
    """The columns of ``jaccard_classes`` and n_links, the number of other
    documents that a document links to (its copies among them).  Links are
    counted where they are found; no row a link is made."""
    solved = _solve(docs)
    found = _linked_blocks(solved, False).groupBy("node").agg(F.sum("n").alias("n_links"))
    counts = solved.reps.select("node", "copies").join(found, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"))
    return _classes(solved).join(counts, "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))


def _split(batches: Iterator[pa.RecordBatch], marked: bytes, take_open: bool) -> Iterator[pa.RecordBatch]:
    """Rows whose id's bit is set (with their node), or the others."""
    open_ids = _unpacked(marked, np.int64)
    for batch in batches:
        bit = batch.column("bit").to_numpy()
        hit = (open_ids[bit >> 6] >> (bit & 63) & 1).astype(bool)
        batch = batch.filter(pa.array(hit == take_open))
        if not take_open:
            yield batch.select(["row"])
            continue
        nodes: list[int | None] = []
        for part in chunks(carried(batch, ["text"]), "text"):
            nodes += [set_hash(s) if len(s) else None
                      for s in shingle_sets(Words(part.column("text"), lower=True))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(nodes, pa.int64())], ["row", "node"])


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near copies: of every class the row with the
    smallest doc_id stays (an id repeated with the same shingles stays once).

    Ids of which a row goes are marked in a bitmap of fixed size; rows without a
    mark stay where they are, and only the marked ones are joined with the
    verdicts."""
    verdicts = stage(jaccard_classes(docs).groupBy("doc_id", "node").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "jaccard-verdicts")
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP))
    marked = _bitmap(verdicts.where("n > 1 or not kept").select(bit.alias("bit")))
    packed = carry(docs, docs.columns, ["doc_id", "text"]).withColumn("bit", F.pmod(F.xxhash64("row.doc_id"), F.lit(BITMAP)))
    row = packed.schema["row"]
    clear = packed.mapInArrow(apply_bound(_split, marked, False), StructType([row]))
    doubtful = packed.mapInArrow(apply_bound(_split, marked, True),
                                 StructType([row, StructField("node", LongType())]))
    kept = verdicts.where("kept")
    chosen = (doubtful.withColumn("id", F.col("row.doc_id"))
              .join(kept, F.col("id").eqNullSafe(kept["doc_id"]) & doubtful["node"].eqNullSafe(kept["node"]), "left_semi")
              .dropDuplicates(["id", "node"]).select("row"))
    return clear.unionByName(chosen).select("row.*")
