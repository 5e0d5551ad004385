"""Conflict-constrained best-fit packing of documents into token bins.

A bin holds ``CAPACITY`` tokens (words).  Two pieces conflict, and never share
a bin, when they come from the same source or from the same duplicate cluster
(equal texts).  A text longer than a bin is cut into full pieces, which fill a
bin each, and a remainder; remainders and short texts are packed best-fit, the
longest first: the open bins are kept in order of their residual room, each with
a bitmap of its sources and one of its duplicate clusters, and from the first
bin that is large enough the search goes on to the next one until the bitmaps
allow the piece.  That is the tightest compatible bin; if there is none, a new
bin is opened.

Spark deals the documents evenly to packing blocks of about ``BLOCK_ROWS`` (by a
hash of id, size, source and cluster, repeated rows spread by their number), so
the packing does not depend on how files are split, and a hot source or a large group of copies is spread over all blocks; one task packs one
block at a time.  Only ids, sizes and hashes are shuffled, never texts.

Defined cases: a null source conflicts with nothing; null and empty texts have 0
tokens and no cluster, and take their place in a bin like others; repeated rows
are separate documents; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .io import stage

CAPACITY = 2048
BLOCK_ROWS = 4096
#: Copies of a repeated row that are written out at once.
COPIES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


class Bins:
    """Open bins of one block: a sorted list of (residual, bin) and two bitmaps a bin."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset for a piece; ``source`` and ``cluster`` are bitmaps of
        one bit, or 0."""
        at = bisect.bisect_left(self.order, (size, -1))
        for i in range(at, len(self.order)):
            room, number = self.order[i]
            if not (self.sources[number] & source or self.clusters[number] & cluster):
                del self.order[i]
                break
        else:
            room, number = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[number] |= source
        self.clusters[number] |= cluster
        # A bin without room stays: pieces of 0 tokens still fit.
        bisect.insort(self.order, (room - size, number))
        return number, self.capacity - room


def _bits(values: list) -> list[int]:
    """One bit for each distinct value, 0 for nulls."""
    known: dict = {}
    return [0 if v is None else known.setdefault(v, 1 << len(known)) for v in values]


def _pack(capacity: int) -> Callable:
    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        block = key[0].as_py()
        size = rows.column("n_tokens").to_numpy()
        order = np.lexsort((rows.column("row_hash").to_numpy(), -(size % capacity)))
        source = _bits(rows.column("source_hash").to_pylist())
        cluster = _bits(rows.column("cluster").to_pylist())
        bins = Bins(capacity)
        row, piece, number, offset, tokens = [], [], [], [], []
        for i in order.tolist():
            n = int(size[i])
            full, rest = divmod(n, capacity)
            for p in range(full):       # a full piece is a bin of its own
                row.append(i)
                piece.append(p)
                number.append(len(bins.sources))
                offset.append(0)
                tokens.append(capacity)
                bins.sources.append(-1)
                bins.clusters.append(-1)
            if rest or not full:
                b, o = bins.place(rest, source[i], cluster[i])
                row.append(i)
                piece.append(full)
                number.append(b)
                offset.append(o)
                tokens.append(rest)
        piece_at = np.array(piece, np.int64)
        return pa.table({
            "doc_id": rows.column("doc_id").take(pa.array(row, pa.int64())),
            "piece": pa.array(piece_at.astype(np.int32)),
            "first_token": pa.array(piece_at * capacity),
            "n_tokens": pa.array(np.array(tokens, np.int64)),
            "bin_id": pa.array((block << 32) + np.array(number, np.int64)),
            "bin_offset": pa.array(np.array(offset, np.int64)),
        })
    return pack


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: doc_id, piece (from 0), first_token (of the text),
    n_tokens, bin_id and bin_offset (tokens before it in the bin)."""
    text = F.col("text")
    same = ["doc_id", "n_tokens", "source_hash", "cluster"]
    rows = docs.select(
        "doc_id", F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        F.when(F.col("source").isNotNull(), F.xxhash64("source")).alias("source_hash"),
        F.when(F.length(text) > 0, F.xxhash64(text)).alias("cluster"))
    # Repeated rows are counted and numbered, so a row's hash depends on its
    # values alone, not on the files it comes from.
    counted = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n"))
    runs = counted.select(*same, "n", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("first"))
    copies = runs.select(*same, F.explode(F.sequence(
        F.col("first"), F.least(F.col("first") + COPIES, F.col("n")) - 1)).alias("copy"))
    narrow = stage(copies.select(*same, F.xxhash64(*same, "copy").alias("row_hash")), "pack-input")
    blocks = max(1, round(narrow.count() / BLOCK_ROWS))
    schema = StructType([
        docs.select("doc_id").schema[0], StructField("piece", IntegerType()),
        *(StructField(c, LongType()) for c in ("first_token", "n_tokens", "bin_id", "bin_offset"))])
    return (narrow.withColumn("block", F.pmod("row_hash", F.lit(blocks)))
            .groupBy("block").applyInArrow(_pack(capacity), schema))
