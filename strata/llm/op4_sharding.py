"""Sharding by a Feistel permutation of global row numbers [native].

Every row gets a global number, a keyed Feistel network permutes the numbers,
and the permuted number ``p`` gives ``shard = p mod shards`` and
``slot = p div shards``.  Shard and slot of a row follow from its number, the
row count and the seed alone; counts of any two shards differ by at most one
(law ``rows``).

Numbers: rows are dealt to ``NUMBERING_BUCKETS`` buckets by a hash of their
content, numbered inside their bucket, and shifted by the rows of the buckets
before; equal rows take neighbouring numbers.  Only id, size and checksum are shuffled, never texts.

The network works on ``Z_a x Z_b`` with ``a = ceil(sqrt n)``, ``b = ceil(n/a)``,
so fewer than ``a`` of the ``a*b`` points lie outside ``0..n-1``.  A row whose
image lies outside walks its cycle until it comes back.  A walk is never longer
than the number of outside points plus one; up to ``MAX_WALK`` steps are in the
expression (the chance that any row needs more is below ``n**(1-MAX_WALK/2)``),
and a longer walk would raise an error, never return a wrong slot.

Defined cases: null text has size 1 and checksum 0, as empty text; repeated
rows get different numbers; a null id is an ordinary value; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .io import stage

NUMBERING_BUCKETS = 4096
UNFOLD = 100_000
ROUNDS = 6
MAX_WALK = 32


def number_rows(rows: DataFrame, out: str) -> tuple[DataFrame, int]:
    """Gapless global numbers from 0 and the row count.  ``rows`` should be a
    stored, narrow table: it is read twice."""
    cols = rows.columns
    bucketed = rows.withColumn("_b", F.pmod(F.xxhash64(*cols), F.lit(NUMBERING_BUCKETS)))
    counts = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    # One row a bucket: bounded by NUMBERING_BUCKETS for the running sum's
    # single task and for the broadcast.
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ahead = Window.partitionBy("_b").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        # Equal rows are counted before the shuffle and unfolded after it, in
        # two steps, so that one often repeated row neither fills a bucket nor
        # becomes one long array.
        bucketed.groupBy("_b", *cols).agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_i", F.coalesce(F.sum("_c").over(ahead), F.lit(0)))
        .join(F.broadcast(shift), "_b")
        .withColumn("_from", F.explode(F.sequence(F.lit(0), F.col("_c") - 1, F.lit(UNFOLD))))
        .withColumn("_k", F.explode(F.sequence(
            F.col("_from"), F.least(F.col("_from") + (UNFOLD - 1), F.col("_c") - 1))))
        .withColumn(out, F.col("_start") + F.col("_i") + F.col("_k"))
        .select(*cols, out)
    )
    return numbered, total


def div(x: Column, by: int) -> Column:
    """Whole quotient of a non-negative long (the division is exact)."""
    return ((x - x % F.lit(by)) / F.lit(by)).cast("long")


def feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network over ``0..a*b-1``: alternate halves are shifted
    by a hash of the other half."""
    left, right = div(x, b), x % F.lit(b)
    for r in range(ROUNDS):
        if r % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), F.lit(r), right), F.lit(a)), F.lit(a))
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), F.lit(r), left), F.lit(b)), F.lit(b))
    return left * F.lit(b) + right


def permute(x: Column, n: int, seed: int) -> Column:
    """The image of row number ``x`` under a permutation of ``0..n-1``."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    b = max(1, -(-n // a))
    steps = min(a * b - n + 1, MAX_WALK)
    first = feistel(x, a, b, seed)
    if a * b == n:
        return first
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), x,
        lambda at, k: F.when((k > 1) & (at < n), at).otherwise(feistel(at, a, b, seed)))
    return F.when(walked < n, walked).otherwise(
        F.raise_error(F.lit("a cycle walk was longer than MAX_WALK")).cast("long"))


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = stage(docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32")), "shard-rows")
    numbered, n = number_rows(narrow, "_row")
    placed = numbered.withColumn("_p", permute(F.col("_row"), n, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("_p") % shards).cast("int").alias("shard"),
        div(F.col("_p"), shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("_row").alias("row_number"))
