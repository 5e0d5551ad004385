"""Tables, scratch and deterministic samples shared by the operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    result survives lost executors and is computed once."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_bucket(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus`` (null counts as empty)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_sample(rows: DataFrame, key: str, limit: int,
                   total: int | None = None) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hash of ``key``.

    A hash threshold thins the rows where they lie before the exact limit, so
    the limit's single task reads little more than ``limit`` rows at any size.
    """
    n = rows.count() if total is None else total
    h = F.xxhash64(F.lit(20177), F.col(key))
    if n > 2 * limit:
        share = 1.3 * limit / n
        rows = rows.where(F.pmod(h, F.lit(1 << 40)) < int(share * (1 << 40)))
    return rows.orderBy(F.pmod(h, F.lit(1 << 40)), key).limit(limit)


def training_texts(docs: DataFrame, known: DataFrame, rows: int, size: int,
                   also: Sequence[str] = ()) -> DataFrame:
    """(text, label, also) of the training sample, in one partition and in a fixed order,
    whatever the partitioning of ``docs``.

    ``known`` has one (doc_id, label) an id.  At most ``rows`` ids, those with the
    smallest hash, are taken in hash order while their texts sum up to less than
    ``size`` bytes; lengths decide that, so no text moves before the bound acts.
    An id with several rows trains with its shortest text (then the smallest hash)."""
    sample = bounded_sample(known, "doc_id", rows)
    marked = docs.select("doc_id", "text", *also).where("text is not null and doc_id is not null").withColumns({
        "_bytes": F.octet_length("text"), "_mark": F.xxhash64("text", *also)})
    one = (marked.join(F.broadcast(sample), "doc_id")        # at most `rows` rows
           .groupBy("doc_id", "label").agg(F.min(F.struct("_bytes", "_mark")).alias("own")))
    order = Window.orderBy(F.xxhash64(F.lit(20177), "doc_id"), "doc_id")
    taken = (one.select("doc_id", "label", "own.*", F.row_number().over(order).alias("_place"),
                        F.sum("own._bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
             .where(F.coalesce("before", F.lit(0)) < size).drop("before"))
    return (marked.join(F.broadcast(taken), ["doc_id", "_bytes", "_mark"])
            .groupBy("_place", "label").agg(*(F.first(c).alias(c) for c in ("text", *also)))
            .repartition(1).sortWithinPartitions("_place").select("text", "label", *also))


def carry(docs: DataFrame, keep: Sequence[str], used: Sequence[str], **more: Column) -> DataFrame:
    """The columns ``keep`` as one struct ``row`` and those of ``used`` that are
    not among them as one struct ``used``: a worker hands ``row`` back as it is,
    so a caller's names never clash, and no text is sent twice (see ``carried``)."""
    rest = [c for c in used if c not in keep]
    return docs.select(*(F.struct(*(F.col(f"`{c}`") for c in cs)).alias(name) if cs
                         else F.struct(F.lit(0).alias("_none")).alias(name)
                         for name, cs in (("row", keep), ("used", rest))),
                       *(column.alias(name) for name, column in more.items()))


def carried(batch: pa.RecordBatch | pa.Table, names: Sequence[str]) -> pa.RecordBatch:
    """The named columns of a batch of ``carry``."""
    if isinstance(batch, pa.Table):
        batch = batch.select(["row", "used"]).combine_chunks().to_batches()[0]
    own = {f.name: batch.column(c).field(f.name) for c in ("used", "row") for f in batch.column(c).type}
    return pa.RecordBatch.from_arrays([own[n] for n in names], list(names))


def give_back() -> None:
    """Return the memory that a task freed to the system: Python workers are used
    again, and the next task's peak would come on top of what they keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def apply_bound(fn: Callable, *args) -> Callable:
    """``fn`` with leading arguments fixed (picklable for Spark's workers)."""
    def bound(batches):
        yield from fn(batches, *args)
        give_back()
    return bound
