"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product is turned into smallest Euclidean distance: with ``M`` the
largest norm, a vector ``x`` gets the extra component ``sqrt(M^2 - |x|^2)`` and a
query is scaled to norm ``M``.  Each of ``TABLES`` tables hashes a vector to a
bucket by ``K`` p-stable (Gaussian) projections of width ``W``.  A query visits,
in every table, its own bucket and then perturbed buckets in the order of their
estimated success (the sum of squared distances to the crossed borders).  The
candidates of all tables are reranked by the inner product of the original
vectors in double precision.

Only the parameters are fitted, on a bounded sample of ``SAMPLE`` vectors: ``W``
from the spread of the projections, and the number of visits as the smallest
that finds ``SAMPLE_RECALL`` of the sample's neighbours of the same rank (in
proportion).  Every vector is indexed.

Spark groups vectors and visiting queries by table and bucket.  Buckets of more
than ``BLOCK`` vectors or queries are split in blocks that meet pairwise, so a
vector that a third of all rows share fills no single task.  Each group returns
the best ``k`` of each query.

Some queries search all vectors instead, in blocks: those that found fewer than
``k`` in all their buckets; those whose k-th candidate is so far away that the
visits find less than ``WEAK`` of the sample's neighbours at that distance (a query
off every cluster); those of whom the sample shows that they missed about
``MISSED`` of ``k`` or more (so many of its vectors are nearer than the k-th
candidate); and all, where even the largest number of visits misses the sample's
recall.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, take no part, neither do vectors of another length than most of the
sample; components are scaled by the largest one before they are squared, so very
large and very small vectors take part like others; equal scores go to the smaller id; an id given twice counts once, with
its better score; with no query or no candidate the result is empty; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .io import apply_bound, bounded_sample, stage
from .words import mix

TABLES = 8
WIDTH = 2.0             # of a projection's standard deviation
SAMPLE = 2000
SAMPLE_RECALL = 0.96
WEAK = 0.6
MISSED = 0.25
VISITS = [2, 4, 8, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256]
BLOCK = 4096
SEED = 7


class Index:
    """Projections and parameters of all tables (a few kilobytes)."""

    def __init__(self, dim: int, largest: float, hashes: int, unit: float = 1.0, tables: int = TABLES,
                 seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.dim, self.largest, self.tables, self.visits, self.unit = dim, largest, tables, 1, unit
        #: Least cosine (in lifted space) at which the visits find enough; whether they do at all.
        self.reach, self.sure = -math.inf, True
        self.a = rng.standard_normal((tables, dim + 1, hashes))
        self.b = rng.random((tables, hashes))
        self.width = 1.0

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.largest ** 2 - (x * x).sum(axis=1), 0.0)
        return np.column_stack([x, np.sqrt(rest)])

    def lift_queries(self, q: np.ndarray) -> np.ndarray:
        q = q / np.abs(q).max(axis=1, keepdims=True)
        norms = np.sqrt((q * q).sum(axis=1, keepdims=True))
        return np.column_stack([q * (self.largest / norms), np.zeros(len(q))])

    def cells(self, lifted: np.ndarray, table: int) -> np.ndarray:
        return lifted @ self.a[table] / self.width + self.b[table]

    @staticmethod
    def keys(cells: np.ndarray) -> np.ndarray:
        """One 64-bit key for every row of whole cell numbers."""
        key = np.zeros(len(cells), np.uint64)
        for column in np.floor(cells).astype(np.int64).T:
            key = mix(key * np.uint64(0x100000001B3) + column.view(np.uint64))
        return key.view(np.int64)


def probes(cell: np.ndarray, visits: int) -> list[np.ndarray]:
    """Cells to visit, the most promising first (the own one leads)."""
    home = np.floor(cell)
    x = cell - home
    steps = sorted([(float(v * v), i, -1) for i, v in enumerate(x)]
                   + [(float((1 - v) ** 2), i, 1) for i, v in enumerate(x)])
    out, heap = [home], [(steps[0][0], (0,))]
    while heap and len(out) < visits:
        cost, chosen = heapq.heappop(heap)
        if len({steps[j][1] for j in chosen}) == len(chosen):
            other = home.copy()
            for j in chosen:
                other[steps[j][1]] += steps[j][2]
            out.append(other)
        last = chosen[-1]
        if last + 1 < len(steps):
            heapq.heappush(heap, (cost - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + steps[last + 1][0], (*chosen, last + 1)))
    return out


def build(sample: np.ndarray, largest: float, total: int, k: int, unit: float = 1.0) -> Index:
    """Parameters fitted on the sample (see the module's notes); it and ``largest``
    are in units of ``unit``."""
    hashes = max(6, round(math.log2(max(total, 2)) / 2.6))
    index = Index(sample.shape[1], largest, hashes, unit)
    lifted = index.lift(sample)
    index.width = WIDTH * float(np.std([lifted @ a for a in index.a])) or 1.0
    asked = sample[:200]
    if len(sample) < 2:
        return index
    scores = asked @ sample.T
    np.fill_diagonal(scores, -np.inf)
    near = np.argsort(-scores, axis=1)[:, :max(1, min(len(sample) - 1, math.ceil(k * len(sample) / total)))]
    raised = index.lift_queries(asked)
    found = np.full(near.shape, VISITS[-1] + 1)      # the visit that finds each neighbour
    for t in range(index.tables):
        own, cells = index.keys(index.cells(lifted, t)), index.cells(raised, t)
        for i in range(len(asked)):
            order = {int(key): j for j, key in reversed(list(enumerate(
                index.keys(np.array(probes(cells[i], VISITS[-1]))))))}
            found[i] = np.minimum(found[i], [order.get(int(own[j]), VISITS[-1]) + 1 for j in near[i]])
    index.visits = next((v for v in VISITS if (found <= v).mean() >= SAMPLE_RECALL), VISITS[-1])
    hit = found <= index.visits
    index.sure = bool(hit.mean() >= SAMPLE_RECALL)
    norms = np.sqrt((asked * asked).sum(axis=1))
    cosine = np.take_along_axis(scores, near, axis=1) / np.maximum(norms[:, None] * largest, 1e-300)
    order = np.argsort(-cosine, axis=None)
    for part in np.array_split(order, max(1, min(20, len(order) // 10))):      # from near to far
        if hit.ravel()[part].mean() < WEAK:
            index.reach = float(cosine.ravel()[part].max())
            break
    else:       # beyond the sample's own neighbours nothing is known
        index.reach = float(cosine.min())
    return index


def _matrix(column: pa.Array, dim: int, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(np.float64)


def _pack_vectors(batches: Iterator[pa.RecordBatch], dim: int, kind: str, unit: float) -> Iterator[pa.RecordBatch]:
    """(vec_id, vector, norm): the components as bytes, the norm in units of ``unit``."""
    for batch in batches:
        rows = [np.asarray(v, kind) if len(v) == dim else None for v in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([None if v is None else v.tobytes() for v in rows], pa.binary()),
            pa.array([None if v is None else float(np.sqrt(((v.astype(np.float64) / unit) ** 2).sum())) for v in rows],
                     pa.float64())], ["vec_id", "vector", "norm"])


def _hash(batches: Iterator[pa.RecordBatch], index: Index, kind: str, asking: bool) -> Iterator[pa.RecordBatch]:
    """(id, vector, table, bucket): a row for every table, or for every visit."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            x = _matrix(part.column(1), index.dim, np.dtype(kind)) / index.unit
            lifted = index.lift_queries(x) if asking else index.lift(x)
            row, table, bucket = [], [], []
            for t in range(index.tables):
                cells = index.cells(lifted, t)
                if asking:
                    visits = [probes(c, index.visits) for c in cells]
                    owner = np.repeat(np.arange(len(x)), [len(v) for v in visits])
                    cells = np.array([c for v in visits for c in v])
                else:
                    owner = np.arange(len(x))
                row.append(owner)
                table.append(np.full(len(owner), t, np.int32))
                bucket.append(index.keys(cells))
            take = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(take), part.column(1).take(take),
                pa.array(np.concatenate(table)), pa.array(np.concatenate(bucket))],
                [part.schema.names[0], part.schema.names[1], "table", "bucket"])


def _doubtful(batches: Iterator[pa.RecordBatch], dim: int, kind: str, ids: np.ndarray, sample: np.ndarray,
              least: float) -> Iterator[pa.RecordBatch]:
    """The queries that are weak already, or whose k-th score is beaten by at
    least ``least`` vectors of the sample that were not found."""
    order = np.argsort(ids)
    ids, sample = ids[order], sample[order]
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            q = _matrix(part.column("qvector"), dim, np.dtype(kind))
            kth = part.column("kth").fill_null(-math.inf).to_numpy(zero_copy_only=False)
            scores = q @ sample.T
            slack = 1e-9 * (1.0 + np.abs(kth))
            beaten = (scores > (kth + slack)[:, None]) & (ids[None, :] != part.column("query_id").to_numpy()[:, None])
            got = part.column("found")
            owner, id_ = np.repeat(np.arange(len(q)), got.value_lengths().fill_null(0).to_numpy()), got.flatten().to_numpy()
            at_sample = np.minimum(np.searchsorted(ids, id_), len(ids) - 1)
            drawn = ids[at_sample] == id_
            beaten[owner[drawn], at_sample[drawn]] = False
            weak = part.column("weak").to_numpy(zero_copy_only=False) | (beaten.sum(axis=1) >= least)
            yield part.select(["query_id", "qvector"]).filter(pa.array(weak))


def _best(dim: int, kind: str, k: int) -> Callable:
    """The k best candidates of a block of vectors for each query of a block, each
    id once with its best row."""
    def best(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if vectors.num_rows and queries.num_rows:
            x = _matrix(vectors.column("vector"), dim, np.dtype(kind))
            ids = vectors.column("vec_id").to_numpy()
            by_id = np.argsort(ids, kind="stable")
            ids, x = ids[by_id], x[by_id]
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            asked = queries.column("query_id").to_numpy()
            for at in range(0, queries.num_rows, 256):
                q = _matrix(queries.column("qvector").slice(at, 256), dim, np.dtype(kind))
                rough = q @ x.T
                own = asked[at:at + 256]
                rough[own[:, None] == ids[None, :]] = -np.inf
                ranked = np.maximum.reduceat(rough, first, axis=1)     # the best row of an id
                for i in range(len(q)):
                    line, best_of = rough[i], ranked[i]
                    if len(best_of) > k:
                        # All that rounding could bring among the best, then the
                        # products summed in one fixed order.
                        bound = np.partition(best_of, len(best_of) - k)[len(best_of) - k]
                        slack = 1e-9 * (1.0 + float(np.abs(q[i]).sum()))
                        near = np.flatnonzero(line >= bound - slack)
                    else:
                        near = np.arange(len(line))
                    near = near[ids[near] != own[i]]
                    score = (x[near] * q[i]).sum(axis=1)
                    order = np.lexsort((ids[near], -score))
                    order = order[np.sort(np.unique(ids[near][order], return_index=True)[1])[:k]]
                    out.append((np.full(len(order), own[i]), ids[near][order], score[order]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))
    return best


def _meet(vectors: DataFrame, queries: DataFrame, keys: list[str], rank: Callable) -> DataFrame:
    """Groups of equal ``keys``, large ones split in blocks that meet pairwise."""
    def blocks(rows: DataFrame, name: str) -> DataFrame:
        return (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
                .select(*keys, F.ceil(F.col("n") / BLOCK).cast("int").alias(name)))

    def dealt(rows: DataFrame, own: str, other: str, key: str) -> DataFrame:
        mine, theirs = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
        return (rows.join(large, keys, "left")
                .withColumn(own, F.pmod(F.xxhash64(key), mine).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), theirs - 1))))
    large = stage(blocks(vectors, "vb").join(blocks(queries, "qb"), keys, "full"), "ann-blocks")
    groups = [*keys, "vb", "qb"]
    return (dealt(vectors, "vb", "qb", "vec_id").groupBy(*groups)
            .cogroup(dealt(queries, "qb", "vb", "query_id").groupBy(*groups))
            .applyInArrow(rank, "query_id long, vec_id long, score double"))


def _top(found: DataFrame, k: int) -> DataFrame:
    """rank 1..k a query; the same candidate from several buckets counts once."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """The ``k`` nearest found for every row for which ``is_query`` holds:
    query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession
    embedding = F.col("embedding")
    odd = F.exists(embedding, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == math.inf))
    some = F.exists(embedding, lambda v: v != 0)
    valid = (vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & ~odd & some))
    total, unit = valid.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform(
        embedding, lambda v: F.abs(v.cast("double")))))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    squares = F.aggregate(embedding, F.lit(0.0), lambda s, v: s + (v.cast("double") / unit) * (v.cast("double") / unit))
    largest = math.sqrt(valid.agg(F.max(squares)).first()[0])
    drawn = bounded_sample(valid, "vec_id", SAMPLE, total).select("vec_id", "embedding").collect()
    sample = [r["embedding"] for r in drawn]
    lengths = [len(v) for v in sample]
    dim = max(sorted(set(lengths)), key=lengths.count)
    kind = "float32" if "float" in vectors.schema["embedding"].dataType.simpleString() else "float64"
    index = build(np.array([v for v in sample if len(v) == dim], np.float64) / unit, largest, total, k, unit)

    packed = stage(valid.select("vec_id", "embedding").mapInArrow(
        apply_bound(_pack_vectors, dim, kind, unit), "vec_id long, vector binary, norm double")
        .where("vector is not null"), "ann-vectors")
    asked = packed.where(is_query).select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("qvector"), F.col("norm").alias("qnorm"))
    packed = packed.drop("norm")
    rank = _best(dim, kind, k)
    if index.sure:
        placed = packed.mapInArrow(
            apply_bound(_hash, index, kind, False), "vec_id long, vector binary, table int, bucket long")
        visits = asked.drop("qnorm").mapInArrow(
            apply_bound(_hash, index, kind, True), "query_id long, qvector binary, table int, bucket long")
        found = stage(_top(_meet(placed, visits, ["table", "bucket"], rank), k), "ann-found")
    else:
        found = spark.createDataFrame([], "query_id long, vec_id long, score double, rank int")

    # Queries with too few or too distant candidates search everything, in blocks.
    last = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"),
                                         F.collect_list("vec_id").alias("found"))       # k at most
    few = F.coalesce("n", F.lit(0)) < min(k, total - 1)
    far = F.col("kth") / unit / unit < index.reach * F.col("qnorm") * largest
    whole = {r["vec_id"]: r["embedding"] for r in drawn if len(r["embedding"]) == dim}
    least = max(1.0, MISSED * k * len(whole) / total)
    short = stage(
        asked.join(last, "query_id", "left").select(
            "query_id", "qvector", "kth", "found", F.coalesce(few | far, F.lit(True)).alias("weak"))
        .mapInArrow(apply_bound(_doubtful, dim, kind, np.array(list(whole), np.int64),
                                np.array(list(whole.values()), np.float64), least),
                    "query_id long, qvector binary"), "ann-short")
    if not short.isEmpty():
        parts = max(1, -(-total // BLOCK))
        part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
        everywhere = short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        more = _top(_meet(packed.withColumn("part", part), everywhere, ["part"], rank), k)
        found = found.join(short, "query_id", "left_anti").unionByName(more)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
