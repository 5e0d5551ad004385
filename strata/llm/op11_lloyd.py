"""Centroid clustering: Lloyd's algorithm sharded by dimension.

Vectors are turned into integers and cut in column blocks.  A cell is one block
of ``CHUNK`` vectors; the cells are dealt over the cluster once and stay there,
so a task holds some columns of some vectors, and sees only those columns of the
centroids.  A round is one job:

1. every task sends, for each vector of its cells, the exact squared distance to
   every centroid within its block;
2. these partial distances are added up by chunk, and the smallest sum (of equal
   ones the first) is the vector's cluster;
3. the cluster numbers go back to the blocks' tasks, which add their columns by
   cluster; each block's new slice is the exact floor of sum by count.

Distances and clusters are shuffled, vectors are not.  The centroids (``k`` times
the dimension numbers) travel through the driver, nothing else does.  All sums
are of integers, so neither the order of additions nor a repeated task changes a
result.  The cells are stored in the checkpoint folder and cached on the
executors' disks; a lost executor's cells are read again.

Defined cases: null vectors and those of another length, or with a null or
non-finite component, take no part and are not returned; a component beyond what
keeps squared distances in 64 bits is an error, not a dropped row; with fewer
than ``k`` vectors each is a centroid, with none there is no row; repeated rows
are separate vectors (of one id the smaller vector is drawn first); a null id is
drawn by the text ``3:``; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .io import apply_bound, stage

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: Columns of a block, vectors of a chunk.
WIDTH = 16
CHUNK = 2048

_RESULT = "vec_id {id}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def takes_part(vector: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` components, all of them finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == math.inf))
    return F.coalesce((F.size(vector) == dim) & ~odd, F.lit(False))


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    x = column.flatten().cast(pa.float64()).to_numpy().reshape(-1, dim)
    whole = np.floor(SCALE * x)
    if len(whole) and dim * (2 * np.abs(whole).max()) ** 2 >= 2.0 ** 62:
        raise ValueError("a component is too large: squared distances would leave 64 bits")
    return whole.astype(np.int32)


def _cells(batches: Iterator[pa.RecordBatch], dim: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """(chunk, block, ids, columns): the ids go with the first block."""
    chunk = TaskContext.get().partitionId() << 33
    blocks = range(math.ceil(dim / WIDTH))
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            x = _integers(part.column("vector"), dim)
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk] * len(blocks), pa.int64()), pa.array(blocks, pa.int32()),
                pa.array([part.column("vec_id").to_pylist(), *[None] * (len(blocks) - 1)], pa.list_(id_type)),
                pa.array([x[:, b * WIDTH:(b + 1) * WIDTH].tobytes() for b in blocks], pa.binary())],
                ["chunk", "block", "ids", "columns"])
            chunk += 1


def _matrix(raw: pa.Scalar, width: int, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(raw.as_buffer(), kind).reshape(-1, width)


def _partials(batches: Iterator[pa.RecordBatch], slices: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(chunk, partial): within a block, each vector's squared distance to every
    centroid's slice."""
    for batch in batches:
        for chunk, block, columns in zip(batch.column("chunk"), batch.column("block"), batch.column("columns")):
            own = slices[block.as_py()]
            x = _matrix(columns, own.shape[1], np.int32)
            partial = np.empty((len(x), len(own)), np.int64)
            for k, centroid in enumerate(own):
                apart = x - centroid
                partial[:, k] = np.einsum("ij,ij->i", apart, apart)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk.as_py()], pa.int64()), pa.array([partial.tobytes()], pa.binary())], ["chunk", "partial"])


def _nearest(k: int):
    """Adds the blocks' partial distances of a chunk and takes the nearest."""
    def nearest(rows: pa.Table) -> pa.Table:
        total = sum(_matrix(p, k) for p in rows.column("partial"))
        cluster = total.argmin(axis=1).astype(np.int32)
        return pa.table({"chunk": rows.column("chunk")[:1], "clusters": [cluster], "distances": [total.min(axis=1)]})
    return nearest


def _sums(batches: Iterator[pa.RecordBatch], widths: list[int], k: int) -> Iterator[pa.RecordBatch]:
    """(block, cluster, at, total, n): a task's sums of each column by cluster."""
    totals: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for block, columns, clusters in zip(*(batch.column(c) for c in ("block", "columns", "clusters"))):
            b = block.as_py()
            x, own = _matrix(columns, widths[b], np.int32), clusters.values.to_numpy()
            total, n = totals.setdefault(b, (np.zeros((k, widths[b]), np.int64), np.zeros(k, np.int64)))
            np.add.at(total, own, x)
            n += np.bincount(own, minlength=k)
    for b, (total, n) in totals.items():
        used = np.repeat(np.flatnonzero(n), widths[b])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(used), b, np.int32)), pa.array(used.astype(np.int32)),
            pa.array(np.tile(np.arange(widths[b], dtype=np.int32), int((n > 0).sum()))),
            pa.array(total[n > 0].ravel()), pa.array(n[used])], ["block", "cluster", "at", "total", "n"])


class _Shards:
    """The cells, dealt by block and chunk and kept where they are."""

    def __init__(self, cells: DataFrame, dim: int, k: int):
        self.widths = [min(WIDTH, dim - at) for at in range(0, dim, WIDTH)]
        self.k = k
        parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.cells = (cells.select("block", "chunk", "columns").repartition(parts, "block", "chunk")
                      .persist(StorageLevel.DISK_ONLY))

    def nearest(self, centroids: np.ndarray) -> DataFrame:
        """(chunk, clusters, distances) under these centroids."""
        slices = np.split(centroids, np.cumsum(self.widths)[:-1], axis=1)
        return (self.cells.mapInArrow(apply_bound(_partials, slices), "chunk long, partial binary")
                .groupBy("chunk").applyInArrow(
                    _nearest(self.k), "chunk long, clusters array<int>, distances array<long>"))

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after one round; one without vectors stays."""
        blocks = F.explode(F.sequence(F.lit(0), F.lit(len(self.widths) - 1)))
        sent = self.nearest(centroids).select(blocks.alias("block"), "chunk", "clusters")
        total, n = F.sum("total"), F.sum("n")
        new = (self.cells.join(sent.hint("shuffle_hash"), ["block", "chunk"])
               .mapInArrow(apply_bound(_sums, self.widths, self.k),
                           "block int, cluster int, at int, total long, n long")
               .groupBy("block", "cluster", "at").agg(total.alias("total"), n.alias("n"))
               .select("block", "cluster", "at", F.expr("(total - pmod(total, n)) div n").alias("value")))
        out = centroids.copy()
        for row in new.collect():       # k times the dimension rows at most
            out[row["cluster"], row["block"] * WIDTH + row["at"]] = row["value"]
        return out


def _first(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes: ``k`` rows a task, ``k`` in the end."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE))
    rows = kept.select(mark.alias("mark"), whole.alias("whole")).orderBy("mark", "whole").limit(k).collect()
    return np.array([r["whole"] for r in rows], np.int64)


def cluster(vectors: DataFrame, dim: int, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
            names: Sequence[str] = ("vec_id", "embedding")) -> DataFrame:
    """One row a vector that takes part: vec_id, cluster, distance (squared),
    cluster_inertia, inertia and centroid_sha256 (of the cluster's final centroid,
    its integers joined by commas)."""
    spark = vectors.sparkSession
    kept = (vectors.select(F.col(f"`{names[0]}`").alias("vec_id"), F.col(f"`{names[1]}`").alias("vector"))
            .where(takes_part(F.col("vector"), dim)))
    id_field = kept.schema["vec_id"]
    schema = _RESULT.format(id=id_field.dataType.simpleString())
    centroids = _first(kept, k, seed)
    k = len(centroids)
    if not k:
        return spark.createDataFrame([], schema)
    cells = stage(kept.mapInArrow(
        apply_bound(_cells, dim, to_arrow_type(id_field.dataType)),
        f"chunk long, block int, ids array<{id_field.dataType.simpleString()}>, columns binary"), "lloyd-cells")
    shards = _Shards(cells, dim, k)
    try:
        for _ in range(rounds):
            before, centroids = centroids, shards.moved(centroids)
            if (before == centroids).all():     # every further round is the same
                break
        nearest = stage(shards.nearest(centroids), "lloyd-clusters")
    finally:
        shards.cells.unpersist()
    found = (cells.where("block = 0").select("chunk", "ids").join(nearest, "chunk")
             .select(F.inline(F.arrays_zip("ids", "clusters", "distances")))
             .toDF("vec_id", "cluster", "distance"))
    sums = {r["cluster"]: r["inertia"] for r in       # k rows
            nearest.select(F.inline(F.arrays_zip("clusters", "distances"))).toDF("cluster", "distance")
            .groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, sums.get(c, 0), sum(sums.values()), digest[c]) for c in range(k)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(      # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
