"""Session construction and shared scratch locations.

Scratch output (landed files, refreshed partitions, checkpoints) always goes
under the directory the cluster names in ``spark.checkpoint.dir``; a local
temporary directory is only chosen when that setting is absent (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _submitted() -> bool:
    """Whether spark-submit started this process (it then sets the master)."""
    return "PYSPARK_GATEWAY_PORT" in os.environ


def build_session(app: str = "strata", cpus: int | str = "*",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session configured the way the library expects a cluster to be: local,
    or on the master that spark-submit names.

    AQE is on (runtime coalescing, skew-join splitting, broadcast conversion);
    the UI is off; the session time zone is pinned so that date arithmetic is
    reproducible.
    """
    n = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if not _submitted():
        # local[N] has no executors to list files on: list landing
        # directories on the driver instead of one task per directory.
        # Clusters keep Spark's default parallel listing.
        builder = (builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g")
                   .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session, or None (e.g. Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:   # Spark Connect sessions expose no SparkContext
        return None


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (keys per-session caches)."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (default parallelism), or the shuffle
    partition count when the context is not reachable."""
    sc = _context(spark)
    return sc.defaultParallelism if sc is not None else int(spark.conf.get("spark.sql.shuffle.partitions"))


_fallback_dirs: dict[str, str] = {}


def _local_scratch(master: str) -> str:
    """A temporary directory, only where driver and executors are one process."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(
            f"spark.checkpoint.dir is not set and the master is {master!r}: name a folder that the driver "
            "and all executors share")
    return tempfile.mkdtemp(prefix="strata-checkpoint-")


def work_dir(spark: SparkSession) -> str:
    """The shared scratch root: ``spark.checkpoint.dir`` of the session.

    Where none is named, a local master (tests, laptops) gets a private temporary
    directory; any other master is an error."""
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured.rstrip("/")
        key = session_key(spark)
        if key not in _fallback_dirs:
            _fallback_dirs[key] = _local_scratch(spark.conf.get("spark.master", ""))
        return _fallback_dirs[key]
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    sc.setCheckpointDir(_local_scratch(sc.master))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared scratch root."""
    return f"{work_dir(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing will read again (a session without a
    SparkContext leaves it to the owner of the scratch root)."""
    sc = _context(spark)
    if sc is not None:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files: Spark removes them when the
    execution ends.  Else they lie on the executors' disks until the driver's garbage
    is collected, those of all steps of a pipeline at once."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
