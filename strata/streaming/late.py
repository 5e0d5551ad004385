"""De-duplication within a watermark, late rows kept apart.

Three streams over one arrival, each run with ``availableNow``:

* ``arrived``: the new files are copied into a table, so that the other two see
  the same rows however many files land meanwhile;
* ``stored``: Spark's state store keeps the keys seen within ``delay`` of the
  latest event time (``dropDuplicatesWithinWatermark``) and forgets older ones, so
  the state does not grow with the table.  Rows older than the watermark cannot
  be judged any more and are dropped there;
* ``late``: the arrived rows whose key was not stored, with the reason: those
  the watermark dropped, and those without an event time, which never enter the
  state store.

Every arrived row is stored, quarantined or a repeat of a stored row; a late row
whose key is stored already is a repeat.  All tables are written exactly once: the
first two by the file sink's log, the third by a directory a batch.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from strata.sources.tables import read_optional
from strata.sources.writers import write_table

# The reasons of the quarantine.
REASON_LATE, REASON_NO_TIME = "later than the watermark", "no event time"

_CLOCK = "_event_clock"


@dataclass(frozen=True)
class LateTables:
    root: str

    @property
    def arrived(self) -> str:
        return f"{self.root}/arrived"

    @property
    def stored(self) -> str:
        return f"{self.root}/stored"

    @property
    def late(self) -> str:
        return f"{self.root}/late"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def _finish(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _quarantine(tables: LateTables, schema: T.StructType, keys: Sequence[str], event_time: str):
    def process(batch: DataFrame, batch_id: int) -> None:
        stored = batch.sparkSession.read.schema(schema).parquet(tables.stored)
        known = stored.select(*(F.col(k).alias(f"_known_{k}") for k in keys))
        same = F.lit(True)
        for k in keys:
            same = same & batch[k].eqNullSafe(known[f"_known_{k}"])
        reason = F.when(F.col(event_time).isNull(), REASON_NO_TIME).otherwise(REASON_LATE)
        write_table(batch.join(known, same, "left_anti").withColumn("late_reason", reason),
                    f"{tables.late}/batch={batch_id}")
    return process


def ingest_within_watermark(spark: SparkSession, schema: T.StructType, src: str, root: str,
                            keys: Sequence[str], event_time: str, delay: str, fmt: str = "parquet",
                            max_files_per_batch: int | None = 1000,
                            options: dict[str, str] | None = None) -> LateTables:
    """Take the files that arrived in ``src`` since the last run into the tables
    under ``root`` (see the module's notes).  ``delay`` is how late a row may be,
    such as ``"2 days"``."""
    tables = LateTables(root)
    source = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    arrived = spark.readStream.schema(schema)
    if max_files_per_batch:
        source = source.option("maxFilesPerTrigger", max_files_per_batch)
        arrived = arrived.option("maxFilesPerTrigger", max_files_per_batch)
    copied = _finish(source.load(src).writeStream.format("parquet").option("path", tables.arrived),
                     tables.checkpoint("arrived"))
    if not any(p.numInputRows for p in copied.recentProgress) and read_optional(
            spark, f"{tables.arrived}/*.parquet") is None:     # nothing has ever arrived
        return tables
    # A watermark needs a time stamp with a zone (the session's, which is fixed).
    first = (arrived.parquet(tables.arrived).where(F.col(event_time).isNotNull())
             .withColumn(_CLOCK, F.col(event_time).cast("timestamp")).withWatermark(_CLOCK, delay)
             .dropDuplicatesWithinWatermark(list(keys)).drop(_CLOCK))
    _finish(first.writeStream.outputMode("append").format("parquet").option("path", tables.stored),
            tables.checkpoint("stored"))
    _finish(arrived.parquet(tables.arrived).writeStream.foreachBatch(
        _quarantine(tables, schema, keys, event_time)), tables.checkpoint("late"))
    return tables


def read_late(spark: SparkSession, tables: LateTables, schema: T.StructType) -> DataFrame:
    """The quarantined rows with their reason."""
    whole = T.StructType([*schema.fields, T.StructField("late_reason", T.StringType()),
                          T.StructField("batch", T.IntegerType())])
    return spark.read.schema(whole).parquet(tables.late).drop("batch")
