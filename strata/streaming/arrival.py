"""Process whatever files have arrived since the last run, exactly once.

``readStream`` over the landing directory with ``trigger(availableNow=True)``:
every file present is consumed in bounded micro-batches, then the query stops.
The checkpoint (in the shared scratch root) records the files already seen, so
a rerun with no new files adds nothing and a run that loses executors resumes
from the last committed batch.

De-duplication on a natural key keeps no stream state and drops no late row: a
micro-batch is reduced to one row a key and anti-joined with the keys already
stored.  The result does not depend on the order of the files or on the size of
the batches.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.sources.tables import read_optional
from strata.sources.writers import write_table

# Partition column of a de-duplicated target.
EVENT_DAY = "event_day"


def append_new_keys(dst: str, keys: Sequence[str], event_time: str,
                    repeat_days: int | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: append the rows whose key ``dst`` does not hold
    yet.  By default the key columns of the whole target are read; where repeats
    of a key are known to lie within ``repeat_days`` of each other, only the
    stored days that near to the batch's (partition pruning by a semi join).  A
    replayed batch finds its own rows stored and appends nothing."""
    def process(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        others = [c for c in batch.columns if c not in keys]
        new = (batch.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
               .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])
               .withColumn(EVENT_DAY, F.date_format(event_time, "yyyy-MM-dd")))
        stored = read_optional(spark, dst)
        if stored is not None:
            if repeat_days is not None:
                day = F.to_date(EVENT_DAY)
                near = new.select(F.explode(F.sequence(
                    F.date_sub(day, repeat_days), F.date_add(day, repeat_days))).alias("_near")).distinct()
                # Rows without an event time are all near each other.
                timeless = new.where(F.col(EVENT_DAY).isNull()).limit(1).select(F.lit(None).cast("date").alias("_near"))
                near = near.unionByName(timeless)
                stored = stored.join(near, F.to_date(stored[EVENT_DAY].cast("string")).eqNullSafe(near["_near"]), "left_semi")
            known = stored.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
            same = None
            for k in keys:
                e = new[k].eqNullSafe(known[f"_known_{k}"])
                same = e if same is None else same & e
            new = new.join(known, same, "left_anti")
        write_table(new, dst, mode="append", partition_by=[EVENT_DAY])
    return process


def ingest_available(spark: SparkSession, schema: T.StructType, src: str, dst: str,
                     checkpoint: str, fmt: str = "parquet",
                     dedup_keys: Sequence[str] | None = None, event_time: str | None = None,
                     repeat_days: int | None = None, max_files_per_batch: int | None = 1000,
                     options: dict[str, str] | None = None) -> StreamingQuery:
    """Append the files that arrived in ``src`` to ``dst``.  With ``dedup_keys``
    every key is stored once; ``event_time`` names the column whose day
    partitions the target, ``repeat_days`` see ``append_new_keys``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    writer = (reader.load(src).writeStream
              .option("checkpointLocation", checkpoint)
              .outputMode("append")
              .trigger(availableNow=True))
    if dedup_keys:
        if not event_time:
            raise ValueError("de-duplication needs the event time that partitions the target")
        writer = writer.foreachBatch(append_new_keys(dst, list(dedup_keys), event_time, repeat_days))
    else:
        writer = writer.format("parquet").option("path", dst)
    q = writer.start()
    q.awaitTermination()
    return q


def ingest_csv_available(spark: SparkSession, src: str, expected: T.StructType,
                         process_batch: Callable[[DataFrame, int], None], checkpoint: str,
                         max_files_per_batch: int = 1000, glob: str | None = None) -> StreamingQuery:
    """Land-and-gate for source files that keep arriving.

    The stream reads every new file (``src`` may be a glob such as
    ``landing/*/``) with the same all-string, header-aware projection as the
    batch scan, and hands each micro-batch to ``process_batch(df, batch_id)``
    (``foreachBatch``).  Whole files belong to one micro-batch, so per-file
    verdicts can be taken inside the batch."""
    from strata.sources.files import CSV_FILES, CSV_OPTIONS, landed_projection, landed_string_schema
    raw = (spark.readStream.schema(landed_string_schema(expected))
           .options(**CSV_OPTIONS)
           .option("pathGlobFilter", glob or CSV_FILES)
           .option("maxFilesPerTrigger", max_files_per_batch)
           .csv(src))
    q = (landed_projection(raw, expected).writeStream
         .foreachBatch(process_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
