"""Q6/Q7 driven by Structured Streaming instead of a batch-window table.

The batch jobs keep ``start_date``/``end_date`` in a state table (B1/K12) to
know which log days are new.  A file stream over the log directory tracks
that in its checkpoint: every run with ``availableNow`` processes exactly
the log files added since the last run, then stops.  Each micro-batch is
merged into the per-day table with the same operators as ``plans.usage``.

Replays are exactly-once: a micro-batch first writes its merged rows to a
staging path named by its batch id, then replaces the affected partitions
from that staging copy, then writes an ``applied`` marker.  A replayed batch
that was applied is skipped; one that was staged but not applied is applied
from the staged copy (never merged twice into the table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from usagetally.plans.usage import UsageJobConfig, condense, merged_days, partitions
from usagetally.schemas import LOG_SCHEMA
from usagetally.session import exists
from usagetally.sources.sinks import remove, replace_partitions, stage


def _marker(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(jpath, True).close()


def apply_batch(cfg: UsageJobConfig, work_dir: str, batch: DataFrame, batch_id: int) -> None:
    """Merge one micro-batch of log rows into the per-day table (idempotent)."""
    spark = batch.sparkSession
    staged = f"{work_dir.rstrip('/')}/staged/batch={batch_id}"
    applied = f"{work_dir.rstrip('/')}/applied/batch={batch_id}"
    if exists(spark, applied):
        return
    if not exists(spark, f"{staged}/_SUCCESS"):
        # the condensed batch is used twice (its days, then the merge): write it once
        day = stage(condense(batch, cfg), "day", f"{work_dir.rstrip('/')}/days/batch={batch_id}")
        merged_days(spark, cfg, day).write.mode("overwrite").parquet(staged)
    out = spark.read.parquet(staged)
    replace_partitions(out, cfg.table, partitions(cfg))
    _marker(spark, applied)
    for done in (staged, f"{work_dir.rstrip('/')}/days/batch={batch_id}"):     # only the marker is needed from here on
        remove(spark, done)


def start_usage_stream(spark: SparkSession, cfg: UsageJobConfig, work_dir: str,
                       log_schema=None, max_files_per_trigger: int | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``work_dir`` (in the shared folder) holds the stream
    checkpoint and the per-batch staging copies.

    ``available_now`` processes everything new and stops (a scheduled batch);
    otherwise the stream keeps running and merges files as they land.
    ``log_schema`` must include the day column when the log is partitioned
    by it (default: the 18-column log schema plus ``seq``).
    """
    schema = log_schema or StructType([*LOG_SCHEMA.fields, StructField("seq", LongType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(cfg.log)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: apply_batch(cfg, work_dir, df, bid))
              .option("checkpointLocation", f"{work_dir.rstrip('/')}/checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
