"""Q6, Q7: per-day feature-usage tables, merged incrementally by trigger day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from usagetally import operators as op
from usagetally.operators.quality import usage_quality
from usagetally.schemas import PROJECT_USAGE_SCHEMA, USAGE_PRODUCTS, USER_USAGE_SCHEMA
from usagetally.sources.files import remove
from usagetally.sources.journal import Journal, once
from usagetally.sources.log import read_log, usage_history
from usagetally.sources.sinks import RunFolder, replace_partitions


@dataclass
class UsageJobConfig:
    log: str
    table: str                          # tmday-partitioned usage table
    with_project: bool = True           # Q6 (project) or Q7 (user)
    products: tuple = USAGE_PRODUCTS    # P3; empty = every product (P4)
    day_col: str = "mday"
    log_schema: StructType | None = None  # declared log schema: only the window's day folders are listed (S1)
    tiebreak: str | None = None
    key_delimiter: str = ""
    extra_partitions: tuple = ()        # e.g. ("pcode",) for the (pcode, tmday) layout (K7)
    key_buckets: int = 0                # > 0: tmday=…/kb=… layout, kb = pmod(xxhash64(key), n)


def partitions(cfg: UsageJobConfig) -> tuple:
    return (*cfg.extra_partitions, "tmday", *(("kb",) if cfg.key_buckets else ()))


def _schema(cfg: UsageJobConfig):
    return PROJECT_USAGE_SCHEMA if cfg.with_project else USER_USAGE_SCHEMA


def condense(log: DataFrame, cfg: UsageJobConfig) -> DataFrame:
    fn = op.usage_condense if cfg.with_project else op.user_usage_condense
    return fn(log, cfg.products, cfg.tiebreak, cfg.key_delimiter)


def key_bucket(cfg: UsageJobConfig):
    return F.pmod(F.xxhash64("key"), F.lit(cfg.key_buckets)).cast("int")


def merged_days(spark: SparkSession, cfg: UsageJobConfig, day: DataFrame) -> DataFrame:
    """The new content of every trigger day ``day`` touches (J7/J8 over S4).

    With ``key_buckets`` only the (day, key bucket) partitions the batch
    touches are read, merged and later replaced: a few late rows for an old
    day rewrite a few buckets of it, not the whole day."""
    if not cfg.key_buckets:
        hist = usage_history(spark, cfg.table, _schema(cfg), op.affected_days(day))
        return op.usage_merge(day, hist, cfg.with_project)
    touched = day.select("tmday", key_bucket(cfg).alias("kb")).distinct()
    schema = StructType([*_schema(cfg).fields, StructField("kb", IntegerType())])
    hist = usage_history(spark, cfg.table, schema, touched)
    return op.usage_merge(day, hist, cfg.with_project).withColumn("kb", key_bucket(cfg))


def run(spark: SparkSession, cfg: UsageJobConfig, start: int, end: int,
        reprocess: bool = False, upto: int | None = None,
        journal: Journal | None = None, window: str | None = None) -> dict:
    """Merge the usage of log days ``[start, end]`` into the day table.

    Normal run: condense the window, merge it with the stored rows of the
    trigger days it touches, replace exactly those partitions.
    ``reprocess``: the window's trigger days are rebuilt from every log day
    that feeds them (a trigger day can be fed by several load days) up to the load
    day ``upto`` (default: all), without merging, so a rerun never double counts.
    Rows of other trigger days are dropped before they are condensed.
    The new content of the touched partitions is staged whole before any of them is
    replaced, through ``journal`` (``sources.journal``): the write never re-reads files it is
    replacing, and a run that died between two partitions is finished from the staged
    copy, not merged again with the partitions it had replaced.  Returns the staged record.
    """
    def stage(folder: str) -> dict:
        counted = Observation("usage")
        with RunFolder(spark, "usage") as run_dir:
            log = read_log(spark, cfg.log, start, end, cfg.day_col, cfg.log_schema)
            day = condense(log.observe(counted, *usage_quality(log)), cfg)
            day = run_dir.stage(day, "usage-day")
            if reprocess:
                days = [r[0] for r in op.affected_days(day).collect()]     # calendar days: bounded
                log = spark.read.parquet(cfg.log)
                if upto is not None:
                    log = log.where(F.col(cfg.day_col) <= int(upto))
                rows = op.usage_rows(log, cfg.with_project, cfg.products, cfg.tiebreak, cfg.key_delimiter)
                out = op.condense_usage_rows(rows.where(F.col("tmday").isin(days)), cfg.with_project)
            else:
                out = merged_days(spark, cfg, day)
            if cfg.key_buckets and "kb" not in out.columns:
                out = out.withColumn("kb", key_bucket(cfg))
            out.write.parquet(f"{folder}/partitions")
        return {"partitions": f"{folder}/partitions", "quality": counted.get}

    def apply(staged: dict, again: bool) -> None:
        replace_partitions(spark.read.parquet(staged["partitions"]), cfg.table, partitions(cfg))

    intent, window = {"layout": "partitions", "target": cfg.table}, window or f"{start}-{end}"
    if journal is not None:
        return journal.commit(window, intent, stage, apply)
    own = once(spark, "usage")
    staged = own.commit(window, intent, stage, apply)
    remove(spark, own.root)
    return staged
