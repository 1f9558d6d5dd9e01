"""A12/Q5 kept up batch by batch: signed changes of counts instead of a count over all facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagetally.operators.summary import project_summary
from usagetally.schemas import SUMMARY_SCHEMA
from usagetally.sources import manifest

SUMMARY_KEY = ("product_id", "ver", "lock_number")


def add_counts(changes: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Counts summed by group; groups that come to zero go."""
    rows = changes if stored is None else changes.unionByName(stored)
    return (rows.groupBy(*SUMMARY_KEY).agg(F.sum("project_cnt").alias("project_cnt")).where("project_cnt <> 0")
            .select(*SUMMARY_SCHEMA.fieldNames()))


def summary_delta(old: DataFrame, new: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """What replacing the facts ``old`` by ``new`` changes in the summary.

    ``keys``: only facts of these keys can have changed (others of a rewritten bucket cancel out and are
    left aside).  A new fact counts 1; one whose product, version or dongle changed counts -1 and 1."""
    if keys is not None:
        old, new = (side.join(keys, "pId", "left_semi") for side in (old, new))
    less = project_summary(old).withColumn("project_cnt", -F.col("project_cnt"))
    return add_counts(project_summary(new).unionByName(less))


def apply_delta(spark: SparkSession, root: str, delta: DataFrame, buckets: int, window: str) -> bool:
    """Add a written delta to the stored counts, once a window; only the buckets of its groups are read and written."""
    return manifest.upsert(spark, root, delta, add_counts, SUMMARY_SCHEMA, SUMMARY_KEY, buckets, window)


__all__ = ["add_counts", "apply_delta", "summary_delta"]
