"""K9, K10 applied to a stored relational copy (a manifest table of the relational columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagetally import operators as op
from usagetally.schemas import RELATIONAL_FACT_SCHEMA
from usagetally.sources import manifest


def apply_update(spark: SparkSession, root: str, merged: DataFrame, window: str, mode: str = "add", buckets: int = 64,
                 insert: bool = False) -> bool:
    """J9 on the stored copy: known facts of a batch (``fact_merge_left``) update their rows; with ``insert``,
    new ones are added (K9).

    Reads and rewrites only the key buckets that these facts fall in.  The window id kept in the manifest
    guards against a replay, which would add durations twice: a window that is applied again does
    nothing and returns False."""
    wanted = merged if insert else merged.where(F.col("is_insert") == 0)
    changes = wanted.withColumn("id", F.col("pId"))

    def updated(batch: DataFrame, stored: DataFrame) -> DataFrame:
        batch = batch.drop("id")
        known = op.relational_update_result(stored, batch, mode)
        return known.unionByName(op.relational_insert_rows(batch, stored)) if insert else known

    return manifest.upsert(spark, root, changes, updated, RELATIONAL_FACT_SCHEMA, ("id",), buckets, window)


__all__ = ["apply_update"]
