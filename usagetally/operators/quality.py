"""Counts of bad values, observed while a job reads its log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagetally.functions import day_from_time
from usagetally.schemas import MISSING, SENTINEL_DAY


def _count(condition: Column, name: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long").alias(name)


def _valid() -> Column:
    """P1 as a condition that is never null."""
    named = ((F.col("projectid") != MISSING) | (F.col("prjname") != MISSING) | (F.col("prjfullpath") != MISSING))
    return F.coalesce(named, F.lit(False))


def fact_quality(log: DataFrame) -> list[Column]:
    """Rows; rows dropped by P1; of the others, durations that are given but aren't numbers (read as 0)."""
    duration = F.col("duration").cast("string")
    given = duration.isNotNull() & (duration != "") & (duration != MISSING)
    return [F.count(F.lit(1)).alias("rows"), _count(~_valid(), "dropped"),
            _count(_valid() & given & duration.try_cast("double").isNull(), "bad_durations")]


def usage_quality(log: DataFrame) -> list[Column]:
    """Rows; rows whose trigger day is the sentinel; of those, rows with a time that isn't a date."""
    time = F.col("trigertime")
    sentinel = day_from_time("trigertime") == SENTINEL_DAY
    given = time.isNotNull() & (time != "") & (time != MISSING)
    return [F.count(F.lit(1)).alias("rows"), _count(sentinel, "sentinel_days"), _count(sentinel & given, "bad_times")]


__all__ = ["fact_quality", "usage_quality"]
