"""Reading the usage log and the history tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagetally.session import exists


def window_scan(log: DataFrame, start: int, end: int, day_col: str = "mday") -> DataFrame:
    """Rows of the inclusive day window ``[start, end]``.

    Int literals on the int day column, so the range reaches the Parquet scan
    as pushed filters (and prunes ``mday=`` partitions of a partitioned log)."""
    return log.where(F.col(day_col).between(F.lit(int(start)), F.lit(int(end))))


def calendar_days(start: int, end: int) -> list[int]:
    """The calendar days of the inclusive window, as yyyyMMdd numbers."""
    first, last = (dt.datetime.strptime(str(d), "%Y%m%d").date() for d in (start, end))
    return [int((first + dt.timedelta(days=k)).strftime("%Y%m%d")) for k in range((last - first).days + 1)]


def read_days(spark: SparkSession, path: str, start: int, end: int, schema: StructType, day_col: str = "mday") -> DataFrame:
    """S1 over a log laid out as ``<path>/<day_col>=<yyyyMMdd>/``: the window's folders are named from the calendar.

    No other day's folder is listed, and no footer is read to infer a schema.  A day without a
    folder is empty."""
    top = path.rstrip("/")
    there = [f"{top}/{day_col}={d}" for d in calendar_days(start, end) if exists(spark, f"{top}/{day_col}={d}")]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", top).parquet(*there).select(*schema.fieldNames())


def read_log(spark: SparkSession, path: str, start: int, end: int,
             day_col: str = "mday", schema: StructType | None = None) -> DataFrame:
    """A day window of a stored log; with a declared ``schema``, by its day folders (``read_days``)."""
    if schema is not None and start > 0:
        return read_days(spark, path, start, end, schema, day_col)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return window_scan(reader.parquet(path), start, end, day_col)


def read_or_empty(spark: SparkSession, path: str, schema: StructType,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """A history table, or an empty one with the same schema on
    the first run; ``columns`` prunes the scan."""
    if exists(spark, path):
        df = spark.read.schema(schema).parquet(path)
    else:
        df = spark.createDataFrame([], schema)
    return df.select(*columns) if columns else df


def usage_history(spark: SparkSession, path: str, schema: StructType, parts: DataFrame) -> DataFrame:
    """Usage history limited to the partitions a batch touches.

    ``parts`` holds the batch's partition values: ``tmday``, and ``kb`` with key
    buckets.  Both lists are bounded at any scale (valid calendar days and the
    sentinel day; the number of buckets), so they always become literal lists that
    prune directories at planning time; the exact (day, bucket) pairs are then
    semi-joined."""
    hist = read_or_empty(spark, path, schema)
    for c in parts.columns:
        hist = hist.where(F.col(c).isin([r[0] for r in parts.select(c).distinct().collect()]))
    if len(parts.columns) > 1:
        pairs = parts.distinct().select(*[F.col(c).alias(f"_{c}") for c in parts.columns])
        same = [F.col(c) == F.col(f"_{c}") for c in parts.columns]
        hist = hist.join(pairs, same, "left_semi")
    return hist
