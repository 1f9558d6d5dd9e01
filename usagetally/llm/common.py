"""Shared helpers of the operators: written stages, free column names, hold-out split."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagetally.session import scratch_path

#: The words of the contracts: runs of bytes other than space and \t..\r.
BLANKS = "\\x20\\x09-\\x0D"


def ship(module: str) -> None:
    """Send the functions of ``module`` to executors by value, so that a job needs
    no copy of this library on their Python path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


#: Rows that a Python worker of a written stage gets at a time: whole texts, so ten times fewer than Spark's default.
ROWS_AT_ONCE = "1000"


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage with files that every executor can read, so a lost executor
    costs only its running tasks; a plain scan also lets adaptive execution split
    a skewed join partition, which it can't do over an aggregate in the same plan.
    While it is written, Arrow batches are small: a batch of texts is held several times,
    by the executor and by its Python workers."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path, before = scratch_path(df.sparkSession, name), conf.get(key)
    conf.set(key, ROWS_AT_ONCE)
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy() -> None:
    """Give memory that a task has freed back to the system: a Python worker is kept for the next stage,
    and would keep the largest batch it ever held."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet, whatever extra columns it brings."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def in_sample(key: Column, share: float, seed: int) -> Column:
    """True for about ``share`` of the keys: fixed by the key, alike on every run."""
    if share >= 1:
        return F.lit(True)
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once (a lambda variable)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def batches_of(texts: list, rows: int = 256, chars: int = 1 << 20):
    """Split a list of texts into slices of bounded rows and characters (one text at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and (i - start >= rows or size + n > chars):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
