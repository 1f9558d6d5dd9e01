"""K1-K7: Parquet sinks that are safe to rerun.

A table that a job also reads is never overwritten in place: whole-table
replacement writes a new version directory and then switches a small
pointer file (K1); day tables replace only the partitions a batch touches
with dynamic partition overwrite (K6/K7).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from usagetally.sources.files import create_once, read_text, remove
from usagetally.sources.files import file_system as _fs

POINTER_PREFIX = "_CURRENT-"


def _pointers(spark: SparkSession, root: str) -> list[str]:
    fs, _, jvm = _fs(spark, root)
    statuses = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{POINTER_PREFIX}*"))
    return sorted(st.getPath().getName() for st in (statuses or []))


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version directory a versioned table points at, or None.

    Pointers are small files ``_CURRENT-<sequence>`` holding a version name;
    the highest sequence is current.  Each is created once and never
    overwritten, so a reader always sees a complete pointer."""
    for name in reversed(_pointers(spark, root)):
        line = (read_text(spark, f"{root.rstrip('/')}/{name}") or "").strip()
        if line:                       # an empty pointer: its writer died between creating and filling it
            return f"{root.rstrip('/')}/{line}"
    return None


def current_sequence(spark: SparkSession, root: str) -> int:
    """Sequence number of the current pointer (0 before the first publish)."""
    names = _pointers(spark, root)
    return int(names[-1][len(POINTER_PREFIX):]) if names else 0


def read_versioned(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Read the current version of a K1 table (empty on the first run)."""
    cur = current_version(spark, root)
    if cur is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(cur)


def replace_table(df: DataFrame, root: str, batch: str | None = None,
                  partition_by: Sequence[str] = (), base: int | None = None) -> str:
    """K1: publish ``df`` as the new content of a versioned table.

    The data goes to ``<root>/v=<batch>-<uuid>``; only after that write has
    committed is a new pointer created, with the next sequence number
    (create-if-absent).  A job that read the table passes ``base``, the
    ``current_sequence`` it read: the pointer is then exactly ``base + 1``, so of
    two jobs that merged into the same version the second fails instead of losing
    the first one's rows.
    Readers of the old version are undisturbed, a failed run leaves the old
    version current, and a rerun simply publishes again.  Old versions and
    pointers are left for the caller's retention policy.
    """
    name = new_version(batch)
    write_version(df, root, name, partition_by)
    return point_to(df.sparkSession, root, name, base)


def new_version(batch: str | None = None) -> str:
    """A name for a version of a table that no other version has."""
    return f"v={batch or 'x'}-{uuid.uuid4().hex[:12]}"


def write_version(df: DataFrame, root: str, name: str, partition_by: Sequence[str] = ()) -> None:
    """Write a version that no pointer names yet."""
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{root.rstrip('/')}/{name}")


def point_to(spark: SparkSession, root: str, name: str, base: int | None = None) -> str:
    """Make ``name`` the current version (create-once pointer with the next sequence number, exactly ``base + 1``
    if ``base`` is given); nothing is done if a pointer already names it."""
    target = f"{root.rstrip('/')}/{name}"
    if name in {(read_text(spark, f"{root.rstrip('/')}/{n}") or "").strip() for n in _pointers(spark, root)}:
        return target
    latest = current_sequence(spark, root)
    if base is not None and latest != base:
        raise Conflict(f"{root} was published by another job (sequence {latest}, read {base})")
    create_once(spark, f"{root.rstrip('/')}/{POINTER_PREFIX}{latest + 1:012d}", name)
    return target


class Conflict(RuntimeError):
    """Another job has published since this one read the table."""


def stage(df: DataFrame, name: str = "stage", root: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder, read it back.

    Unlike an eager ``checkpoint()``, which computes the last stage twice
    (once to count, once to save), this is one job; the file scan also gives
    adaptive execution real sizes for its join choices.  ``root`` puts the
    copy below a run folder that the job removes when it ends."""
    from usagetally.session import scratch_path
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}" if root else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class RunFolder:
    """A job's private folder below the shared folder, removed on exit.

    ``with RunFolder(spark) as run: day = run.stage(df, "day")`` — staged
    copies live only as long as the job that needs them."""

    def __init__(self, spark: SparkSession, name: str = "run"):
        from usagetally.session import scratch_path
        self.spark = spark
        self.path = scratch_path(spark, name)

    def stage(self, df: DataFrame, name: str = "stage") -> DataFrame:
        return stage(df, name, self.path)

    def __enter__(self) -> "RunFolder":
        return self

    def __exit__(self, *exc) -> None:
        remove(self.spark, self.path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K2/K3/K4/K5: append rows.

    A ``rebalance`` hint lets adaptive execution choose the number of writers by
    size: a small batch leaves few files, a first load of all history uses the
    whole cluster.  With ``partition_by`` the rows are clustered by the partition
    columns, and a value that holds a large share of the rows is split over
    several writers (K5).
    """
    w = df.hint("rebalance", *partition_by).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ("tmday",)) -> None:
    """K6/K7: replace exactly the partitions present in ``df``.

    Dynamic partition overwrite leaves every other partition untouched, so a
    batch that rewrites three days never drops the rest of the table, and a
    rerun of the same batch rewrites the same days.  Rows are clustered by
    the partition columns with a ``rebalance`` hint (few files per day; a
    day holding a large share of the rows is split over several writers).
    """
    (df.hint("rebalance", *partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by)
     .parquet(path))


def replace_bucketed(df: DataFrame, view: str, root: str, buckets: int, key: str = "pId",
                     batch: str | None = None, base: str | None = None) -> str:
    """K1 for a co-located history: a new bucketed table, then a view swap.

    The version is written as an external catalog table at
    ``<root>/v=<batch>-<uuid>``, bucketed and sorted by ``key`` into
    ``buckets`` buckets; then ``view`` is re-pointed at it in one catalog
    operation.  A later merge that joins on ``key`` reads the history already
    partitioned by ``key``, so only the (much smaller) batch side is shuffled.
    Returns the new table name.  A job that read the view passes ``base``, the
    ``viewed_table`` it read: of two jobs that merged into the same table the second
    fails instead of losing the first one's rows.
    """
    table = new_bucketed(df.sparkSession, view)
    write_bucketed(df, table, f"{root.rstrip('/')}/v={batch or 'x'}-{table[-12:]}", buckets, key)
    if base is not None:
        swap_view(df.sparkSession, view, table, base)
    else:
        df.sparkSession.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    return table


def new_bucketed(spark: SparkSession, view: str) -> str:
    """A name for the next table behind ``view``."""
    seq = max([_table_seq(view, t) for t in _version_tables(spark, view)], default=0) + 1
    return f"{view}_v{seq:08d}_{uuid.uuid4().hex[:12]}"


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "pId") -> None:
    """Write an external bucketed table; one task a bucket, hence one file, not tasks x buckets files."""
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))


def viewed_table(spark: SparkSession, view: str) -> str:
    """The table behind ``view``; empty text before the first publish."""
    if not spark.catalog.tableExists(view):
        return ""
    text = [r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {view}").collect() if r[0] == "View Text"]
    return text[0].split()[-1].split(".")[-1].strip("`") if text else ""


def swap_view(spark: SparkSession, view: str, table: str, base: str) -> None:
    """Point ``view`` to ``table`` if it still shows ``base``; nothing is done if it shows ``table``."""
    now = viewed_table(spark, view)
    if now.lower() == table.lower():
        return
    if now.lower() != base.lower():
        raise Conflict(f"{view} was published by another job (shows {now or 'nothing'}, read {base or 'nothing'})")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")


def _version_tables(spark: SparkSession, view: str) -> list[str]:
    prefix = f"{view}_v".lower()
    return [t.name for t in spark.catalog.listTables()
            if t.name.lower().startswith(prefix) and not t.isTemporary and t.tableType != "VIEW"]


def _table_seq(view: str, table: str) -> int:
    digits = table[len(view) + 2:].split("_")[0]
    return int(digits) if digits.isdigit() else 0


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Retention for K1 tables: keep the versions named by the newest
    ``keep`` pointers (the current one and, for readers still on it, the
    previous), delete older version directories and pointers.  Returns the
    removed paths."""
    fs, _, jvm = _fs(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    names = _pointers(spark, root)
    named = {n: (read_text(spark, f"{root.rstrip('/')}/{n}") or "").strip() for n in names}
    removed = []
    # only versions that an older pointer names: a folder without a pointer may be a write in progress
    for version in sorted({named[n] for n in names[:-keep]} - {named[n] for n in names[-keep:]}):
        old = Path(f"{root.rstrip('/')}/{version}")
        if version and fs.delete(old, True):
            removed.append(str(old))
    for n in names[:-keep]:
        fs.delete(Path(f"{root.rstrip('/')}/{n}"), False)
    return removed


def prune_bucketed(spark: SparkSession, view: str, keep: int = 2) -> list[str]:
    """Retention for bucketed versions: drop all but the newest ``keep``
    tables behind ``view`` and delete their files.  Returns the dropped tables."""
    tables = sorted(_version_tables(spark, view), key=lambda t: _table_seq(view, t))
    dropped = []
    for t in tables[:-keep]:
        location = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t}").collect() if r[0] == "Location"]
        spark.sql(f"DROP TABLE {t}")
        if location:
            fs, jpath, _ = _fs(spark, location[0][1])
            if fs.exists(jpath):
                fs.delete(jpath, True)
        dropped.append(t)
    return dropped


def read_bucketed(spark: SparkSession, view: str, schema: StructType) -> DataFrame:
    """The current content behind ``view`` (empty with ``schema`` on the first run)."""
    if spark.catalog.tableExists(view):
        return spark.table(view)
    return spark.createDataFrame([], schema)


def append_bucketed(df: DataFrame, table: str, buckets: int, key: str = "pId",
                    path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """K2-K5 for a co-located table: append rows bucketed by ``key``.

    The first append creates the (external, at ``path``) catalog table; later
    appends add files to the same buckets, so joins of a batch with the table
    on ``key`` never shuffle the table."""
    spark = df.sparkSession
    w = df.repartition(buckets, key).write.mode("append").bucketBy(buckets, key).sortBy(key)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path and not spark.catalog.tableExists(table):
        w = w.option("path", path)
    w.saveAsTable(table)
