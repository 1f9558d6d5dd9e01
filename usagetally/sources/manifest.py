"""Tables whose files are named by a manifest: copy-on-write buckets, appends, compaction.

A manifest is a JSON file that names every data file of one state of the table, with
its size and, in a bucketed table, its key bucket; it also lists the batch windows
that the table holds.  Data files are never changed.  A change writes new files, then a
new manifest, then creates the pointer to it, once, under the next sequence number:
of two changes made from one base the second fails (``sinks.Conflict``), readers
go on with the files of the manifest they have read, and a job that dies leaves files
that no manifest names.

* ``upsert`` (K1, J3, J9): a batch reads, merges and rewrites only the buckets that its
  keys fall in; all other buckets keep their files.  The window id in the manifest
  makes a repeated window do nothing.
* ``append`` (K2-K5): new rows become new files; nothing is read.
* ``compact``: small files are packed into files of about a wanted size, bucket by
  bucket, and swapped in while readers and appends go on.
* ``vacuum``: files that only old manifests name are deleted.

A manifest has one entry a file (about 150 bytes), so its size is the number of files,
which compaction bounds by table size / file size; it is read on the driver, as a scan's
file list is.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagetally.sources.files import create_once, data_files, names_in, read_record, read_text, remove
from usagetally.sources.sinks import (
    POINTER_PREFIX,
    Conflict,
    RunFolder,
    current_sequence,
    current_version,
    point_to,
)

#: Size that compaction packs files to, and the share of it below which a file counts as small.
TARGET_BYTES, SMALL = 256 << 20, 0.5
BUCKET = "bucket"


@dataclass
class Manifest:
    """One state of a table.  ``files``: (path below the root, bytes, bucket or None)."""

    sequence: int = 0
    key: tuple[str, ...] = ()
    buckets: int = 0
    files: list[tuple[str, int, int | None]] = field(default_factory=list)
    windows: list[str] = field(default_factory=list)

    def of(self, buckets: Iterable[int] | None = None) -> list[tuple[str, int, int | None]]:
        if buckets is None:
            return self.files
        wanted = set(buckets)
        return [f for f in self.files if f[2] in wanted]


def load(spark: SparkSession, root: str) -> Manifest:
    """The current manifest; an empty one before the first publish."""
    sequence, path = current_sequence(spark, root), current_version(spark, root)
    if path is None:
        return Manifest(sequence)
    found = read_record(spark, path)
    return Manifest(sequence, tuple(found["key"]), found["buckets"], [tuple(f) for f in found["files"]], found["windows"])


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def read(spark: SparkSession, root: str, schema: StructType, buckets: Iterable[int] | None = None,
         manifest: Manifest | None = None) -> DataFrame:
    """The rows of a table, or of some of its buckets: no file of another bucket is opened or listed."""
    files = (manifest or load(spark, root)).of(buckets)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{path}" for path, _, _ in files])


def touched_buckets(rows: DataFrame, key: Sequence[str], buckets: int) -> list[int]:
    """The buckets that the keys of ``rows`` fall in (at most ``buckets`` numbers)."""
    return sorted(r[0] for r in rows.select(bucket_of(key, buckets)).distinct().collect())


def write_files(df: DataFrame, root: str, key: Sequence[str] = (), buckets: int = 0,
                by: Sequence[str] = ()) -> list[tuple[str, int, int | None]]:
    """Write rows as new files that no manifest names yet; bucketed, sorted by key, if ``buckets``.

    A ``rebalance`` hint gives a bucket few files and splits a large one over several.  ``by``
    (unbucketed): rows are clustered and sorted by these columns, so that a reader's filter on them
    skips files and row groups; explicit file lists carry no partition folders."""
    folder = f"data/{uuid.uuid4().hex}"
    target = f"{root.rstrip('/')}/{folder}"
    if buckets:
        dealt = df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
        dealt.sortWithinPartitions(BUCKET, *key).write.partitionBy(BUCKET).parquet(target)
    else:
        dealt = df.hint("rebalance", *by)
        (dealt.sortWithinPartitions(*by) if by else dealt).write.parquet(target)
    return [(f"{folder}/{name}", size, int(name.split("/")[0].split("=")[1]) if buckets else None)
            for name, size in data_files(df.sparkSession, target)]


def publish(spark: SparkSession, root: str, manifest: Manifest) -> Manifest:
    """Make a manifest made from state ``manifest.sequence`` the next state; ``Conflict`` if there is a later one."""
    name = f"manifests/{uuid.uuid4().hex}.json"
    create_once(spark, f"{root.rstrip('/')}/{name}", json.dumps(
        {k: v for k, v in asdict(manifest).items() if k != "sequence"}))
    point_to(spark, root, name, manifest.sequence)
    manifest.sequence += 1
    return manifest


# ---- bucketed tables: copy on write

def prepare_upsert(spark: SparkSession, root: str, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
                   schema: StructType, key: Sequence[str], buckets: int, every_bucket: bool = False) -> dict:
    """Write the new files of the buckets that ``batch`` (a written table) touches; nothing is published.

    ``merge(batch, stored)`` gives the whole new content of those buckets from their stored rows.
    Returns a JSON record for ``publish_upsert``."""
    now = load(spark, root)
    if now.files and (now.key, now.buckets) != (tuple(key), buckets):
        raise ValueError(f"{root} is bucketed by {now.key} into {now.buckets}")
    touched = list(range(buckets)) if every_bucket else touched_buckets(batch, key, buckets)
    stored = read(spark, root, schema, touched, now)
    files = write_files(merge(batch, stored).select(*schema.fieldNames()), root, key, buckets)
    return {"base": now.sequence, "key": list(key), "buckets": buckets, "touched": touched, "files": files}


def publish_upsert(spark: SparkSession, root: str, change: dict, window: str | None = None) -> bool:
    """Swap in the files of a prepared upsert; False (and nothing done) if the table already holds ``window``."""
    now = load(spark, root)
    if window is not None and window in now.windows:
        return False
    if now.sequence != change["base"]:
        raise Conflict(f"{root} was published by another job (sequence {now.sequence}, read {change['base']})")
    gone = set(change["touched"])
    kept = [f for f in now.files if f[2] not in gone]
    publish(spark, root, Manifest(now.sequence, tuple(change["key"]), change["buckets"],
                                  kept + [tuple(f) for f in change["files"]], now.windows + ([window] if window else [])))
    return True


def upsert(spark: SparkSession, root: str, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
           schema: StructType, key: Sequence[str], buckets: int, window: str | None = None,
           every_bucket: bool = False) -> bool:
    """Merge ``rows`` into the buckets their keys fall in; False if the table already holds ``window``."""
    if window is not None and window in load(spark, root).windows:
        return False
    with RunFolder(spark, "upsert") as run:
        batch = run.stage(rows, "batch")
        return publish_upsert(spark, root, prepare_upsert(spark, root, batch, merge, schema, key, buckets, every_bucket), window)


def matching(spark: SparkSession, root: str, schema: StructType, batch: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """The stored rows that a written ``batch`` could meet: of the buckets its keys fall in and, as files are
    sorted by key, only row groups within the range of its keys (J5, J6, S2, S5)."""
    now = load(spark, root)
    stored = read(spark, root, schema, touched_buckets(batch, key, buckets), now)
    low, high = batch.agg(F.min(key[0]), F.max(key[0])).first()
    return stored.where(F.col(key[0]).between(F.lit(low), F.lit(high))) if low is not None else stored.limit(0)


# ---- appends

def append(spark: SparkSession, root: str, rows: DataFrame, window: str | None = None, key: Sequence[str] = (),
           buckets: int = 0, by: Sequence[str] = (), tries: int = 5) -> bool:
    """Add rows as new files; appends don't conflict with each other or with compaction, so a lost race is tried again."""
    if window is not None and window in load(spark, root).windows:
        return False
    files = write_files(rows, root, key, buckets, by)
    for _ in range(tries):
        now = load(spark, root)
        if window is not None and window in now.windows:
            return False
        try:
            publish(spark, root, Manifest(now.sequence, tuple(key), buckets, now.files + files,
                                          now.windows + ([window] if window else [])))
            return True
        except Exception as e:      # a pointer made in between: a Conflict, or the file system's own refusal
            if current_sequence(spark, root) == now.sequence:
                raise e
    raise Conflict(f"{root}: {tries} publishes were overtaken")


# ---- compaction and retention

def packed(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """First-fit decreasing: bins of files of at most ``target`` bytes together (a larger file has its own)."""
    bins: list[tuple[int, list[str]]] = []
    for path, size in sorted(sizes, key=lambda f: (-f[1], f[0])):
        for k, (filled, names) in enumerate(bins):
            if filled + size <= target:
                bins[k] = (filled + size, names + [path])
                break
        else:
            bins.append((size, [path]))
    return [names for _, names in bins]


def plan_compaction(manifest: Manifest, target: int = TARGET_BYTES, small: float = SMALL) -> list[tuple[int | None, list[str]]]:
    """(bucket, files) of the bins that hold several small files."""
    groups: dict[int | None, list[tuple[str, int]]] = defaultdict(list)
    for path, size, bucket in manifest.files:
        if size < small * target:
            groups[bucket].append((path, size))
    return [(bucket, names) for bucket, sizes in groups.items() for names in packed(sizes, target) if len(names) > 1]


def compact(spark: SparkSession, root: str, schema: StructType, target: int = TARGET_BYTES, small: float = SMALL,
            tries: int = 5) -> int:
    """Rewrite small files into files of about ``target`` bytes, one task a bin; returns how many files went.

    Rows appended meanwhile stay: the swap takes the then current manifest.  If one of the rewritten
    files has gone from it (an upsert of its bucket), nothing is swapped and ``Conflict`` is raised."""
    before = load(spark, root)
    bins = plan_compaction(before, target, small)
    if not bins:
        return 0
    top = root.rstrip("/")
    place = {f: k for k, (_, names) in enumerate(bins) for f in names}
    numbers = spark.createDataFrame([(f, k) for f, k in place.items()], "file string, bin int")
    # a row's file, as the manifest names it, picks its bin: a lookup as large as the list of small files
    name = F.regexp_extract(F.col("_metadata.file_path"), r"(data/[0-9a-f]{32}/.*)$", 1)
    rows = spark.read.schema(schema).parquet(*[f"{top}/{f}" for f in place]).select("*", name.alias("__file"))
    folder = f"data/{uuid.uuid4().hex}"
    dealt = rows.join(numbers, F.url_decode(F.col("__file")) == F.col("file")).drop("__file", "file")
    dealt = dealt.repartition(len(bins), "bin")
    ordered = dealt.sortWithinPartitions("bin", *before.key) if before.key else dealt
    ordered.write.partitionBy("bin").parquet(f"{top}/{folder}")
    fresh = [(f"{folder}/{f}", size, bins[int(f.split("/")[0].split("=")[1])][0]) for f, size in data_files(spark, f"{top}/{folder}")]
    for _ in range(tries):
        now = load(spark, root)
        if not set(place) <= {f for f, _, _ in now.files}:
            raise Conflict(f"{root}: files were replaced while they were compacted")
        try:
            publish(spark, root, Manifest(now.sequence, now.key, now.buckets,
                                          [f for f in now.files if f[0] not in place] + fresh, now.windows))
            return len(place)
        except Exception as e:
            if current_sequence(spark, root) == now.sequence:
                raise e
    raise Conflict(f"{root}: {tries} publishes were overtaken")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the files that older manifests than the newest ``keep`` name and those don't; returns their paths.

    Files that no manifest has ever named may be a write in progress and stay."""
    top = root.rstrip("/")
    pointers = sorted(n for n in names_in(spark, top) if n.startswith(POINTER_PREFIX))
    named: dict[str, set[str]] = {}
    bodies: dict[str, str] = {}
    for p in pointers:
        body = (read_text(spark, f"{top}/{p}") or "").strip()
        found = read_record(spark, f"{top}/{body}") if body else None
        bodies[p], named[p] = body, {f[0] for f in found["files"]} if found else set()
    kept = set().union(*[named[p] for p in pointers[-keep:]]) if pointers else set()
    gone = sorted(set().union(*[named[p] for p in pointers[:-keep]]) - kept) if pointers[:-keep] else []
    for f in gone:
        remove(spark, f"{top}/{f}")
    for p in pointers[:-keep]:
        remove(spark, f"{top}/{p}")
        if bodies[p]:
            remove(spark, f"{top}/{bodies[p]}")
    return gone


__all__ = ["Manifest", "load", "read", "upsert", "prepare_upsert", "publish_upsert", "append", "compact", "vacuum", "packed",
           "matching", "plan_compaction", "publish", "touched_buckets", "bucket_of"]
