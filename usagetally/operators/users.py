"""The user dimension and fact enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.functions import is_present
from usagetally.schemas import MISSING, USER_COLUMNS
from usagetally.session import scratch_path


def distinct_users(users: DataFrame) -> DataFrame:
    """Distinct user rows, ``user_id`` as text."""
    return _as_text_ids(users).distinct()


def _as_text_ids(users: DataFrame) -> DataFrame:
    return users.select("gid", F.col("user_id").cast("string").alias("user_id"),
                        "user_name", "email", "mobile")


def users_by_gid(users: DataFrame) -> DataFrame:
    """A10: one row per gid; each column is its own maximum (may mix people).

    ``max`` ignores duplicates, so the rows are not de-duplicated first
    (A9 would cost a full shuffle for nothing); partial aggregation reduces
    a gid shared by many rows inside each input partition."""
    return _as_text_ids(users).groupBy("gid").agg(*[F.max(c).alias(c) for c in USER_COLUMNS])


def users_by_id(users: DataFrame) -> DataFrame:
    """One row per user id; each column is its own maximum."""
    return _as_text_ids(users).groupBy("user_id").agg(
        *[F.max(c).alias(c) for c in ["user_name", "email", "mobile"]])


def user_lookup(users: DataFrame) -> DataFrame:
    """A10 and A11 as one lookup: ``key`` (a gid or a user id) and the user columns.

    Each user row counts for its gid and for its id; a key's gid values come
    first, its id values fill what is missing, per column.  One aggregation
    with partial maxima, so a gid shared by many rows is reduced before the shuffle."""
    g = [f"'g_{c}', {c}" for c in USER_COLUMNS]
    i = [f"'i_{c}', {c}" for c in USER_COLUMNS]
    none = {p: [f"'{p}_{c}', cast(null as string)" for c in USER_COLUMNS] for p in "gi"}
    struct = lambda key, parts: f"named_struct('key', {key}, {', '.join(parts)})"
    rows = _as_text_ids(users).selectExpr(
        f"inline(array({struct('gid', g + none['i'])}, {struct('user_id', none['g'] + i)}))")
    best = rows.where("key is not null").groupBy("key").agg(
        *[F.coalesce(F.max(f"g_{c}"), F.max(f"i_{c}")).alias(c) for c in USER_COLUMNS])
    return best


def written_lookup(users: DataFrame) -> DataFrame:
    """``user_lookup`` written once to the shared folder and read back.

    A join with a plain scan is one whose hot keys adaptive execution can split;
    over an aggregate in the same plan it can't."""
    lookup = user_lookup(users)
    path = scratch_path(users.sparkSession, "user-lookup")
    lookup.write.parquet(path)
    return users.sparkSession.read.schema(lookup.schema).parquet(path)


def enrich_users(facts: DataFrame, users: DataFrame | None = None, lookup: DataFrame | None = None) -> DataFrame:
    """Add ``user_id user_name email mobile`` to facts.

    A fact's gid is looked up as a gid first and as a user id second, per
    column; what is still missing becomes ``'N/A'``.  The facts are shuffled once,
    against a written ``lookup`` (``written_lookup(users)`` unless given) of one row
    per key, so the join never multiplies rows and a hot gid can be split.  Facts
    without a gid, often the largest single key, are dealt out over many keys
    by a hash of the row and take no user.  Whether the lookup is broadcast
    is left to adaptive execution, which measures its size.
    """
    lookup = written_lookup(users) if lookup is None else lookup
    dealt = F.concat(F.lit("\u0000"), F.xxhash64(*facts.columns).cast("string"))
    keyed = facts.withColumn("_k", F.when(is_present("gid"), F.col("gid")).otherwise(dealt))
    found = lookup.select(F.col("key").alias("_key"), *[F.col(c).alias(f"_u_{c}") for c in USER_COLUMNS])
    joined = keyed.join(found, F.col("_k") == F.col("_key"), "left")
    known = is_present("gid")
    return joined.select(*facts.columns, *[
        F.when(known & (F.col(f"_u_{c}") != ""), F.col(f"_u_{c}")).otherwise(MISSING).alias(c) for c in USER_COLUMNS])
