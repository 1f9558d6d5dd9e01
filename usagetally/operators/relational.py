"""K9-K11 row preparation, J9 relational update (P15 renames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.functions import keep_unless_missing
from usagetally.operators.merge import keyed_update, new_keys_only
from usagetally.schemas import MISSING, RELATIONAL_DIM_MAP, RELATIONAL_DOUBLE_COLUMNS, RELATIONAL_FACT_MAP


def relational_facts(facts: DataFrame) -> DataFrame:
    """Enriched facts under relational names; durations as double."""
    return facts.select(*[
        (F.col(src).try_cast("double") if dst in RELATIONAL_DOUBLE_COLUMNS else F.col(src)).alias(dst)
        for dst, src in RELATIONAL_FACT_MAP])


def relational_insert_rows(merged: DataFrame, stored: DataFrame) -> DataFrame:
    """K9: new facts (``is_insert = 1``) not yet stored, under relational names
    (``insert ignore``: a stored id is never overwritten)."""
    rows = relational_facts(merged.where(F.col("is_insert") == 1))
    return rows.join(stored.select("id"), "id", "left_anti")


def relational_update_result(stored: DataFrame, merged: DataFrame, duration_mode: str = "add") -> DataFrame:
    """K10 via J9: the stored relational table after updating known facts.

    A stored account is kept unless missing; the duration is set to the
    batch value (``set``) or added to it (``add``); open, close and last
    duration come from the batch.
    """
    if duration_mode not in ("set", "add"):
        raise ValueError("duration_mode must be 'set' or 'add'")
    changes = relational_facts(merged.where(F.col("is_insert") == 0)).select(
        "id", "yun_account_id", "total_long", "first_open_datetime", "last_close_datetime",
        "last_long")
    total = F.col("c.total_long") if duration_mode == "set" else F.col("t.total_long") + F.col("c.total_long")
    rules = {
        "yun_account_id": keep_unless_missing("t.yun_account_id", "c.yun_account_id"),
        "total_long": total,
        "first_open_datetime": F.col("c.first_open_datetime"),
        "last_close_datetime": F.col("c.last_close_datetime"),
        "last_long": F.col("c.last_long"),
    }
    return keyed_update(stored, changes, "id", rules)


def relational_changed_rows(stored: DataFrame, merged: DataFrame, duration_mode: str = "add") -> DataFrame:
    """K10 rows to apply: the post-update values of stored facts that this
    batch changes (and only those), for a set-based update on the database
    side instead of rewriting the whole table."""
    changed_ids = merged.where(F.col("is_insert") == 0).select(F.col("pId").alias("id"))
    updated = relational_update_result(stored, merged, duration_mode)
    return updated.join(changed_ids, "id", "left_semi")


def dim_insert_rows(day_dim: DataFrame, stored_dim: DataFrame) -> DataFrame:
    """New dimension rows under relational names, ``regionrule='N/A'``."""
    fresh = new_keys_only(day_dim, stored_dim.select(F.col("pid").alias("pId")))
    return fresh.select(*[F.col(src).alias(dst) for dst, src in RELATIONAL_DIM_MAP],
                        F.lit(MISSING).alias("regionrule"))
