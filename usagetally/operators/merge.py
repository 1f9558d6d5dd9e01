"""Merging a batch with history, keyed updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagetally.operators.clean import with_dongle
from usagetally.schemas import (
    ENRICHED_FACT_COLUMNS,
    FACT_COLUMNS,
    MISSING,
    PROJECT_USAGE_COLUMNS,
    SENTINEL_DAY,
    USER_COLUMNS,
    USER_USAGE_COLUMNS,
)


def _sides(day: DataFrame, hist: DataFrame, key: str, columns: Sequence[str], how: str):
    d = day.selectExpr(*[f"`{c}` as `d_{c}`" for c in columns])
    a = hist.selectExpr(*[f"`{c}` as `a_{c}`" for c in columns])
    return d.join(a, F.col("d_" + key) == F.col("a_" + key), how)


def fact_merge_full(day: DataFrame, hist: DataFrame, with_insert_flag: bool = False) -> DataFrame:
    """J3 (+P11, P12): FULL merge of today's enriched facts with history.

    Both sides → today's attributes, earliest open, latest close, summed
    duration, and today's user columns unless missing.  One side → that side.
    """
    cols = ENRICHED_FACT_COLUMNS
    j = _sides(day, hist, "pId", cols, "full")
    both = "d_pId is not null and a_pId is not null"
    out = []
    for c in cols:
        side = f"case when d_pId is not null then `d_{c}` else `a_{c}` end"
        if c == "first_open_datetime":
            v = f"case when {both} then least(a_{c}, d_{c}) else {side} end"
        elif c == "last_close_datetime":
            v = f"case when {both} then greatest(a_{c}, d_{c}) else {side} end"
        elif c == "total_duration":
            v = (f"case when {both} then cast(coalesce(try_cast(a_{c} as double), 0D) + "
                 f"coalesce(try_cast(d_{c} as double), 0D) as string) else {side} end")
        elif c in USER_COLUMNS:
            v = f"case when {both} then (case when d_{c} = '{MISSING}' then a_{c} else d_{c} end) else {side} end"
        else:
            v = side
        if c == "gid":   # P12: an un-salted missing gid
            v = f"case when startswith({v}, '{MISSING}') then '{MISSING}' else {v} end"
        out.append(f"{v} as `{c}`")
    if with_insert_flag:
        out.append("case when a_pId is not null then 0 else 1 end as is_insert")
    return j.selectExpr(*out)


def fact_merge_left(day: DataFrame, hist: DataFrame) -> DataFrame:
    """J4 (+P11): only today's keys; open/close times widened by history.

    Output: the 22 enriched columns and ``is_insert``."""
    h = hist.selectExpr("pId as a_pId", "first_open_datetime as a_first", "last_close_datetime as a_last")
    j = day.join(h, day["pId"] == h["a_pId"], "left")
    out = []
    for c in ENRICHED_FACT_COLUMNS:
        if c == "first_open_datetime":
            v = (f"case when a_pId is not null and a_first <> '{MISSING}' and a_first < `{c}` "
                 f"then a_first else `{c}` end")
        elif c == "last_close_datetime":
            v = (f"case when a_pId is not null and a_last <> '{MISSING}' and a_last > `{c}` "
                 f"then a_last else `{c}` end")
        elif c == "gid":   # P12
            v = f"case when startswith(gid, '{MISSING}') then '{MISSING}' else gid end"
        else:
            v = f"`{c}`"
        out.append(f"{v} as `{c}`")
    out.append("case when a_pId is not null then 0 else 1 end as is_insert")
    return j.selectExpr(*out)


def insert_flag(day: DataFrame, hist: DataFrame) -> DataFrame:
    """``is_insert`` per fact key of the full merge (1 = new key)."""
    d = day.select(F.col("pId").alias("d_pId"))
    a = hist.select(F.col("pId").alias("a_pId"))
    j = d.join(a, F.col("d_pId") == F.col("a_pId"), "full")
    return j.select(F.coalesce("d_pId", "a_pId").alias("pId"),
                    F.when(F.col("a_pId").isNotNull(), 0).otherwise(1).alias("is_insert"))


def fact_new_only(day: DataFrame, hist: DataFrame) -> DataFrame:
    """J5 + P14: facts whose key is not in history and that have a dongle."""
    fresh = with_dongle(day.where(F.col("pId").isNotNull()))
    return fresh.join(hist.select("pId"), "pId", "left_anti").select(*FACT_COLUMNS)


def new_keys_only(day: DataFrame, existing: DataFrame, key: str = "pId") -> DataFrame:
    """Rows of ``day`` whose key is not yet in ``existing``."""
    return day.where(F.col(key).isNotNull()).join(existing.select(key), key, "left_anti")


def usage_merge(day: DataFrame, hist: DataFrame, with_project: bool = True) -> DataFrame:
    """FULL merge of a day's usage with the history of the same days.

    Both sides → attributes of the later trigger time (ties to today), counts
    summed.  One side → that side.  A missing trigger day is the sentinel.
    """
    cols = PROJECT_USAGE_COLUMNS if with_project else USER_USAGE_COLUMNS
    j = _sides(day, hist.withColumn("tmday", F.col("tmday").cast("string")), "key", cols, "full")
    hist_wins = ("((d_key is not null and a_key is not null and d_trigertime < a_trigertime) "
                 "or d_key is null)")
    out = []
    for c in cols:
        if c == "count":
            v = ("cast(case when d_key is not null and a_key is not null then d_count + a_count "
                 "else coalesce(d_count, a_count) end as int)")
        elif c == "key":
            v = "coalesce(d_key, a_key)"
        else:
            v = f"case when {hist_wins} then a_{c} else d_{c} end"
        if c == "tmday":
            v = f"coalesce({v}, '{SENTINEL_DAY}')"
        out.append(f"{v} as `{c}`")
    return j.selectExpr(*out)


def keyed_update(target: DataFrame, changes: DataFrame, key: str,
                 rules: dict[str, Column]) -> DataFrame:
    """``target`` after applying ``changes`` by key.

    ``rules`` maps a target column to an expression over ``t.<col>`` (the
    stored value) and ``c.<col>`` (the change); it applies only where a change
    exists.  Rows without a change are unchanged.
    """
    t = target.alias("t")
    c = changes.alias("c")
    j = t.join(c, F.col(f"t.{key}") == F.col(f"c.{key}"), "left")
    hit = F.col(f"c.{key}").isNotNull()
    return j.select(*[
        (F.when(hit, rules[col]).otherwise(F.col(f"t.{col}")) if col in rules else F.col(f"t.{col}"))
        .alias(col) for col in target.columns])
