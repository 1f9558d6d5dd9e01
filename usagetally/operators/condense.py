"""Condense many log rows into one row per key.

Every rule is an aggregate with a total row order, so results never depend
on how rows arrive.  Spark plans them as partial (map-side) + final
aggregation, so a key holding a large share of all rows is reduced inside
each input partition before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagetally.functions import clean_trigger_time, day_from_time, number_text, strip_backslashes
from usagetally.functions.keys import hash_key
from usagetally.operators.clean import fact_rows, missing_of, order_key, product_filter
from usagetally.schemas import (
    FACT_ATTRIBUTES,
    MISSING,
    MISSING_NUMBER,
    PROJECT_USAGE_KEY,
    USAGE_PRODUCTS,
    USER_USAGE_KEY,
)


def latest_present(c: str, ord_col: str = "_ord", missing: str = MISSING) -> Column:
    """A4: the value with the greatest order among rows where it is not
    ``missing``; ``missing`` when there is none."""
    return F.expr(f"coalesce(max_by(`{c}`, case when `{c}` <> '{missing}' then `{ord_col}` end), '{missing}')")


def fact_missing_map(numeric_text_defaults: bool = True) -> dict[str, str]:
    m = {c: MISSING for c in FACT_ATTRIBUTES}
    m["duration"] = MISSING_NUMBER
    if numeric_text_defaults:
        m["prjcost"] = MISSING_NUMBER
        m["prjsize"] = MISSING_NUMBER
    return m


def condense_fact_rows(rows: DataFrame, numeric_text_defaults: bool = True) -> DataFrame:
    """A1-A5 over keyed rows (``pId``, 13 columns, ``_ord``) → 18-column facts."""
    missing = fact_missing_map(numeric_text_defaults)
    return rows.groupBy("pId").agg(
        *[latest_present(c, missing=missing[c]).alias(c) for c in FACT_ATTRIBUTES],
        F.max("receivetime").alias("receivetime"),
        F.min("receivetime").alias("first_open_datetime"),
        F.max("receivetime").alias("last_close_datetime"),
        F.coalesce(F.sum(F.col("duration").try_cast("double")), F.lit(0.0))
         .cast("string").alias("total_duration"),
        latest_present("duration", missing=MISSING_NUMBER).alias("last_long"),
    ).select("pId", *FACT_ATTRIBUTES, "receivetime", "first_open_datetime",
             "last_close_datetime", "total_duration", "last_long")


def fact_condense(log: DataFrame, numeric_text_defaults: bool = True, slash_rule: bool = True,
                  tiebreak: str | None = "seq", key_delimiter: str = "") -> DataFrame:
    """A1: one fact per project key from a window of the log."""
    rows = fact_rows(log, numeric_text_defaults, slash_rule, tiebreak, key_delimiter)
    return condense_fact_rows(rows, numeric_text_defaults)


def dim_condense(facts: DataFrame, key_delimiter: str = "") -> DataFrame:
    """Project dimension rows keyed by ``md5(projectid‖prjname)``.

    The key is hashed before backslashes are stripped from the name (F3).
    Of several facts per key the one with the latest ``receivetime`` (then
    the greatest fact key) is kept, whole.
    """
    attrs = ["projectid", "prjname", "prjfullpath", "prjcost", "prjsize", "major",
             "duration", "utype"]
    keyed = facts.select(
        hash_key("projectid", "prjname", delimiter=key_delimiter).alias("pId"),
        *[strip_backslashes("prjname").alias(c) if c == "prjname" else F.col(c) for c in attrs],
        F.concat(F.col("receivetime"), F.lit("#"), F.col("pId")).alias("_ord"),
    )
    kept = keyed.groupBy("pId").agg(F.max_by(F.struct(*attrs), F.col("_ord")).alias("_v"))
    return kept.select("pId", *[F.col("_v")[c].alias(c) for c in attrs])


def usage_rows(log: DataFrame, with_project: bool = True, products=USAGE_PRODUCTS,
               tiebreak: str | None = "seq", key_delimiter: str = "") -> DataFrame:
    """Keyed feature-usage rows."""
    cols = ["pcode", "projectid", "prjname", "dognum", "gid", "hardwareid", "fnname"]
    if not with_project:
        cols = [c for c in cols if c not in ("projectid", "prjname")]
    extra = [tiebreak] if tiebreak is not None and tiebreak in log.columns else []
    tb = extra[0] if extra else None
    # P3 on the raw codes, then P2 + P5 (NULL only; '' stays) in one projection, as text
    base = product_filter(log, products).selectExpr(
        *[f"coalesce(cast(`{c}` as string), '{missing_of(log, c)}') as `{c}`" for c in cols],
        "fncode", "trigertime", *[f"`{c}`" for c in extra])
    base = base.select(
        *cols,
        number_text("fncode").alias("fncode"),
        clean_trigger_time("trigertime").alias("trigertime"),
        day_from_time("trigertime").alias("tmday"),
        *extra,
    )
    key_cols = PROJECT_USAGE_KEY if with_project else USER_USAGE_KEY
    return base.select(
        hash_key(*key_cols, delimiter=key_delimiter).alias("key"),
        *key_cols,
        *[c for c in ("prjname", "fnname") if c in cols],
        "trigertime",
        order_key("trigertime", tb, [*key_cols, *[c for c in ("prjname", "fnname") if c in cols]]).alias("_ord"),
    )


def condense_usage_rows(rows: DataFrame, with_project: bool = True) -> DataFrame:
    """Per key, the count, the latest present names and the latest time."""
    key_cols = PROJECT_USAGE_KEY if with_project else USER_USAGE_KEY
    names = ["prjname", "fnname"] if with_project else ["fnname"]
    agg = rows.groupBy("key").agg(
        F.max_by(F.struct(*key_cols), F.col("_ord")).alias("_k"),
        *[latest_present(c).alias(c) for c in names],
        F.count(F.lit(1)).cast("int").alias("count"),
        F.max("trigertime").alias("trigertime"),
    )
    out = ["key", "tmday", "pcode"] + (["projectid", "prjname"] if with_project else []) + [
        "dognum", "gid", "hardwareid", "fncode", "fnname", "count", "trigertime"]
    return agg.select(*[F.col("_k")[c].alias(c) if c in key_cols else F.col(c) for c in out])


def usage_condense(log: DataFrame, products=USAGE_PRODUCTS, tiebreak: str | None = "seq",
                   key_delimiter: str = "") -> DataFrame:
    """Project feature usage per trigger day."""
    return condense_usage_rows(usage_rows(log, True, products, tiebreak, key_delimiter), True)


def user_usage_condense(log: DataFrame, products=USAGE_PRODUCTS, tiebreak: str | None = "seq",
                        key_delimiter: str = "") -> DataFrame:
    """User feature usage per trigger day."""
    return condense_usage_rows(usage_rows(log, False, products, tiebreak, key_delimiter), False)


def affected_days(usage: DataFrame) -> DataFrame:
    """The trigger days a batch of usage rows touches."""
    return usage.select("tmday").distinct()
