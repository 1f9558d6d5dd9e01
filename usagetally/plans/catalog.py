"""The registered queries: every operator and pipeline over the driver's tables.

Each query reads ``events`` / ``customer`` from ``sf_dir`` whole, derives
the usage log and user dimension (``sources.fixtures``), splits the log into
a history window and a day window, and runs one operator or pipeline.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagetally import operators as op
from usagetally.functions import name_from_path, time_to_millis
from usagetally.operators.clean import FACT_LOG_COLUMNS, fill_missing, numeric_defaults
from usagetally.plans import window as win
from usagetally.schemas import MISSING, TIME_FORMAT, USAGE_PRODUCTS
from usagetally.sources.fixtures import (
    DAY_WINDOW,
    FIXTURE_TODAY,
    HISTORY_WINDOW,
    load_userlog,
    load_userlog_window,
    load_users,
)
from usagetally.sources.log import window_scan

Query = Callable[[SparkSession, str], DataFrame]


def day_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_userlog_window(spark, sf_dir, *DAY_WINDOW)


def history_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_userlog_window(spark, sf_dir, *HISTORY_WINDOW)


def day_facts(spark, sf_dir, numeric_text_defaults=True):
    return op.fact_condense(day_log(spark, sf_dir), numeric_text_defaults)


def whole_facts(spark, sf_dir):
    """Facts of the whole log: single operators are run over all of it; merges split it in two."""
    return op.fact_condense(load_userlog(spark, sf_dir))


def history_facts(spark, sf_dir, numeric_text_defaults=True):
    return op.fact_condense(history_log(spark, sf_dir), numeric_text_defaults)


def user_lookup(spark, sf_dir):
    return op.written_lookup(load_users(spark, sf_dir))


def day_enriched(spark, sf_dir, lookup):
    return op.enrich_users(day_facts(spark, sf_dir), lookup=lookup)


def history_enriched(spark, sf_dir, lookup):
    return op.enrich_users(history_facts(spark, sf_dir), lookup=lookup)


# --- sources, filters, scalar rules ------------------------------------------

def q_window_scan(spark, sf_dir):
    return window_scan(load_userlog(spark, sf_dir), *DAY_WINDOW)


def q_valid_actions(spark, sf_dir):
    return op.valid_actions(load_userlog(spark, sf_dir))


def q_product_filter(spark, sf_dir):
    return op.product_filter(load_userlog(spark, sf_dir), USAGE_PRODUCTS)


def q_fill_missing(spark, sf_dir):
    rows = op.valid_actions(load_userlog(spark, sf_dir)).select("seq", *FACT_LOG_COLUMNS)
    return numeric_defaults(fill_missing(rows, FACT_LOG_COLUMNS))


def q_project_name(spark, sf_dir):
    rows = fill_missing(op.valid_actions(load_userlog(spark, sf_dir)).select("seq", "prjname", "prjfullpath"),
                        ["prjname", "prjfullpath"])
    derived = F.when((F.col("prjname") == MISSING) & (F.col("prjfullpath") != MISSING),
                     name_from_path("prjfullpath")).otherwise(F.col("prjname"))
    return rows.select("seq", "prjfullpath", derived.alias("name"))


def q_project_key(spark, sf_dir):
    return op.fact_rows(load_userlog(spark, sf_dir), keep=("seq",)).select("seq", "pId")


def q_trigger_day(spark, sf_dir):
    from usagetally.functions import clean_trigger_time, day_from_time
    return load_userlog(spark, sf_dir).select(
        "seq", clean_trigger_time("trigertime").alias("trigertime"),
        day_from_time("trigertime").alias("tmday"))


def q_time_millis(spark, sf_dir):
    return load_userlog(spark, sf_dir).select("seq", time_to_millis("trigertime", TIME_FORMAT).alias("millis"))


# --- facts -------------------------------------------------------------------

def q_fact_condense(spark, sf_dir):
    return whole_facts(spark, sf_dir)


def q_fact_condense_backslash_names(spark, sf_dir):
    return op.fact_condense(load_userlog(spark, sf_dir), slash_rule=False)


def q_fact_condense_products(spark, sf_dir):
    """Facts of the listed products alone."""
    return op.fact_condense(op.product_filter(load_userlog(spark, sf_dir), USAGE_PRODUCTS))


def q_fact_condense_int_pcode(spark, sf_dir):
    """A log whose product code is a number: the same facts."""
    return op.fact_condense(load_userlog(spark, sf_dir).withColumn("pcode", F.col("pcode").cast("int")))


def q_distinct_users(spark, sf_dir):
    from usagetally.operators.users import distinct_users
    return distinct_users(load_users(spark, sf_dir))


def q_users_by_gid(spark, sf_dir):
    return op.users_by_gid(load_users(spark, sf_dir))


def q_users_by_id(spark, sf_dir):
    return op.users_by_id(load_users(spark, sf_dir))


def q_enrich_users(spark, sf_dir):
    return op.enrich_users(whole_facts(spark, sf_dir), load_users(spark, sf_dir))


def q_fact_merge_full(spark, sf_dir):
    lookup = user_lookup(spark, sf_dir)
    return op.fact_merge_full(day_enriched(spark, sf_dir, lookup), history_enriched(spark, sf_dir, lookup))


def q_fact_merge_left(spark, sf_dir):
    lookup = user_lookup(spark, sf_dir)
    return op.fact_merge_left(day_enriched(spark, sf_dir, lookup), history_enriched(spark, sf_dir, lookup))


def q_insert_flag(spark, sf_dir):
    return op.insert_flag(day_facts(spark, sf_dir), history_facts(spark, sf_dir))


def q_fact_new_only(spark, sf_dir):
    return op.fact_new_only(day_facts(spark, sf_dir, False), history_facts(spark, sf_dir, False))


def q_dim_condense(spark, sf_dir):
    return op.dim_condense(whole_facts(spark, sf_dir))


def q_dim_new_only(spark, sf_dir):
    return op.new_keys_only(op.dim_condense(day_facts(spark, sf_dir)),
                            op.dim_condense(history_facts(spark, sf_dir)))


def q_project_summary(spark, sf_dir):
    return op.project_summary(q_fact_merge_full(spark, sf_dir))


def q_project_summary_filtered(spark, sf_dir):
    return op.project_summary(q_fact_merge_full(spark, sf_dir), named_only=True)


# --- feature usage -------------------------------------------------------------

def _usage_merge(spark, sf_dir, with_project):
    """The day's usage merged with the history of the trigger days that it touches.  History rows of
    other days are dropped before they are condensed; days are a literal list, as in the job (S4)."""
    rows = op.usage_rows(day_log(spark, sf_dir), with_project)
    days = [r[0] for r in op.affected_days(rows).collect()]        # calendar days: bounded
    hist = op.usage_rows(history_log(spark, sf_dir), with_project).where(F.col("tmday").isin(days))
    return op.usage_merge(op.condense_usage_rows(rows, with_project), op.condense_usage_rows(hist, with_project), with_project)


def q_usage_condense(spark, sf_dir):
    return op.usage_condense(load_userlog(spark, sf_dir))


def q_usage_condense_no_row_id(spark, sf_dir):
    """A log without a row id: keys, counts and latest times don't depend on how ties are broken."""
    usage = op.usage_condense(load_userlog(spark, sf_dir).drop("seq"), tiebreak=None)
    return usage.select("key", "tmday", "pcode", "projectid", "dognum", "gid", "hardwareid", "fncode", "count", "trigertime")


def q_usage_merge(spark, sf_dir):
    return _usage_merge(spark, sf_dir, True)


def q_user_usage_condense(spark, sf_dir):
    return op.user_usage_condense(load_userlog(spark, sf_dir))


def q_user_usage_merge(spark, sf_dir):
    return _usage_merge(spark, sf_dir, False)


def q_affected_days(spark, sf_dir):
    return op.affected_days(op.usage_condense(load_userlog(spark, sf_dir)))


# --- relational copies ---------------------------------------------------------

def q_relational_insert_rows(spark, sf_dir):
    lookup = user_lookup(spark, sf_dir)
    merged = op.fact_merge_left(day_enriched(spark, sf_dir, lookup), history_enriched(spark, sf_dir, lookup))
    stored = op.relational_facts(history_enriched(spark, sf_dir, lookup))
    return op.relational_insert_rows(merged, stored)


def q_relational_update_result(spark, sf_dir, mode="add"):
    lookup = user_lookup(spark, sf_dir)
    merged = op.fact_merge_left(day_enriched(spark, sf_dir, lookup), history_enriched(spark, sf_dir, lookup))
    stored = op.relational_facts(history_enriched(spark, sf_dir, lookup))
    return op.relational_update_result(stored, merged, mode)


def q_relational_changed_rows(spark, sf_dir):
    lookup = user_lookup(spark, sf_dir)
    merged = op.fact_merge_left(day_enriched(spark, sf_dir, lookup), history_enriched(spark, sf_dir, lookup))
    stored = op.relational_facts(history_enriched(spark, sf_dir, lookup))
    return op.relational_changed_rows(stored, merged, "add")


def q_relational_update_result_set(spark, sf_dir):
    return q_relational_update_result(spark, sf_dir, "set")


def q_dim_insert_rows(spark, sf_dir):
    from usagetally.operators.relational import RELATIONAL_DIM_MAP
    stored = op.dim_condense(history_facts(spark, sf_dir)).select(
        *[F.col(src).alias(dst) for dst, src in RELATIONAL_DIM_MAP])
    return op.dim_insert_rows(op.dim_condense(day_facts(spark, sf_dir)), stored)


# --- batch control ---------------------------------------------------------------

def q_next_window(spark, sf_dir):
    state = win.state_from_log(history_log(spark, sf_dir))
    import datetime as dt
    return win.next_window(state, today=dt.date.fromisoformat(FIXTURE_TODAY))


def q_next_window_two_jobs(spark, sf_dir):
    """Two jobs in one state table, one of them a window behind; each gets its own next window."""
    import datetime as dt
    state = win.state_from_log(history_log(spark, sf_dir), "late").unionByName(
        win.state_from_log(load_userlog_window(spark, sf_dir, HISTORY_WINDOW[0], DAY_WINDOW[0]), "early"))
    today = dt.date.fromisoformat(FIXTURE_TODAY)
    late, early = (win.next_window(state, today=today, job=j).withColumn("job", F.lit(j)) for j in ("late", "early"))
    return late.unionByName(early)


QUERIES: dict[str, Query] = {
    "window_scan": q_window_scan,
    "valid_actions": q_valid_actions,
    "product_filter": q_product_filter,
    "fill_missing": q_fill_missing,
    "project_name": q_project_name,
    "project_key": q_project_key,
    "trigger_day": q_trigger_day,
    "time_millis": q_time_millis,
    "fact_condense": q_fact_condense,
    "fact_condense_backslash_names": q_fact_condense_backslash_names,
    "fact_condense_products": q_fact_condense_products,
    "fact_condense_int_pcode": q_fact_condense_int_pcode,
    "distinct_users": q_distinct_users,
    "users_by_gid": q_users_by_gid,
    "users_by_id": q_users_by_id,
    "enrich_users": q_enrich_users,
    "fact_merge_full": q_fact_merge_full,
    "fact_merge_left": q_fact_merge_left,
    "insert_flag": q_insert_flag,
    "fact_new_only": q_fact_new_only,
    "dim_condense": q_dim_condense,
    "dim_new_only": q_dim_new_only,
    "project_summary": q_project_summary,
    "project_summary_filtered": q_project_summary_filtered,
    "usage_condense": q_usage_condense,
    "usage_condense_no_row_id": q_usage_condense_no_row_id,
    "usage_merge": q_usage_merge,
    "user_usage_condense": q_user_usage_condense,
    "user_usage_merge": q_user_usage_merge,
    "affected_days": q_affected_days,
    "relational_insert_rows": q_relational_insert_rows,
    "relational_update_result": q_relational_update_result,
    "relational_update_result_set": q_relational_update_result_set,
    "relational_changed_rows": q_relational_changed_rows,
    "dim_insert_rows": q_dim_insert_rows,
    "next_window": q_next_window,
    "next_window_two_jobs": q_next_window_two_jobs,
}

def _with_roundtrips() -> None:
    from usagetally.plans.roundtrips import ROUNDTRIPS
    QUERIES.update(ROUNDTRIPS)


_with_roundtrips()
