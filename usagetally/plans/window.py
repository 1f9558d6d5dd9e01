"""The batch window kept in a small state table.

State rows are ``id, param_key, param_value, project`` (all text), keyed by
``start_date``, ``end_date`` and ``stop_date`` (``0`` = yesterday).
Everything is a DataFrame expression; the state is tiny by construction
(a handful of rows per job).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.functions import next_day, yesterday
from usagetally.schemas import STATE_SCHEMA

JOB_ID = "usage-facts"
PROJECT = "batch"
SHARED_ID = "common"        # rows that hold for every job without a row of its own


def _own(state: DataFrame, job: str) -> DataFrame:
    return state.where(F.col("id").isin(job, SHARED_ID))


def _chosen(job: str):
    """The job's own value, or else the shared one."""
    return F.max_by("param_value", F.struct((F.col("id") == job).alias("own"), F.col("param_value").alias("value")))


def param(state: DataFrame, key: str, job: str = JOB_ID) -> DataFrame:
    """The value of one parameter of ``job`` (as a one-column, one-row frame; NULL if absent)."""
    return _own(state, job).where(F.col("param_key") == key).agg(_chosen(job).alias(key))


def state_from_log(log: DataFrame, job: str = JOB_ID, project: str = PROJECT) -> DataFrame:
    """A state table describing a log that has been processed up to its last day."""
    bounds = log.agg(F.min("mday").alias("start_date"), F.max("mday").alias("end_date"))
    return bounds.select(F.explode(F.array(
        F.struct(F.lit("start_date").alias("k"), F.col("start_date").cast("string").alias("v")),
        F.struct(F.lit("end_date").alias("k"), F.col("end_date").cast("string").alias("v")),
        F.struct(F.lit("stop_date").alias("k"), F.lit("0").alias("v")),
    )).alias("p")).select(
        F.lit(job).alias("id"), F.col("p.k").alias("param_key"),
        F.col("p.v").alias("param_value"), F.lit(project).alias("project"))


def next_window(state: DataFrame, today: dt.date | None = None, reprocess: bool = False,
                start: int | None = None, end: int | None = None, job: str = JOB_ID) -> DataFrame:
    """B1/B2: ``batch_start, batch_end`` of the next run.

    Normal run: from the day after ``end_date`` to ``stop_date`` or, when it is
    0, the day before ``today``.  ``reprocess`` starts at ``start_date``
    instead.  Explicit ``start``/``end`` override the state.
    """
    kv = _own(state, job).groupBy().pivot("param_key", ["start_date", "end_date", "stop_date"]).agg(_chosen(job))
    stop = F.col("stop_date").cast("int")
    default_end = F.when(stop == 0, yesterday(today)).otherwise(stop)
    default_start = F.col("start_date").cast("int") if reprocess else next_day(F.col("end_date").cast("int"))
    return kv.select(
        (F.lit(int(start)) if start is not None else default_start).cast("int").alias("batch_start"),
        (F.lit(int(end)) if end is not None else default_end).cast("int").alias("batch_end"),
    )


def values(state: DataFrame, job: str = JOB_ID) -> dict[str, str]:
    """All parameters of ``job`` (its own, or else the shared ones); the state holds a handful of rows."""
    return {r.param_key: r.value for r in _own(state, job).groupBy("param_key").agg(_chosen(job).alias("value")).collect()}


def ends_of(params: dict[str, str], jobs) -> dict[str, int | None]:
    """The processed end of each of ``jobs``.

    A state without any job's own end tells of a log that every job has processed up to the
    common end.  Once one job has its own end, a job without one has processed nothing."""
    own = {k.split(":", 1)[1]: int(v) for k, v in params.items() if k.startswith("end_date:")}
    common = params.get("end_date")
    return {j: own.get(j) if own else int(common) if common else None for j in jobs}


def set_params(state: DataFrame, values: dict[str, str], job: str = JOB_ID, project: str = PROJECT) -> DataFrame:
    """The state with the given parameters of ``job`` set, rows added where there are none."""
    others = state.where(~((F.col("id") == job) & F.col("param_key").isin(list(values)))).select(*STATE_SCHEMA.fieldNames())
    new = state.sparkSession.createDataFrame([(job, k, v, project) for k, v in values.items()], STATE_SCHEMA)
    return others.unionByName(new)


def advance_state(state: DataFrame, start: int, end: int, job: str = JOB_ID) -> DataFrame:
    """The state after a successful run of ``[start, end]``; the processed end never moves back.

    Publish it only after every sink of the run has committed."""
    done, stop = (param(state, k, job).first()[0] for k in ("end_date", "stop_date"))
    return set_params(state, {"start_date": str(start), "end_date": str(max(int(end), int(done or 0))),
                              "stop_date": stop or "0"}, job)


def state_from_jdbc(spark, options: dict[str, str], table: str, job: str = JOB_ID,
                    project: str = PROJECT, shared_id: str = SHARED_ID) -> DataFrame:
    """The state rows of ``job`` (and the shared ``common`` rows) from a
    relational config table; connection options come from the caller."""
    url = options["url"]
    props = {k: v for k, v in options.items() if k != "url"}
    pred = f"(id = '{shared_id}' or id = '{job}') and project = '{project}'"
    return spark.read.jdbc(url, table, predicates=[pred], properties=props).select(
        *[F.col(c).cast("string").alias(c) for c in STATE_SCHEMA.fieldNames()])


def check_window(state: DataFrame, start: int, reprocess: bool = False, job: str = JOB_ID) -> None:
    """Refuse a window that starts on or before the processed end unless
    ``reprocess``: merging the same days twice would double the counts.

    Reads one value of the tiny state table."""
    if reprocess:
        return
    row = param(state, "end_date", job).first()
    if row[0] is not None and int(start) <= int(row[0]):
        raise ValueError(f"window start {start} is not after processed end {row[0]}; "
                         "pass reprocess=True to rebuild")


__all__ = ["STATE_SCHEMA", "advance_state", "check_window", "next_window", "param", "set_params", "state_from_jdbc",
           "state_from_log"]
