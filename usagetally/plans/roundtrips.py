"""Registered queries that run whole jobs through their sinks.

Each one stages the derived log (partitioned by ``mday``, like a real log)
and the user dimension in the shared folder, runs a job over the history
window on an empty table (the first run), runs it again over the day
window, and reads back the published table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagetally.plans import facts as fact_jobs
from usagetally.plans import usage as usage_jobs
from usagetally import operators as op
from usagetally.plans.jobs import run_batch
from usagetally.plans.states import StateJobConfig, load_days, reprocess_day
from usagetally.plans.window import state_from_log, values
from usagetally.schemas import (
    DIM_SCHEMA,
    ENRICHED_FACT_SCHEMA,
    FACT_SCHEMA,
    PROJECT_USAGE_SCHEMA,
    RELATIONAL_FACT_SCHEMA,
    STATE_SCHEMA,
    SUMMARY_SCHEMA,
    USER_USAGE_SCHEMA,
)
from usagetally.session import scratch_path
from usagetally.sources.fixtures import DAY_WINDOW, FIXTURE_TODAY, HISTORY_WINDOW, load_userlog, load_users
from usagetally.sources import journal, manifest
from usagetally.sources.log import calendar_days, read_log, window_scan
from usagetally.sources.sinks import read_versioned, replace_partitions, replace_table


def stage_inputs(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Write the derived log (by ``mday``) and users; return their paths."""
    log_path, users_path = scratch_path(spark, "userlog"), scratch_path(spark, "users")
    load_userlog(spark, sf_dir).write.partitionBy("mday").parquet(log_path)
    load_users(spark, sf_dir).write.parquet(users_path)
    return log_path, users_path


def _fact_cfg(spark, sf_dir, **kw) -> fact_jobs.FactJobConfig:
    log_path, users_path = stage_inputs(spark, sf_dir)
    return fact_jobs.FactJobConfig(log=log_path, users=users_path, facts=scratch_path(spark, "facts"),
                                   tiebreak="seq", **kw)


def q_table_replace_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 with K1: first run, then a merge run; the published version."""
    cfg = _fact_cfg(spark, sf_dir)
    fact_jobs.run_full(spark, cfg, *HISTORY_WINDOW, batch="h")
    fact_jobs.run_full(spark, cfg, *DAY_WINDOW, batch="d")
    return read_versioned(spark, cfg.facts, ENRICHED_FACT_SCHEMA)


def q_bucketed_merge_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 over a history kept as a pId-bucketed table behind a view."""
    import uuid
    cfg = _fact_cfg(spark, sf_dir, bucketed_view=f"usage_facts_{uuid.uuid4().hex[:8]}", buckets=8)
    fact_jobs.run_full(spark, cfg, *HISTORY_WINDOW, batch="h")
    fact_jobs.run_full(spark, cfg, *DAY_WINDOW, batch="d")
    return spark.table(cfg.bucketed_view)


def q_fact_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 with K5: new facts appended, partitioned by product."""
    cfg = _fact_cfg(spark, sf_dir, by_product=True)
    fact_jobs.run_new_only(spark, cfg, *HISTORY_WINDOW)
    fact_jobs.run_new_only(spark, cfg, *DAY_WINDOW)
    return spark.read.schema(FACT_SCHEMA).parquet(cfg.facts)


def q_bucketed_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 appending into a pId-bucketed history table (K2 co-located)."""
    import uuid
    cfg = _fact_cfg(spark, sf_dir, bucketed_table=f"usage_new_facts_{uuid.uuid4().hex[:8]}", buckets=8)
    fact_jobs.run_new_only(spark, cfg, *HISTORY_WINDOW)
    fact_jobs.run_new_only(spark, cfg, *DAY_WINDOW)
    return spark.table(cfg.bucketed_table)


def q_dim_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 with K3: new dimension rows appended after each run."""
    cfg = _fact_cfg(spark, sf_dir)
    cfg.dim = scratch_path(spark, "dim")
    for window in (HISTORY_WINDOW, DAY_WINDOW):
        fact_jobs.run_dim(spark, cfg, fact_jobs.day_facts(spark, cfg, *window))
    return spark.read.schema(DIM_SCHEMA).parquet(cfg.dim)


def q_partition_replace_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 with K6: the whole day table after two incremental runs."""
    log_path, _ = stage_inputs(spark, sf_dir)
    cfg = usage_jobs.UsageJobConfig(log=log_path, table=scratch_path(spark, "usage"), tiebreak="seq")
    usage_jobs.run(spark, cfg, *HISTORY_WINDOW)
    usage_jobs.run(spark, cfg, *DAY_WINDOW)
    return spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(cfg.table)


def q_left_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 with K4: facts of both windows' new keys, enriched and appended."""
    cfg = _fact_cfg(spark, sf_dir)
    fact_jobs.run_left(spark, cfg, *HISTORY_WINDOW)
    fact_jobs.run_left(spark, cfg, *DAY_WINDOW)
    return spark.read.schema(ENRICHED_FACT_SCHEMA).parquet(cfg.facts)


def q_user_usage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 with K6: the whole user-usage day table after two incremental runs."""
    log_path, _ = stage_inputs(spark, sf_dir)
    cfg = usage_jobs.UsageJobConfig(log=log_path, table=scratch_path(spark, "user-usage"), tiebreak="seq",
                                    with_project=False)
    usage_jobs.run(spark, cfg, *HISTORY_WINDOW)
    usage_jobs.run(spark, cfg, *DAY_WINDOW)
    return spark.read.schema(USER_USAGE_SCHEMA).parquet(cfg.table)


def q_usage_product_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 over every product (empty product list, P4) with the (pcode, tmday)
    layout (K7): two incremental runs, the whole table read back."""
    log_path, _ = stage_inputs(spark, sf_dir)
    cfg = usage_jobs.UsageJobConfig(log=log_path, table=scratch_path(spark, "usage-bp"), tiebreak="seq",
                                    products=(), extra_partitions=("pcode",))
    usage_jobs.run(spark, cfg, *HISTORY_WINDOW)
    usage_jobs.run(spark, cfg, *DAY_WINDOW)
    return spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(cfg.table)


def q_usage_key_bucket_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 with the tmday=…/kb=… layout: two incremental runs, whole table read back."""
    log_path, _ = stage_inputs(spark, sf_dir)
    cfg = usage_jobs.UsageJobConfig(log=log_path, table=scratch_path(spark, "usage-kb"), tiebreak="seq",
                                    key_buckets=16)
    usage_jobs.run(spark, cfg, *HISTORY_WINDOW)
    usage_jobs.run(spark, cfg, *DAY_WINDOW)
    return spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(cfg.table).select(*PROJECT_USAGE_SCHEMA.fieldNames())


def q_usage_stream_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 by Structured Streaming: the history window's log files land and a
    scheduled ``availableNow`` run merges them; the day window's files land
    and the next run merges only those (the stream checkpoint replaces the
    batch-window state)."""
    from pyspark.sql import functions as F

    from usagetally.streaming import start_usage_stream
    log_dir, work = scratch_path(spark, "streamlog"), scratch_path(spark, "stream")
    cfg = usage_jobs.UsageJobConfig(log=log_dir, table=scratch_path(spark, "usage"), tiebreak="seq")
    log = load_userlog(spark, sf_dir)
    for lo, hi in (HISTORY_WINDOW, DAY_WINDOW):
        log.where(F.col("mday").between(lo, hi)).write.mode("append").partitionBy("mday").parquet(log_dir)
        start_usage_stream(spark, cfg, work, log_schema=log.schema).awaitTermination()
    return spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(cfg.table)


def q_batch_summary_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 + B3 + K12: a state table says the history window is done; one
    scheduled batch runs facts (Q1), summary (Q5) and usage (Q6) for the next window."""
    log_path, users_path = stage_inputs(spark, sf_dir)
    facts_cfg = fact_jobs.FactJobConfig(log=log_path, users=users_path, facts=scratch_path(spark, "facts"),
                                        tiebreak="seq", summary=scratch_path(spark, "summary"))
    usage_cfg = usage_jobs.UsageJobConfig(log=log_path, table=scratch_path(spark, "usage"), tiebreak="seq")
    fact_jobs.run_full(spark, facts_cfg, *HISTORY_WINDOW, batch="h")
    usage_jobs.run(spark, usage_cfg, *HISTORY_WINDOW)
    state_root = scratch_path(spark, "state")
    replace_table(state_from_log(window_scan(load_userlog(spark, sf_dir), *HISTORY_WINDOW)), state_root)
    window = run_batch(spark, state_root, ("facts", "summary", "usage"), facts=facts_cfg, usage=usage_cfg, today=RUN_DAY)
    if window != DAY_WINDOW:
        raise RuntimeError(f"scheduled window {window} is not {DAY_WINDOW}")
    return read_versioned(spark, facts_cfg.summary, SUMMARY_SCHEMA)


# --- runs that fail, catch up and start anew ------------------------------------

RUN_DAY = dt.date.fromisoformat(FIXTURE_TODAY)


class Lost(RuntimeError):
    """The driver of a job is lost."""


@contextmanager
def lost_at(name: str, first: Callable[[dict], None] | None = None):
    """A driver that is lost at a step of the journal; ``first`` does what it still got done."""
    real = journal.step

    def fail(step: str, **what) -> None:
        if step == name:
            if first is not None:
                first(what)
            raise Lost(name)

    journal.step = fail
    try:
        yield
    except Lost:
        pass
    finally:
        journal.step = real


def _batch(spark, sf_dir, **kw):
    """Configurations of all jobs over the staged log, and an empty state."""
    log_path, users_path = stage_inputs(spark, sf_dir)
    facts = fact_jobs.FactJobConfig(log=log_path, users=users_path, facts=scratch_path(spark, "facts"), tiebreak="seq",
                                    summary=scratch_path(spark, "summary"), **kw)
    usage = usage_jobs.UsageJobConfig(log=log_path, table=scratch_path(spark, "usage"), tiebreak="seq")
    return facts, usage, scratch_path(spark, "state")


def q_rerun_after_failure_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver is lost midway in the partition overwrite of the second window, again after
    the overwrite, and is then run with a later end; the usage table of one clean run."""
    _, usage, state = _batch(spark, sf_dir)
    run_batch(spark, state, ("usage",), usage=usage, start=HISTORY_WINDOW[0], end=HISTORY_WINDOW[1])

    def half(what: dict) -> None:
        staged = spark.read.parquet(what["staged"]["partitions"])
        replace_partitions(staged.where("crc32(tmday) % 2 = 0"), usage.table, usage_jobs.partitions(usage))

    with lost_at("staged", half):
        run_batch(spark, state, ("usage",), usage=usage, today=RUN_DAY)
    with lost_at("published"):
        run_batch(spark, state, ("usage",), usage=usage, today=RUN_DAY)
    run_batch(spark, state, ("usage",), usage=usage, today=RUN_DAY)
    return spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(usage.table)


def q_rerun_after_failure_facts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver is lost before it staged, before and after it published, and before it recorded
    the second window; the facts of one clean run."""
    facts, _, state = _batch(spark, sf_dir)
    run_batch(spark, state, ("facts",), facts=facts, start=HISTORY_WINDOW[0], end=HISTORY_WINDOW[1])
    for step in ("intent", "staged", "published", "applied"):
        with lost_at(step):
            run_batch(spark, state, ("facts",), facts=facts, today=RUN_DAY)
    run_batch(spark, state, ("facts",), facts=facts, today=RUN_DAY)
    return read_versioned(spark, facts.facts, ENRICHED_FACT_SCHEMA)


def q_partial_jobs_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage alone for the first window, all jobs for the second: the facts hold every day."""
    facts, usage, state = _batch(spark, sf_dir)
    run_batch(spark, state, "usage", usage=usage, start=HISTORY_WINDOW[0], end=HISTORY_WINDOW[1])
    run_batch(spark, state, "all", facts=facts, usage=usage, start=DAY_WINDOW[0], end=DAY_WINDOW[1])
    return read_versioned(spark, facts.facts, ENRICHED_FACT_SCHEMA)


def q_first_state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run makes the state, the next one takes its window from it; the user-usage table."""
    log_path, _ = stage_inputs(spark, sf_dir)
    cfg = usage_jobs.UsageJobConfig(log=log_path, table=scratch_path(spark, "user-usage"), with_project=False, tiebreak="seq")
    state = scratch_path(spark, "state")
    run_batch(spark, state, "user_usage", user_usage=cfg, start=HISTORY_WINDOW[0], end=HISTORY_WINDOW[1])
    run_batch(spark, state, "user_usage", user_usage=cfg, today=RUN_DAY)
    return spark.read.schema(USER_USAGE_SCHEMA).parquet(cfg.table)


def q_reprocess_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2, Q6: both windows, then the second one reprocessed: its trigger days are rebuilt, not merged twice."""
    _, usage, state = _batch(spark, sf_dir)
    for window in (HISTORY_WINDOW, DAY_WINDOW):
        run_batch(spark, state, "usage", usage=usage, start=window[0], end=window[1])
    run_batch(spark, state, "usage", usage=usage, start=DAY_WINDOW[0], end=DAY_WINDOW[1], reprocess=True)
    return spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(usage.table)


def q_batch_quality_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bad values that the jobs observed and stored with the state of the second window."""
    facts, usage, state = _batch(spark, sf_dir)
    replace_table(state_from_log(window_scan(load_userlog(spark, sf_dir), *HISTORY_WINDOW)), state)
    run_batch(spark, state, ("facts", "usage"), facts=facts, usage=usage, today=RUN_DAY)
    stored = read_versioned(spark, state, STATE_SCHEMA).where(F.col("param_key").startswith("quality:"))
    counts = F.from_json("param_value", "map<string, string>")
    return (stored.select(F.substring_index("param_key", ":", -1).alias("job"), F.explode(counts).alias("metric", "n"))
            .where("metric <> 'window'").select("job", "metric", F.col("n").cast("long").alias("n")))


# --- manifest tables ---------------------------------------------------------------

def q_manifest_merge_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 with K1 copy-on-write: a batch rewrites the key buckets it touches; its second run does nothing."""
    cfg = _fact_cfg(spark, sf_dir, manifest_buckets=64)
    for window in (HISTORY_WINDOW, DAY_WINDOW, DAY_WINDOW):
        fact_jobs.run_full(spark, cfg, *window)
    return fact_jobs.published_facts(spark, cfg)


def q_keyed_update_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K10 via J9 applied to its stored table: the relational copy after the same window is applied twice."""
    from usagetally.plans.catalog import day_enriched, history_enriched, user_lookup
    from usagetally.plans.relational import apply_update
    lookup = user_lookup(spark, sf_dir)
    history = history_enriched(spark, sf_dir, lookup)
    merged = op.fact_merge_left(day_enriched(spark, sf_dir, lookup), history)
    root, window = scratch_path(spark, "relational"), f"{DAY_WINDOW[0]}-{DAY_WINDOW[1]}"
    manifest.append(spark, root, op.relational_facts(history), "history", ("id",), 16)
    for _ in range(2):
        apply_update(spark, root, merged, window, buckets=16)
    return manifest.read(spark, root, RELATIONAL_FACT_SCHEMA)


def q_compaction_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3, K2: a daily append for each day of both windows, then the small files compacted."""
    cfg = _fact_cfg(spark, sf_dir, manifest_buckets=4)
    for day in calendar_days(HISTORY_WINDOW[0], DAY_WINDOW[1]):
        fact_jobs.run_new_only(spark, cfg, day, day)
    manifest.compact(spark, cfg.facts, FACT_SCHEMA)
    return manifest.read(spark, cfg.facts, FACT_SCHEMA)


def q_fact_new_only_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anti join reads only the buckets and key range of the history that the batch can meet."""
    cfg = _fact_cfg(spark, sf_dir, manifest_buckets=16)
    history = fact_jobs.day_facts(spark, cfg, *HISTORY_WINDOW, numeric_text_defaults=False)
    manifest.append(spark, cfg.facts, history, "history", ("pId",), 16)
    with_day = scratch_path(spark, "day-facts")
    fact_jobs.day_facts(spark, cfg, *DAY_WINDOW, numeric_text_defaults=False).write.parquet(with_day)
    day = spark.read.schema(FACT_SCHEMA).parquet(with_day)
    return op.fact_new_only(day, manifest.matching(spark, cfg.facts, FACT_SCHEMA, day, ("pId",), 16))


#: Three batches that cover both windows.
THREE_WINDOWS = ((20240101, 20240110), (20240111, 20240120), (20240121, 20240130))


def q_summary_delta_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts kept up by the signed changes of three batches, without a scan of all facts."""
    cfg = _fact_cfg(spark, sf_dir, manifest_buckets=16, summary=scratch_path(spark, "summary"), summary_buckets=4)
    for window in THREE_WINDOWS:
        fact_jobs.run_full(spark, cfg, *window)
    return fact_jobs.run_summary(spark, cfg)


def q_reprocess_from_states_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, B2: all days from stored states, one of them first loaded with half of its rows and later corrected."""
    log_path, users_path = scratch_path(spark, "userlog"), scratch_path(spark, "users")
    log, bad = load_userlog(spark, sf_dir), 20240115
    log.where(f"mday <> {bad} or seq % 2 = 0").write.partitionBy("mday").parquet(log_path)
    load_users(spark, sf_dir).write.parquet(users_path)
    facts = fact_jobs.FactJobConfig(log=log_path, users=users_path, facts=scratch_path(spark, "facts"), tiebreak="seq",
                                    manifest_buckets=16, log_schema=log.schema)
    cfg = StateJobConfig(facts, scratch_path(spark, "states"))
    for window in (HISTORY_WINDOW, DAY_WINDOW):
        load_days(spark, cfg, *window)
    replace_partitions(log.where(f"mday = {bad}"), log_path, ("mday",))       # the corrected day arrives
    reprocess_day(spark, cfg, bad)
    return manifest.read(spark, facts.facts, ENRICHED_FACT_SCHEMA)


def q_day_path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 by day folders: only the window's folders are listed, and the schema is declared."""
    log_path, _ = stage_inputs(spark, sf_dir)
    return read_log(spark, log_path, *DAY_WINDOW, schema=load_userlog(spark, sf_dir).schema)


ROUNDTRIPS = {
    "table_replace_roundtrip": q_table_replace_roundtrip,
    "bucketed_merge_roundtrip": q_bucketed_merge_roundtrip,
    "fact_append_roundtrip": q_fact_append_roundtrip,
    "bucketed_append_roundtrip": q_bucketed_append_roundtrip,
    "dim_append_roundtrip": q_dim_append_roundtrip,
    "left_append_roundtrip": q_left_append_roundtrip,
    "user_usage_roundtrip": q_user_usage_roundtrip,
    "partition_replace_roundtrip": q_partition_replace_roundtrip,
    "batch_summary_roundtrip": q_batch_summary_roundtrip,
    "usage_stream_roundtrip": q_usage_stream_roundtrip,
    "usage_key_bucket_roundtrip": q_usage_key_bucket_roundtrip,
    "usage_product_partition_roundtrip": q_usage_product_partition_roundtrip,
    "rerun_after_failure_roundtrip": q_rerun_after_failure_roundtrip,
    "rerun_after_failure_facts_roundtrip": q_rerun_after_failure_facts_roundtrip,
    "partial_jobs_roundtrip": q_partial_jobs_roundtrip,
    "first_state_roundtrip": q_first_state_roundtrip,
    "reprocess_roundtrip": q_reprocess_roundtrip,
    "batch_quality_roundtrip": q_batch_quality_roundtrip,
    "manifest_merge_roundtrip": q_manifest_merge_roundtrip,
    "keyed_update_roundtrip": q_keyed_update_roundtrip,
    "compaction_roundtrip": q_compaction_roundtrip,
    "fact_new_only_skipping": q_fact_new_only_skipping,
    "summary_delta_roundtrip": q_summary_delta_roundtrip,
    "reprocess_from_states_roundtrip": q_reprocess_from_states_roundtrip,
    "day_path_scan": q_day_path_scan,
}
