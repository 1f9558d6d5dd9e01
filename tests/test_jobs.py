import datetime as dt

import pytest
from pyspark.sql import functions as F

from usagetally.operators import fact_condense, usage_condense
from usagetally.plans import facts as fj
from usagetally.plans import usage as uj
from usagetally.plans.jobs import run_batch
from usagetally.plans.roundtrips import stage_inputs
from usagetally.plans.window import param, state_from_log
from usagetally.schemas import PROJECT_USAGE_SCHEMA, STATE_SCHEMA
from usagetally.session import scratch_path
from usagetally.sources.fixtures import DAY_WINDOW, HISTORY_WINDOW, load_userlog
from usagetally.sources.log import window_scan
from usagetally.sources.sinks import read_versioned, replace_table

from .conftest import SF_SMALL


def test_run_batch_advances_state_and_refuses_rerun(spark):
    log_path, users_path = stage_inputs(spark, SF_SMALL)
    facts = fj.FactJobConfig(log=log_path, users=users_path, facts=scratch_path(spark, "facts"), tiebreak="seq")
    usage = uj.UsageJobConfig(log=log_path, table=scratch_path(spark, "usage"), tiebreak="seq")
    state_root = scratch_path(spark, "state")
    replace_table(state_from_log(window_scan(load_userlog(spark, SF_SMALL), *HISTORY_WINDOW)), state_root)
    window = run_batch(spark, state_root, ("facts", "usage"), facts=facts, usage=usage,
                       today=dt.date(2024, 1, 31))
    assert window == DAY_WINDOW
    state = read_versioned(spark, state_root, STATE_SCHEMA)
    assert param(state, "end_date").first()[0] == str(DAY_WINDOW[1])
    # the same window again would double counts: refused unless reprocessing
    with pytest.raises(ValueError):
        run_batch(spark, state_root, ("usage",), usage=usage, start=DAY_WINDOW[0], end=DAY_WINDOW[1])
    # an empty window (start after end) changes nothing
    assert run_batch(spark, state_root, ("usage",), usage=usage, today=dt.date(2024, 1, 31)) == (20240131, 20240130)


def test_usage_reprocess_rebuilds_without_double_counting(spark):
    log_path, _ = stage_inputs(spark, SF_SMALL)
    cfg = uj.UsageJobConfig(log=log_path, table=scratch_path(spark, "usage"), tiebreak="seq")
    uj.run(spark, cfg, *HISTORY_WINDOW)
    uj.run(spark, cfg, *DAY_WINDOW)

    def counts():
        t = spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(cfg.table)
        return sorted((r.key, r.tmday, r["count"], r.trigertime) for r in t.collect())
    incremental = counts()
    # rebuilding the window's days from the whole log gives the same counts (no double count)
    uj.run(spark, cfg, *DAY_WINDOW, reprocess=True)
    assert counts() == incremental


def test_int_product_code_is_accepted(spark):
    log = load_userlog(spark, SF_SMALL)
    as_int = log.withColumn("pcode", F.col("pcode").cast("int"))
    a = sorted(tuple(r) for r in fact_condense(log).collect())
    b = sorted(tuple(r) for r in fact_condense(as_int).collect())
    assert a == b
    assert usage_condense(as_int).count() == usage_condense(log).count()


def test_fact_reprocess_rebuilds_instead_of_merging(spark):
    log_path, users_path = stage_inputs(spark, SF_SMALL)
    cfg = fj.FactJobConfig(log=log_path, users=users_path, facts=scratch_path(spark, "facts"), tiebreak="seq")
    fj.run_full(spark, cfg, *HISTORY_WINDOW)
    fj.run_full(spark, cfg, *DAY_WINDOW)
    from usagetally.schemas import ENRICHED_FACT_SCHEMA

    def totals():
        t = read_versioned(spark, cfg.facts, ENRICHED_FACT_SCHEMA)
        return sorted((r.pId, float(r.total_duration), r.first_open_datetime, r.last_close_datetime)
                      for r in t.collect())
    incremental = totals()
    fj.run_full(spark, cfg, *DAY_WINDOW, rebuild=True)
    assert totals() == incremental          # same totals and times, nothing added twice


def test_command_line_runs_a_scheduled_batch(spark):
    from usagetally.__main__ import main
    log_path, users_path = stage_inputs(spark, SF_SMALL)
    state_root = scratch_path(spark, "state")
    replace_table(state_from_log(window_scan(load_userlog(spark, SF_SMALL), *HISTORY_WINDOW)), state_root)
    facts, usage = scratch_path(spark, "facts"), scratch_path(spark, "usage")
    window = main(["--state", state_root, "--log", log_path, "--users", users_path, "--facts", facts,
                   "--usage", usage, "--jobs", "facts,usage", "--tiebreak", "seq",
                   "--start", str(DAY_WINDOW[0]), "--end", str(DAY_WINDOW[1])], spark=spark)
    assert window == DAY_WINDOW
    from usagetally.schemas import ENRICHED_FACT_SCHEMA
    assert read_versioned(spark, facts, ENRICHED_FACT_SCHEMA).count() > 0
    assert spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(usage).count() > 0


def test_late_row_rewrites_only_its_key_bucket(spark):
    import glob
    import os

    from usagetally.session import local_path
    log_path, _ = stage_inputs(spark, SF_SMALL)
    cfg = uj.UsageJobConfig(log=log_path, table=scratch_path(spark, "usage-kb"), tiebreak="seq", key_buckets=8)
    uj.run(spark, cfg, *HISTORY_WINDOW)
    root = local_path(cfg.table)

    def files():
        return {os.path.relpath(f, root) for f in glob.glob(f"{root}/tmday=*/kb=*/*.parquet")}
    before = files()
    # one log row of an old trigger day arrives late, in a later load day
    late = (load_userlog(spark, SF_SMALL).where("pcode = '11036' and trigertime like '2024/01/05%'")
            .orderBy("seq").limit(1).withColumn("mday", F.lit(20240125)))
    late_path = scratch_path(spark, "late-log")
    late.write.partitionBy("mday").parquet(late_path)
    uj.run(spark, uj.UsageJobConfig(log=late_path, table=cfg.table, tiebreak="seq", key_buckets=8), 20240125, 20240125)
    after = files()
    changed_dirs = {os.path.dirname(f) for f in before ^ after}
    assert len(changed_dirs) == 1 and next(iter(changed_dirs)).startswith("tmday=20240105/kb=")
