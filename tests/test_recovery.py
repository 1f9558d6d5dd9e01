"""Reruns, reprocessing, several jobs in one state, concurrent publishers, late rows."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from usagetally.functions import day_from_time
from usagetally.operators import fact_condense, usage_condense
from usagetally.plans import facts as fj
from usagetally.plans import usage as uj
from usagetally.plans.jobs import run_batch
from usagetally.plans.roundtrips import stage_inputs
from usagetally.plans.window import next_window, param, state_from_log
from usagetally.schemas import ENRICHED_FACT_SCHEMA, PROJECT_USAGE_SCHEMA, STATE_SCHEMA, USER_USAGE_SCHEMA
from usagetally.session import exists, local_path, scratch_path
from usagetally.sources.fixtures import DAY_WINDOW, HISTORY_WINDOW, load_userlog
from usagetally.sources.log import window_scan
from usagetally.sources.sinks import append_bucketed, current_sequence, prune_versions, read_versioned, replace_table
from usagetally.streaming.usage_stream import apply_batch

from .conftest import SF_SMALL


def usage_rows(spark, path, schema=PROJECT_USAGE_SCHEMA):
    return sorted((r.key, r.tmday, r["count"], r.trigertime) for r in spark.read.schema(schema).parquet(path).collect())


def fact_totals(spark, path):
    return sorted((r.pId, float(r.total_duration), r.first_open_datetime, r.last_close_datetime)
                  for r in read_versioned(spark, path, ENRICHED_FACT_SCHEMA).collect())


def setup(spark):
    log, users = stage_inputs(spark, SF_SMALL)
    facts = fj.FactJobConfig(log=log, users=users, facts=scratch_path(spark, "facts"), tiebreak="seq")
    usage = uj.UsageJobConfig(log=log, table=scratch_path(spark, "usage"), tiebreak="seq")
    state = scratch_path(spark, "state")
    replace_table(state_from_log(window_scan(load_userlog(spark, SF_SMALL), *HISTORY_WINDOW)), state)
    fj.run_full(spark, facts, *HISTORY_WINDOW)
    uj.run(spark, usage, *HISTORY_WINDOW)
    return facts, usage, state


def test_rerun_after_a_failed_job_counts_nothing_twice(spark, monkeypatch):
    facts, usage, state = setup(spark)
    clean_facts, clean_usage, clean_state = setup(spark)
    run_batch(spark, clean_state, ("facts", "usage"), facts=clean_facts, usage=clean_usage, today=dt.date(2024, 1, 31))
    real = uj.run
    monkeypatch.setattr(uj, "run", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):       # facts are published, usage fails, a day before the end
        run_batch(spark, state, ("facts", "usage"), facts=facts, usage=usage, today=dt.date(2024, 1, 30))
    monkeypatch.setattr(uj, "run", real)
    run_batch(spark, state, ("facts", "usage"), facts=facts, usage=usage, today=dt.date(2024, 1, 31))
    assert fact_totals(spark, facts.facts) == fact_totals(spark, clean_facts.facts)
    assert usage_rows(spark, usage.table) == usage_rows(spark, clean_usage.table)
    # reprocessing an older window changes nothing and doesn't move the end back
    run_batch(spark, state, ("facts", "usage"), facts=facts, usage=usage, start=20240105, end=20240110, reprocess=True)
    assert param(read_versioned(spark, state, STATE_SCHEMA), "end_date").first()[0] == str(DAY_WINDOW[1])
    assert fact_totals(spark, facts.facts) == fact_totals(spark, clean_facts.facts)
    assert usage_rows(spark, usage.table) == usage_rows(spark, clean_usage.table)


def test_first_state_guards_the_next_run(spark):
    log, _ = stage_inputs(spark, SF_SMALL)
    usage = uj.UsageJobConfig(log=log, table=scratch_path(spark, "usage"), with_project=False, tiebreak="seq")
    state = scratch_path(spark, "state")
    run_batch(spark, state, ("user_usage",), user_usage=usage, start=HISTORY_WINDOW[0], end=HISTORY_WINDOW[1])
    before = usage_rows(spark, usage.table, USER_USAGE_SCHEMA)
    with pytest.raises(ValueError):
        run_batch(spark, state, ("user_usage",), user_usage=usage, start=HISTORY_WINDOW[0], end=HISTORY_WINDOW[1])
    assert usage_rows(spark, usage.table, USER_USAGE_SCHEMA) == before
    assert run_batch(spark, state, ("user_usage",), user_usage=usage, today=dt.date(2024, 1, 31)) == DAY_WINDOW


def test_two_jobs_share_a_state_table(spark):
    rows = [("other", "end_date", "20221231"), ("usage-facts", "end_date", "20240120"), ("common", "stop_date", "0"),
            ("common", "end_date", "20200101")]
    state = spark.createDataFrame([(*r, "batch") for r in rows], STATE_SCHEMA)
    for job, want in (("usage-facts", 20240121), ("other", 20230101), ("third", 20200102)):
        assert next_window(state, today=dt.date(2024, 1, 31), job=job).first().batch_start == want


def test_usage_without_a_row_id_ignores_row_order(spark):
    log = load_userlog(spark, SF_SMALL).drop("seq").withColumn("trigertime", F.lit("2024/01/05 00:00:00"))
    a, b = (sorted(map(tuple, usage_condense(x, tiebreak=None).collect()))
            for x in (log.repartition(7).sortWithinPartitions("prjname"), log.repartition(3).sortWithinPartitions(F.desc("prjname"))))
    assert a == b


def test_trigger_days(spark):
    cases = {"2016年1月1日12:00:00": "20160101", "2016年7月9日 12:00": "20160709", "20160719 10:00": "20160719",
             "2016/07/19 15:11:49": "20160719", "2016-7-9": "20160709", "2016/99/99": "20850101", "2015/02/29": "20850101",
             "": "20850101", "N/A": "20850101", None: "20850101"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, day string")
    assert [r.t for r in df.where(day_from_time("t") != F.col("day")).collect()] == []


def test_null_int_product_code_is_zero(spark):
    log = load_userlog(spark, SF_SMALL).withColumn("pcode", F.when(F.col("seq") % 2 == 0, F.col("pcode").cast("int")))
    assert "0" in {r.pcode for r in fact_condense(log).select("pcode").distinct().collect()}
    codes = {r.pcode for r in usage_condense(log, products=()).select("pcode").distinct().collect()}
    assert "0" in codes and "N/A" not in codes


def test_second_publisher_of_one_base_fails(spark):
    root = scratch_path(spark, "published")
    df = spark.range(3)
    replace_table(df, root)
    base = current_sequence(spark, root)
    replace_table(df, root, base=base)
    with pytest.raises(RuntimeError):
        replace_table(df, root, base=base)


def test_prune_leaves_a_write_in_progress(spark):
    root = scratch_path(spark, "pruned")
    for _ in range(3):
        replace_table(spark.range(3), root)
    spark.range(2).write.parquet(f"{root}/v=in-progress")
    assert len(prune_versions(spark, root, keep=2)) == 1
    assert exists(spark, f"{root}/v=in-progress")


def test_bucketed_append_writes_one_file_a_bucket(spark):
    path = scratch_path(spark, "buckets")
    df = spark.range(1000).selectExpr("cast(id as string) as pId").repartition(7)
    append_bucketed(df, "one_file_each", 4, path=path)
    assert len(glob.glob(f"{local_path(path)}/*.parquet")) <= 4


def test_streaming_keeps_key_buckets(spark):
    log = load_userlog(spark, SF_SMALL)
    tables = {}
    for n in (0, 8):
        cfg = uj.UsageJobConfig(log="", table=scratch_path(spark, f"stream-{n}"), tiebreak="seq", key_buckets=n)
        work = scratch_path(spark, "work")
        for i, window in enumerate((HISTORY_WINDOW, DAY_WINDOW)):
            apply_batch(cfg, work, window_scan(log, *window), i)
        tables[n] = usage_rows(spark, cfg.table)
        assert not exists(spark, f"{work}/staged/batch=1") and exists(spark, f"{work}/applied/batch=1")
    assert tables[0] == tables[8]
