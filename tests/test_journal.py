"""Drivers that are lost at each step of a commit; jobs that were left out; stored states; day folders."""

import datetime as dt
import glob
import shutil

import pytest
from pyspark.sql import functions as F

from usagetally.plans import facts as fj
from usagetally.plans import usage as uj
from usagetally.plans.jobs import run_batch
from usagetally.plans.roundtrips import Lost, lost_at, stage_inputs
from usagetally.plans.states import StateJobConfig, load_days, reprocess_day, stored_states
from usagetally.plans.window import ends_of, values
from usagetally.schemas import DIM_SCHEMA, ENRICHED_FACT_SCHEMA, FACT_SCHEMA, PROJECT_USAGE_SCHEMA, STATE_SCHEMA, SUMMARY_SCHEMA
from usagetally.session import local_path, scratch_path
from usagetally.sources import journal, manifest
from usagetally.sources.fixtures import DAY_WINDOW, HISTORY_WINDOW, load_userlog
from usagetally.sources.log import calendar_days, read_days
from usagetally.sources.sinks import Conflict, read_versioned

from .conftest import SF_SMALL, rows

TODAY = dt.date(2024, 1, 31)
STEPS = ("intent", "staged", "published", "applied")


def test_a_commit_goes_on_where_it_stopped(spark, monkeypatch):
    done = []
    log = journal.Journal(spark, scratch_path(spark, "journal"))
    commit = lambda: log.commit("w", {"name": "n"}, lambda folder: done.append("stage") or {"folder": folder},
                                lambda staged, again: done.append(f"apply {again}"), lambda intent: done.append(f"undo {intent['name']}"))
    for step in STEPS:
        with lost_at(step):
            commit()
    assert commit()["folder"].endswith("/w/data") and log.pending() == ["w"]
    assert done == ["stage", "apply False"][:0] + ["undo n", "stage", "apply True", "apply True"]
    log.close("w")
    assert log.pending() == []


@pytest.mark.parametrize("layout", ["versioned", "bucketed", "manifest", "left", "new_only"])
def test_facts_of_lost_drivers_are_those_of_a_clean_run(spark, layout):
    log, users = stage_inputs(spark, SF_SMALL)
    mode = layout if layout in ("left", "new_only") else "full"

    def config(name):
        extra = {"bucketed": {"bucketed_view": f"journal_{name}", "buckets": 4},
                 "manifest": {"manifest_buckets": 8, "summary": scratch_path(spark, "summary"), "summary_buckets": 2}}.get(layout, {})
        return fj.FactJobConfig(log=log, users=users, facts=scratch_path(spark, "facts"), dim=scratch_path(spark, "dim") if mode == "full" else None,
                                tiebreak="seq", **extra)

    def result(cfg):
        schema = FACT_SCHEMA if layout == "new_only" else ENRICHED_FACT_SCHEMA
        found = fj.published_facts(spark, cfg) if mode == "full" else spark.read.schema(schema).parquet(cfg.facts)
        dim = rows(spark.read.schema(DIM_SCHEMA).parquet(cfg.dim)) if cfg.dim else []
        return rows(found), dim, rows(manifest.read(spark, cfg.summary, SUMMARY_SCHEMA)) if cfg.summary_buckets else []

    clean, lost = config("clean"), config("lost")
    states = scratch_path(spark, "state"), scratch_path(spark, "state")
    for cfg, state in zip((clean, lost), states, strict=True):
        run_batch(spark, state, "facts", facts=cfg, fact_mode=mode, start=HISTORY_WINDOW[0], end=HISTORY_WINDOW[1])
    for step in STEPS:
        with lost_at(step):
            run_batch(spark, states[1], "facts", facts=lost, fact_mode=mode, today=dt.date(2024, 1, 26))
    for day in (26, 31):           # what is pending, then the rest
        run_batch(spark, states[1], "facts", facts=lost, fact_mode=mode, today=dt.date(2024, 1, day))
        run_batch(spark, states[0], "facts", facts=clean, fact_mode=mode, today=dt.date(2024, 1, day))
    assert result(lost) == result(clean)
    versions = glob.glob(f"{local_path(lost.facts)}/v=*")
    assert layout != "versioned" or len(versions) <= 2             # nothing is left of the attempts


def test_two_publishers_of_a_bucketed_view(spark, monkeypatch):
    log, users = stage_inputs(spark, SF_SMALL)
    cfg = fj.FactJobConfig(log=log, users=users, facts=scratch_path(spark, "facts"), tiebreak="seq", bucketed_view="two_publishers", buckets=4)
    fj.run_full(spark, cfg, *HISTORY_WINDOW)
    real = fj.write_bucketed

    def overtaken(*a, **k):
        monkeypatch.setattr(fj, "write_bucketed", real)
        fj.run_full(spark, cfg, 20240121, 20240121)
        real(*a, **k)

    monkeypatch.setattr(fj, "write_bucketed", overtaken)
    with pytest.raises(Conflict):
        fj.run_full(spark, cfg, 20240122, 20240122)


def test_jobs_catch_up_from_their_own_ends(spark):
    log, users = stage_inputs(spark, SF_SMALL)
    facts = fj.FactJobConfig(log=log, users=users, facts=scratch_path(spark, "facts"), tiebreak="seq", summary=scratch_path(spark, "summary"))
    usage = uj.UsageJobConfig(log=log, table=scratch_path(spark, "usage"), tiebreak="seq")
    state = scratch_path(spark, "state")

    def ends():
        return ends_of(values(read_versioned(spark, state, STATE_SCHEMA)), ("facts", "usage", "user_usage"))

    run_batch(spark, state, "usage", usage=usage, start=20240101, end=20240105)
    assert ends() == {"facts": None, "usage": 20240105, "user_usage": None}
    assert run_batch(spark, state, "facts", facts=facts, today=dt.date(2024, 1, 9)) == (20240101, 20240108)
    assert ends()["facts"] == 20240108
    # usage lags by three days: they are run, the day that both have is not run again
    assert run_batch(spark, state, ("facts", "usage"), facts=facts, usage=usage, today=dt.date(2024, 1, 11)) == (20240106, 20240110)
    assert ends() == {"facts": 20240110, "usage": 20240110, "user_usage": None}
    with pytest.raises(ValueError):
        run_batch(spark, state, "usage", usage=usage, start=20240110, end=20240111)
    with pytest.raises(ValueError):
        run_batch(spark, state, "summary", facts=fj.FactJobConfig(log=log, facts=facts.facts))
    once = uj.UsageJobConfig(log=log, table=scratch_path(spark, "usage-once"), tiebreak="seq")
    uj.run(spark, once, 20240101, 20240110)
    key = ("key", "tmday", "count", "trigertime")
    assert rows(spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(usage.table), *key) == rows(
        spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(once.table), *key)


def test_day_folders_of_other_days_are_never_listed(spark):
    log, _ = stage_inputs(spark, SF_SMALL)
    schema = load_userlog(spark, SF_SMALL).schema
    got = read_days(spark, log, 20240118, 20240122, schema)
    assert rows(got) == rows(load_userlog(spark, SF_SMALL).where("mday between 20240118 and 20240122"))
    days = {f.split("mday=")[1][:8] for f in got.inputFiles()}
    assert days <= {str(d) for d in calendar_days(20240118, 20240122)} and calendar_days(20240228, 20240301) == [20240228, 20240229, 20240301]
    # folders of other days that can't be read, or hold no table, don't matter
    spark.createDataFrame([("x",)], "a string").write.text(f"{log}/mday=20240201")
    assert read_days(spark, log, 20240118, 20240122, schema).count() == got.count()
    shutil.rmtree(local_path(f"{log}/mday=20240119"))
    assert read_days(spark, log, 20240118, 20240122, schema).where("mday = 20240119").count() == 0
    none = read_days(spark, log, 20300101, 20300103, schema)
    assert none.collect() == [] and none.columns == schema.fieldNames()


def test_a_corrected_day_is_read_alone(spark, monkeypatch):
    """A day with rows taken away: keys that only it had lose their facts, its other keys lose its share."""
    from usagetally.plans import states as st
    log, users = stage_inputs(spark, SF_SMALL)
    whole = load_userlog(spark, SF_SMALL)
    cfg = StateJobConfig(fj.FactJobConfig(log=log, users=users, facts=scratch_path(spark, "facts"), tiebreak="seq",
                                          manifest_buckets=8, log_schema=whole.schema), scratch_path(spark, "states"))
    load_days(spark, cfg, *HISTORY_WINDOW)
    before = rows(manifest.read(spark, cfg.facts.facts, ENRICHED_FACT_SCHEMA))
    left = whole.where("mday between 20240101 and 20240120 and (mday <> 20240110 or seq % 3 = 0)")
    shutil.rmtree(local_path(f"{log}/mday=20240110"))
    left.where("mday = 20240110").drop("mday").write.parquet(f"{log}/mday=20240110")
    read, real = [], st.read_log
    monkeypatch.setattr(st, "read_log", lambda *a, **k: read.append(real(*a, **k)) or read[-1])
    for step in STEPS:
        with lost_at(step), pytest.raises(Lost):
            reprocess_day(spark, cfg, 20240110)
    reprocess_day(spark, cfg, 20240110)
    assert {f.split("mday=")[1][:8] for df in read for f in df.inputFiles()} == {"20240110"}
    clean = StateJobConfig(fj.FactJobConfig(log=scratch_path(spark, "log"), users=users, facts=scratch_path(spark, "facts"), tiebreak="seq",
                                            manifest_buckets=8), scratch_path(spark, "states"))
    left.write.partitionBy("mday").parquet(clean.facts.log)
    load_days(spark, clean, *HISTORY_WINDOW)
    after = rows(manifest.read(spark, cfg.facts.facts, ENRICHED_FACT_SCHEMA))
    assert after == rows(manifest.read(spark, clean.facts.facts, ENRICHED_FACT_SCHEMA)) and len(after) < len(before)
    assert rows(stored_states(spark, cfg).select("mday", "pId")) == rows(stored_states(spark, clean).select("mday", "pId"))
    # a reprocess of a day without rows takes all of it out
    shutil.rmtree(local_path(f"{log}/mday=20240110"))
    reprocess_day(spark, cfg, 20240110)
    assert stored_states(spark, cfg).where(F.col("mday") == 20240110).count() == 0


def test_summary_by_deltas_reads_only_touched_buckets(spark):
    log, users = stage_inputs(spark, SF_SMALL)
    cfg = fj.FactJobConfig(log=log, users=users, facts=scratch_path(spark, "facts"), tiebreak="seq", manifest_buckets=16,
                           summary=scratch_path(spark, "summary"), summary_buckets=4)
    fj.run_full(spark, cfg, *HISTORY_WINDOW)
    fj.run_full(spark, cfg, 20240121, 20240122)
    from usagetally.operators import project_summary
    want = rows(project_summary(fj.published_facts(spark, cfg)))
    assert rows(fj.run_summary(spark, cfg)) == want
    staged = fj.run_full(spark, cfg, 20240122, 20240122)         # a part of a window under another name: merged again, counts unchanged
    delta = staged["change"]["touched"]
    assert len(delta) <= 16 and rows(fj.run_summary(spark, cfg)) == rows(project_summary(fj.published_facts(spark, cfg)))
    fj.run_full(spark, cfg, *DAY_WINDOW, rebuild=True)
    assert rows(fj.run_summary(spark, cfg)) == rows(project_summary(fj.published_facts(spark, cfg)))
