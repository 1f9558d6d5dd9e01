"""B3 + K12: run selected jobs for the next batch window, then advance the state.

The state table is a small versioned table (``id, param_key, param_value,
project``).  Every job has its own processed end (``end_date:<job>``), recorded as
soon as its window is published; the common end is the least of the selected jobs'
ends.  A run gives each job the days that it hasn't published: a job that failed,
or wasn't selected for some runs, catches up from its own end, and one that has
never run starts at the state's first day.

A window is published through a journal below the state table (``sources.journal``):
a driver that dies at any step is followed by one that replays the staged result
or, if nothing was staged, computes it anew; no day is lost or merged twice.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import SparkSession

from usagetally.plans import facts as fact_jobs
from usagetally.plans import usage as usage_jobs
from usagetally.plans.window import JOB_ID, advance_state, ends_of, next_window, set_params, values
from usagetally.schemas import STATE_SCHEMA
from usagetally.sources.journal import Journal
from usagetally.sources.sinks import Conflict, current_sequence, read_versioned, replace_table

JOBS = ("facts", "summary", "usage", "user_usage")
#: Jobs that publish windows; the summary is computed anew from the published facts.
WINDOWED = ("facts", "usage", "user_usage")
DEFAULT_ALL = ("facts", "summary", "usage")     # user usage is opt-in


def run_batch(spark: SparkSession, state_root: str, jobs: tuple | str = "all", *,
              facts: fact_jobs.FactJobConfig | None = None,
              usage: usage_jobs.UsageJobConfig | None = None,
              user_usage: usage_jobs.UsageJobConfig | None = None,
              start: int | None = None, end: int | None = None,
              reprocess: bool = False, today: dt.date | None = None,
              fact_mode: str = "full", job: str = JOB_ID) -> tuple[int, int]:
    """Run one batch and return its window ``(start, end)``.

    ``fact_mode`` is ``full`` (Q1), ``left`` (Q2) or ``new_only`` (Q3)."""
    selected = DEFAULT_ALL if jobs == "all" else ((jobs,) if isinstance(jobs, str) else tuple(jobs))
    unknown = set(selected) - set(JOBS)
    if unknown:
        raise ValueError(f"unknown jobs {sorted(unknown)}; choose from {JOBS}")
    if fact_mode not in ("full", "left", "new_only"):
        raise ValueError(f"unknown fact mode {fact_mode!r}")
    if ("facts" in selected and fact_mode == "left" and reprocess and facts.jdbc
            and facts.jdbc.get("duration_mode", "add") == "add"):
        raise ValueError("reprocessing would add durations to the relational copy twice")
    if "summary" in selected and not fact_jobs.summary_sink(facts):
        raise ValueError("the summary job needs a sink: FactJobConfig.summary or a relational summary table")
    configs = {"facts": facts, "usage": usage, "user_usage": user_usage}
    windowed = [name for name in WINDOWED if name in selected]

    def state_values() -> dict[str, str]:
        return values(read_versioned(spark, state_root, STATE_SCHEMA), job)

    def publish_state(change) -> None:
        base = current_sequence(spark, state_root)
        replace_table(change(read_versioned(spark, state_root, STATE_SCHEMA)), state_root, base=base)

    def record(name: str, ended: int, quality: dict) -> None:
        """The end of one job and its window's counts of bad values; at the first record of a state, also the
        ends its common one stands for."""
        ends = ends_of(state_values(), WINDOWED)
        ends[name] = max(ended, ends[name] or 0)
        publish_state(lambda state: set_params(state, {f"quality:{name}": json.dumps(quality)} | {
            f"end_date:{k}": str(v) for k, v in ends.items() if v is not None}, job))

    def journal_of(name: str) -> Journal:
        return Journal(spark, f"{state_root.rstrip('/')}/_journal/{job}/{name}")

    def publish(name: str, first: int, last: int, rebuild: bool, upto: int) -> None:
        """Publish one window of one job and record it; a window that is pending goes on where it stopped."""
        journal, window = journal_of(name), f"{first}-{last}" + ("-rebuild" if rebuild else "")
        try:
            if name == "facts":     # a rebuild covers every processed day, not the window's alone
                staged = fact_jobs.run(spark, facts, fact_mode, first, upto if rebuild else last, rebuild, journal, window)
            else:
                staged = usage_jobs.run(spark, configs[name], first, last, rebuild, upto, journal, window)
        except Conflict:
            journal.close(window)       # another publisher came first: computed anew by the next run
            raise
        record(name, upto if rebuild else last, {"window": window, **staged.get("quality", {})})
        journal.close(window)

    # 1. windows that an earlier run left unfinished
    for name in windowed:
        for window in journal_of(name).pending():
            first, last, *rest = window.split("-")
            ended = ends_of(state_values(), [name])[name]
            if not rest and ended is not None and ended >= int(last):
                journal_of(name).close(window)          # published and recorded, only not closed
            elif journal_of(name).record(window, "staged") is None and not rest:
                # nothing is published; this run's own window begins with these days
                journal_of(name).close_unstaged(window, fact_jobs.undo(spark) if name == "facts" else None)
            else:
                publish(name, int(first), int(last), bool(rest), max(int(last), ended or 0))

    # 2. the next window
    params = state_values()
    ends = ends_of(params, windowed)
    state = read_versioned(spark, state_root, STATE_SCHEMA)
    known = [e for e in ends.values() if e is not None]
    behind = windowed and (len(known) < len(ends) or not known)
    first_day = params.get("first_date") or params.get("start_date")
    if start is None and not reprocess and windowed:
        if behind and first_day:
            start = int(first_day)
        elif known:
            start = int(next_day_of(str(min(known))))
    win = next_window(state, today=today, reprocess=reprocess, start=start, end=end, job=job).first()
    b_start, b_end = int(win.batch_start), int(win.batch_end)
    if b_start > b_end:
        return b_start, b_end            # empty window: nothing to merge
    if not windowed:
        fact_jobs.run_summary(spark, facts)
        return b_start, b_end            # no window is processed, so none is recorded
    if not reprocess and not behind and b_start <= min(known):
        raise ValueError(f"window start {b_start} is not after processed end {min(known)}; pass reprocess=True to rebuild")
    if not first_day or b_start < int(first_day):
        publish_state(lambda state: set_params(state, {"first_date": str(b_start)}, job))
    elif "first_date" not in params:
        publish_state(lambda state: set_params(state, {"first_date": first_day}, job))

    # 3. the jobs, each with the days that it hasn't published
    for name in (j for j in JOBS if j in selected):
        if name == "summary":
            fact_jobs.run_summary(spark, facts)
            continue
        own = ends[name]
        missing = int(next_day_of(str(own))) if own is not None else min(b_start, int(first_day or b_start))
        if reprocess:
            # a rebuild covers everything that was processed, and leaves no gap after it
            publish(name, min(b_start, missing), b_end, True, max(b_end, own or 0))
        elif missing <= b_end:
            publish(name, missing, b_end, False, b_end)
    ended = min(v for v in ends_of(state_values(), windowed).values() if v is not None)
    publish_state(lambda state: advance_state(state, b_start, ended, job))
    return b_start, b_end


def next_day_of(day: str) -> str:
    return (dt.datetime.strptime(day, "%Y%m%d") + dt.timedelta(days=1)).strftime("%Y%m%d")
