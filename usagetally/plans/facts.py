"""Q1-Q5: project-fact jobs from a log window to published tables.

Each job is a DataFrame plan from the log scan to its sinks; batch-level
DataFrames used twice are cut from their lineage by ``writing them once
as a table in the shared folder named by ``spark.checkpoint.dir`` (never a
local folder),
so a lost executor costs a recomputation of one stage, not of the job.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagetally import operators as op
from usagetally.operators.quality import fact_quality
from usagetally.plans import deltas
from usagetally.schemas import DIM_SCHEMA, ENRICHED_FACT_COLUMNS, ENRICHED_FACT_SCHEMA, FACT_SCHEMA, SUMMARY_SCHEMA
from usagetally.sources import jdbc, manifest
from usagetally.sources.files import remove
from usagetally.sources.journal import Journal, once
from usagetally.sources.log import read_log, read_or_empty
from usagetally.sources.sinks import (
    RunFolder,
    append,
    append_bucketed,
    current_sequence,
    current_version,
    new_bucketed,
    new_version,
    point_to,
    prune_bucketed,
    prune_versions,
    read_bucketed,
    read_versioned,
    replace_table,
    swap_view,
    viewed_table,
    write_bucketed,
    write_version,
)


@dataclass
class FactJobConfig:
    """Where a fact job reads and writes.  ``tiebreak`` names a unique row id
    of the log when it has one (otherwise a hash of the row breaks ties)."""
    log: str
    facts: str                      # K1 versioned root (full) or plain path (left / new only)
    users: str | None = None
    dim: str | None = None
    day_col: str = "mday"
    log_schema: StructType | None = None  # declared log schema: only the window's day folders are listed (S1)
    tiebreak: str | None = None
    products: tuple = ()            # P4: product codes; empty = every product
    key_delimiter: str = ""
    slash_rule: bool = True         # False: backslash-only project names (F2 variant)
    by_product: bool = False        # K5: partition new facts by product
    bucketed_view: str | None = None  # full mode: history as a bucketed table behind this view
    bucketed_table: str | None = None  # left / new-only modes: history as this bucketed table
    buckets: int = 0                # number of pId buckets of those tables
    manifest_buckets: int = 0       # full and new-only modes: facts as a manifest table of so many pId buckets
    keep_versions: int = 2          # full mode: published versions kept (current + previous)
    summary: str | None = None      # summary table root (Q5)
    summary_buckets: int = 0        # with manifest_buckets: summary kept up by signed deltas, in so many buckets
    jdbc: dict | None = None        # {"options": {...}, "summary": t, "facts": t, "dim": t}


def day_facts(spark: SparkSession, cfg: FactJobConfig, start: int, end: int,
              numeric_text_defaults: bool = True, counted: Observation | None = None) -> DataFrame:
    """The window's facts; ``counted`` observes the log's bad values on the way."""
    log = op.product_filter(read_log(spark, cfg.log, start, end, cfg.day_col, cfg.log_schema), cfg.products)
    if counted is not None:
        log = log.observe(counted, *fact_quality(log))
    return op.fact_condense(log, numeric_text_defaults, slash_rule=cfg.slash_rule,
                            tiebreak=cfg.tiebreak, key_delimiter=cfg.key_delimiter)


def merge_full(day: DataFrame, lookup: DataFrame, history: DataFrame) -> DataFrame:
    """Q1 core: enrich, then FULL merge with history (22 columns)."""
    return op.fact_merge_full(op.enrich_users(day, lookup=lookup), history)


def run(spark: SparkSession, cfg: FactJobConfig, mode: str, start: int, end: int, rebuild: bool,
        journal: Journal | None = None, window: str | None = None) -> dict:
    """One window of the fact job in mode ``full``, ``left`` or ``new_only``; returns the staged record."""
    if mode == "full":
        return run_full(spark, cfg, start, end, rebuild=rebuild, journal=journal, window=window)
    return (run_left if mode == "left" else run_new_only)(spark, cfg, start, end, journal, window)


def undo(spark: SparkSession):
    """Removes what an unfinished stage left outside its journal entry."""
    def remove_version(intent: dict) -> None:
        if intent.get("layout") == "versioned":
            remove(spark, f"{intent['target'].rstrip('/')}/{intent['name']}")
        elif intent.get("layout") == "bucketed":
            spark.sql(f"DROP TABLE IF EXISTS {intent['name']}")
            remove(spark, intent["path"])
    return remove_version


def run_full(spark: SparkSession, cfg: FactJobConfig, start: int, end: int,
             batch: str | None = None, rebuild: bool = False,
             journal: Journal | None = None, window: str | None = None) -> dict:
    """Q1 (+Q4 with ``cfg.dim``): publish the fully merged, enriched fact table.

    ``rebuild`` (reprocessing) condenses every log day up to ``end`` and
    publishes that without merging, so a rerun never adds durations twice.
    The new content is written first and becomes current in one step, through
    ``journal`` (see ``sources.journal``).  Returns the staged record."""
    batch = batch or (f"rebuild-{end}" if rebuild else f"{start}-{end}")
    if cfg.manifest_buckets:
        intent = {"layout": "manifest", "target": cfg.facts, "window": f"{batch}-{uuid.uuid4().hex[:12]}" if rebuild else batch}
    elif cfg.bucketed_view:
        table = new_bucketed(spark, cfg.bucketed_view)
        intent = {"layout": "bucketed", "target": cfg.bucketed_view, "name": table,
                  "path": f"{cfg.facts.rstrip('/')}/v={batch}-{table[-12:]}"}
    else:
        intent = {"layout": "versioned", "target": cfg.facts, "name": new_version(batch)}

    def stage(folder: str) -> dict:
        layout = intent["layout"]
        counted = Observation("facts")
        with RunFolder(spark, "facts-full") as run:
            if layout == "versioned":       # the base is taken before the history is read
                intent["base"] = current_sequence(spark, cfg.facts)
            elif layout == "bucketed":
                intent["base"] = viewed_table(spark, cfg.bucketed_view)
            day = run.stage(day_facts(spark, cfg, 0 if rebuild else start, end, counted=counted), "day-facts")
            lookup = run.stage(op.user_lookup(spark.read.parquet(cfg.users)), "user-lookup")
            nothing = spark.createDataFrame([], ENRICHED_FACT_SCHEMA)
            if layout == "manifest":
                staged = _stage_manifest(spark, cfg, day, lookup, rebuild, folder)
            elif layout == "bucketed":
                history = nothing if rebuild else read_bucketed(spark, cfg.bucketed_view, ENRICHED_FACT_SCHEMA)
                write_bucketed(merge_full(day, lookup, history), intent["name"], intent["path"],
                               cfg.buckets or spark.sparkContext.defaultParallelism)
                staged = {}
            else:
                history = nothing if rebuild else read_versioned(spark, cfg.facts, ENRICHED_FACT_SCHEMA)
                write_version(merge_full(day, lookup, history), cfg.facts, intent["name"])
                staged = {}
            if cfg.dim:
                _fresh_dim(spark, cfg, day).write.parquet(f"{folder}/dim")
                staged["dim"] = f"{folder}/dim"
        return {**intent, **staged, "quality": counted.get}

    def apply(staged: dict, again: bool) -> None:
        if staged["layout"] == "manifest":
            manifest.publish_upsert(spark, cfg.facts, staged["change"], staged["window"])
            if cfg.summary_buckets and cfg.summary:
                deltas.apply_delta(spark, cfg.summary, spark.read.schema(SUMMARY_SCHEMA).parquet(staged["delta"]),
                                   cfg.summary_buckets, staged["window"])
        elif staged["layout"] == "bucketed":
            swap_view(spark, cfg.bucketed_view, staged["name"], staged["base"])
        else:
            point_to(spark, cfg.facts, staged["name"], staged["base"])
        if staged.get("dim"):
            _append_dim(spark, cfg, spark.read.schema(DIM_SCHEMA).parquet(staged["dim"]))

    if cfg.manifest_buckets and not rebuild and intent["window"] in manifest.load(spark, cfg.facts).windows:
        staged = {**intent, "again": True}          # the table holds this window
        if journal is not None and window is not None and journal.record(window, "staged") is not None:
            staged = journal.commit(window, intent, stage, apply, undo(spark))
    else:
        staged = _commit(spark, journal, window or f"{start}-{end}", intent, stage, apply)
    if cfg.keep_versions:
        if cfg.manifest_buckets:
            manifest.vacuum(spark, cfg.facts, cfg.keep_versions)
        elif cfg.bucketed_view:
            prune_bucketed(spark, cfg.bucketed_view, cfg.keep_versions)
        else:
            prune_versions(spark, cfg.facts, cfg.keep_versions)
    return staged


def _commit(spark: SparkSession, journal: Journal | None, window: str, intent: dict, stage, apply) -> dict:
    """Through the caller's journal or, without one, through one that goes when the job ends."""
    if journal is not None:
        return journal.commit(window, intent, stage, apply, undo(spark))
    own = once(spark, "facts")
    staged = own.commit(window, intent, stage, apply, undo(spark))
    remove(spark, own.root)
    return staged


def _stage_manifest(spark: SparkSession, cfg: FactJobConfig, day: DataFrame, lookup: DataFrame, rebuild: bool,
                    folder: str) -> dict:
    """The new files of the buckets that the day's keys fall in (all buckets for a rebuild) and the summary's delta."""
    seen = manifest.load(spark, cfg.facts)

    def merge(batch: DataFrame, stored: DataFrame) -> DataFrame:
        return merge_full(batch, lookup, stored.limit(0) if rebuild else stored)

    change = manifest.prepare_upsert(spark, cfg.facts, day, merge, ENRICHED_FACT_SCHEMA, ("pId",), cfg.manifest_buckets, rebuild)
    staged = {"change": change}
    if cfg.summary_buckets and cfg.summary:
        if seen.sequence != change["base"]:
            raise manifest.Conflict(f"{cfg.facts} was published by another job while its summary was computed")
        old = manifest.read(spark, cfg.facts, ENRICHED_FACT_SCHEMA, change["touched"], seen)
        fresh = manifest.Manifest(files=change["files"])
        new = manifest.read(spark, cfg.facts, ENRICHED_FACT_SCHEMA, manifest=fresh)
        keys = None if rebuild else day.select("pId")
        deltas.summary_delta(old, new, keys).write.parquet(f"{folder}/delta")
        staged["delta"] = f"{folder}/delta"
    return staged


def run_left(spark: SparkSession, cfg: FactJobConfig, start: int, end: int,
             journal: Journal | None = None, window: str | None = None) -> dict:
    """Q2: today's keys merged with history; new facts appended (K4) and,
    with ``cfg.jdbc``, relational insert (K9) and update (K10) rows written.

    All of it is staged before anything is written to a target, so a narrow relational
    writer never holds up the merge, and a replay writes the same rows."""
    def stage(folder: str) -> dict:
        counted, staged = Observation("facts"), {"rows": f"{folder}/rows"}
        with RunFolder(spark, "facts-left") as run:
            day = day_facts(spark, cfg, start, end, counted=counted)
            lookup = run.stage(op.user_lookup(spark.read.parquet(cfg.users)), "user-lookup")
            history = _append_history(spark, cfg, ENRICHED_FACT_SCHEMA)
            merged = run.stage(op.fact_merge_left(op.enrich_users(day, lookup=lookup), history), "merged")
            if cfg.jdbc:
                opts, mode = cfg.jdbc["options"], cfg.jdbc.get("duration_mode", "add")
                stored = run.stage(jdbc.read_table(spark, cfg.jdbc["facts"], opts), "stored")
                op.relational_insert_rows(merged, stored).write.parquet(f"{folder}/insert")
                whole = cfg.jdbc.get("update", "stage") == "replace"       # small tables: publish whole
                (op.relational_update_result if whole else op.relational_changed_rows)(stored, merged, mode).write.parquet(
                    f"{folder}/update")
                staged |= {"insert": f"{folder}/insert", "update": f"{folder}/update", "whole": whole}
            merged.where(F.col("is_insert") == 1).select(*ENRICHED_FACT_COLUMNS).write.parquet(staged["rows"])
        return {**staged, "quality": counted.get}

    def apply(staged: dict, again: bool) -> None:
        if cfg.jdbc:
            opts, update = cfg.jdbc["options"], spark.read.parquet(staged["update"])
            rows = spark.read.parquet(staged["insert"])
            if staged["whole"]:
                ids = rows.select("id") if again else None
                update = update if ids is None else update.join(ids, "id", "left_anti")
                jdbc.replace_with_updated(update, cfg.jdbc["facts"], opts)
                jdbc.append_rows(rows, cfg.jdbc["facts"], opts)
            else:                                                  # changed rows only
                if again:
                    rows = rows.join(jdbc.read_table(spark, cfg.jdbc["facts"], opts).select("id"), "id", "left_anti")
                jdbc.append_rows(rows, cfg.jdbc["facts"], opts)
                jdbc.stage_changes(update, cfg.jdbc.get("changes", cfg.jdbc["facts"] + "_changes"), opts)
        _append_facts(spark, cfg, spark.read.schema(ENRICHED_FACT_SCHEMA).parquet(staged["rows"]), ENRICHED_FACT_SCHEMA, again)

    return _commit(spark, journal, window or f"{start}-{end}", {"layout": "append", "target": cfg.facts}, stage, apply)


def run_new_only(spark: SparkSession, cfg: FactJobConfig, start: int, end: int,
                 journal: Journal | None = None, window: str | None = None) -> dict:
    """Q3: append facts whose key is new and that have a dongle (K2 / K5).

    With ``manifest_buckets`` the history is read only in the buckets that the day's keys fall in."""
    window = window or f"{start}-{end}"

    def stage(folder: str) -> dict:
        counted = Observation("facts")
        with RunFolder(spark, "facts-new") as run:
            day = run.stage(day_facts(spark, cfg, start, end, numeric_text_defaults=False, counted=counted), "day-facts")
            op.fact_new_only(day, _known_keys(spark, cfg, day)).write.parquet(f"{folder}/rows")
        return {"rows": f"{folder}/rows", "quality": counted.get}

    def apply(staged: dict, again: bool) -> None:
        rows = spark.read.schema(FACT_SCHEMA).parquet(staged["rows"])
        if cfg.manifest_buckets:
            manifest.append(spark, cfg.facts, rows, window, ("pId",), cfg.manifest_buckets)
        else:
            _append_facts(spark, cfg, rows, FACT_SCHEMA, again)

    return _commit(spark, journal, window, {"layout": "append", "target": cfg.facts}, stage, apply)


def _known_keys(spark: SparkSession, cfg: FactJobConfig, day: DataFrame) -> DataFrame:
    """The stored keys that ``day`` (a written table) could meet."""
    if cfg.manifest_buckets:
        return manifest.matching(spark, cfg.facts, FACT_SCHEMA, day, ("pId",), cfg.manifest_buckets).select("pId")
    return _append_history(spark, cfg, FACT_SCHEMA).select("pId")


def _append_history(spark: SparkSession, cfg: FactJobConfig, schema) -> DataFrame:
    if cfg.bucketed_table:
        return read_bucketed(spark, cfg.bucketed_table, schema)
    return read_or_empty(spark, cfg.facts, schema)


def _append_facts(spark: SparkSession, cfg: FactJobConfig, rows: DataFrame, schema, again: bool = False) -> None:
    """K2/K4/K5; ``again``: an earlier run may have appended some of the rows."""
    parts = ["pcode"] if cfg.by_product else []
    if again:
        rows = op.new_keys_only(rows, _append_history(spark, cfg, schema).select("pId"))
    if cfg.bucketed_table:
        append_bucketed(rows, cfg.bucketed_table, cfg.buckets or spark.sparkContext.defaultParallelism,
                        path=cfg.facts, partition_by=parts)
    else:
        append(rows, cfg.facts, partition_by=parts)


def run_dim(spark: SparkSession, cfg: FactJobConfig, day: DataFrame) -> None:
    """Q4: append new project-dimension rows (K3; K11 with ``cfg.jdbc``)."""
    with RunFolder(spark, "dim") as run:
        _append_dim(spark, cfg, run.stage(_fresh_dim(spark, cfg, day), "new-dim"))


def _fresh_dim(spark: SparkSession, cfg: FactJobConfig, day: DataFrame) -> DataFrame:
    return op.new_keys_only(op.dim_condense(day, cfg.key_delimiter), read_or_empty(spark, cfg.dim, DIM_SCHEMA, ["pId"]))


def _append_dim(spark: SparkSession, cfg: FactJobConfig, fresh: DataFrame) -> None:
    """Append staged dimension rows whose key isn't stored (a replay finds its own rows stored)."""
    if cfg.jdbc and cfg.jdbc.get("dim"):
        opts = cfg.jdbc["options"]
        stored = jdbc.read_table(spark, cfg.jdbc["dim"], opts, key="pid")
        jdbc.append_rows(op.dim_insert_rows(fresh, stored), cfg.jdbc["dim"], opts)
    with RunFolder(spark, "dim-rows") as run:
        rows = run.stage(op.new_keys_only(fresh, read_or_empty(spark, cfg.dim, DIM_SCHEMA, ["pId"])), "rows")
        append(rows, cfg.dim)


def published_facts(spark: SparkSession, cfg: FactJobConfig) -> DataFrame:
    """The fact table in whichever layout it has been published."""
    stored = [t for t in (cfg.bucketed_view, cfg.bucketed_table) if t and spark.catalog.tableExists(t)]
    if cfg.manifest_buckets:
        return manifest.read(spark, cfg.facts, ENRICHED_FACT_SCHEMA)
    if stored:      # whichever the fact mode in use has published
        return read_bucketed(spark, stored[0], ENRICHED_FACT_SCHEMA)
    if cfg.facts and current_version(spark, cfg.facts) is not None:
        return read_versioned(spark, cfg.facts, ENRICHED_FACT_SCHEMA)
    return read_or_empty(spark, cfg.facts, FACT_SCHEMA, ["pcode", "ver", "dognum", "prjname"])


def summary_sink(cfg: FactJobConfig | None) -> bool:
    """True if the summary of ``cfg`` is published anywhere."""
    return bool(cfg and (cfg.summary or cfg.jdbc and cfg.jdbc.get("summary")))


def run_summary(spark: SparkSession, cfg: FactJobConfig, named_only: bool = False,
                path: str | None = None) -> DataFrame:
    """Q5: counts per product, version and dongle over the published facts;
    written to ``path`` or ``cfg.summary`` (versioned) and / or the relational summary (K8).

    With ``summary_buckets`` the fact job has kept the counts up; no fact is read."""
    kept_up = cfg.manifest_buckets and cfg.summary_buckets and cfg.summary and not named_only and not path
    if kept_up:
        summary = manifest.read(spark, cfg.summary, SUMMARY_SCHEMA)
    else:
        summary, target = op.project_summary(published_facts(spark, cfg), named_only), path or cfg.summary
        if target:
            replace_table(summary, target)
            summary = read_versioned(spark, target, SUMMARY_SCHEMA)     # counted once, read by the next sink
    if cfg.jdbc and cfg.jdbc.get("summary"):
        with RunFolder(spark, "summary") as run:
            jdbc.replace_summary(run.stage(summary, "counts"), cfg.jdbc["summary"], cfg.jdbc["options"])
    return summary
