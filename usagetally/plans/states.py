"""A1 + B2 from stored partial aggregates: facts that any load day can be taken out of and put back.

Each load day leaves one mergeable state a fact key: for every attribute its latest
present value with the order that made it the latest, the first and last use, the
summed duration.  States are laid out ``mday=…/kb=…`` (key buckets).  A fact is the
merge of its states over all days, so what a corrected day changes is found without
the log of other days:

1. the day's states are computed anew, from that day's folder of the log alone;
2. its old states go, its new ones take their place (retraction);
3. the facts of the keys in either are merged from the states in their key buckets and
   replace the stored ones; a key without any state left loses its fact.

The result is that of a rebuild from the whole log (README, "Reruns").
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from usagetally import operators as op
from usagetally.operators.condense import fact_missing_map
from usagetally.plans.facts import FactJobConfig, merge_full
from usagetally.schemas import ENRICHED_FACT_SCHEMA, FACT_ATTRIBUTES, MISSING_NUMBER
from usagetally.session import exists
from usagetally.sources import manifest
from usagetally.sources.files import names_in, remove
from usagetally.sources.journal import Journal, once
from usagetally.sources.log import calendar_days, read_log
from usagetally.sources.sinks import RunFolder, replace_partitions

_ORDERED = StructType([StructField("ord", StringType()), StructField("value", StringType())])
STATE_SCHEMA = StructType(
    [StructField("pId", StringType())] + [StructField(c, _ORDERED) for c in FACT_ATTRIBUTES]
    + [StructField("first_open", StringType()), StructField("last_close", StringType()), StructField("total", DoubleType()),
       StructField("mday", IntegerType()), StructField("kb", IntegerType())])


@dataclass
class StateJobConfig:
    facts: FactJobConfig        # log, users, facts (a manifest table), manifest_buckets
    states: str                 # state table, mday=…/kb=…


def _latest(c: str, missing: str) -> Column:
    """The latest present value of a day with its order; null if there is none."""
    return F.max(F.when(F.col(c) != missing, F.struct(F.col("_ord").alias("ord"), F.col(c).alias("value")))).alias(c)


def day_states(log: DataFrame, cfg: FactJobConfig) -> DataFrame:
    """One state a load day and fact key, from log rows (aggregated before the shuffle)."""
    rows = op.fact_rows(op.product_filter(log, cfg.products), True, cfg.slash_rule, cfg.tiebreak, cfg.key_delimiter,
                        keep=(cfg.day_col,))
    missing = fact_missing_map()
    states = rows.groupBy(F.col(cfg.day_col).alias("mday"), "pId").agg(
        *[_latest(c, missing[c]) for c in FACT_ATTRIBUTES],
        F.min("receivetime").alias("first_open"), F.max("receivetime").alias("last_close"),
        F.sum(F.col("duration").try_cast("double")).alias("total"))
    return states.withColumn("kb", manifest.bucket_of(("pId",), cfg.manifest_buckets)).select(*STATE_SCHEMA.fieldNames())


def facts_of(states: DataFrame) -> DataFrame:
    """The 18-column facts of states of any days (A1-A5 of all their rows)."""
    missing = fact_missing_map()
    merged = states.groupBy("pId").agg(
        *[F.max(c).alias(c) for c in FACT_ATTRIBUTES], F.max("last_close").alias("last_close_datetime"),
        F.min("first_open").alias("first_open_datetime"), F.coalesce(F.sum("total"), F.lit(0.0)).cast("string").alias("total_duration"))
    value = {c: F.coalesce(F.col(c)["value"], F.lit(missing[c])) for c in FACT_ATTRIBUTES}
    return merged.select("pId", *[value[c].alias(c) for c in FACT_ATTRIBUTES], F.col("last_close_datetime").alias("receivetime"),
                         "first_open_datetime", "last_close_datetime", "total_duration",
                         F.coalesce(F.col("duration")["value"], F.lit(MISSING_NUMBER)).alias("last_long"))


def stored_states(spark: SparkSession, cfg: StateJobConfig, days: list[int] | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The states of some days and key buckets; both lists prune folders."""
    if not exists(spark, cfg.states):
        return spark.createDataFrame([], STATE_SCHEMA)
    found = spark.read.schema(STATE_SCHEMA).parquet(cfg.states)
    if days is not None:
        found = found.where(F.col("mday").isin(days))
    return found if buckets is None else found.where(F.col("kb").isin(buckets))


def load_days(spark: SparkSession, cfg: StateJobConfig, start: int, end: int,
              journal: Journal | None = None, window: str | None = None) -> dict:
    """Put the load days ``[start, end]`` in, for the first time or again; the facts then equal a rebuild.

    Reads the log of these days alone, the states in the key buckets that they touch, and
    rewrites the facts in those buckets."""
    facts, days, buckets = cfg.facts, calendar_days(start, end), cfg.facts.manifest_buckets

    def stage(folder: str) -> dict:
        log = read_log(spark, facts.log, start, end, facts.day_col, facts.log_schema)
        day_states(log, facts).write.parquet(f"{folder}/states")
        new = spark.read.schema(STATE_SCHEMA).parquet(f"{folder}/states")
        old = stored_states(spark, cfg, days)
        new.select("pId").union(old.select("pId")).distinct().write.parquet(f"{folder}/keys")
        return {"states": f"{folder}/states", "keys": f"{folder}/keys", "window": f"states-{start}-{end}-{uuid.uuid4().hex[:12]}"}

    def apply(staged: dict, again: bool) -> None:
        new = spark.read.schema(STATE_SCHEMA).parquet(staged["states"])
        keys = spark.read.schema("pId string").parquet(staged["keys"])
        fresh = {(r.mday, r.kb) for r in new.select("mday", "kb").distinct().collect()}     # folders: days x buckets
        replace_partitions(new, cfg.states, ("mday", "kb"))
        for d in days:                                          # key buckets that the day no longer has
            for name in names_in(spark, f"{cfg.states}/mday={d}"):
                if name.startswith("kb=") and (d, int(name[3:])) not in fresh:
                    remove(spark, f"{cfg.states}/mday={d}/{name}")
        if staged["window"] in manifest.load(spark, facts.facts).windows:
            return
        touched = manifest.touched_buckets(keys, ("pId",), buckets)
        with RunFolder(spark, "state-facts") as run:
            mine = stored_states(spark, cfg, None, touched).join(keys, "pId", "left_semi")
            merged = run.stage(facts_of(mine), "facts")
            lookup = run.stage(op.user_lookup(spark.read.parquet(facts.users)), "user-lookup")
            whole = merge_full(merged, lookup, spark.createDataFrame([], ENRICHED_FACT_SCHEMA))

            def replaced(batch: DataFrame, stored: DataFrame) -> DataFrame:
                return stored.join(batch, "pId", "left_anti").select(*stored.columns).unionByName(whole)

            manifest.upsert(spark, facts.facts, keys, replaced, ENRICHED_FACT_SCHEMA, ("pId",), buckets, staged["window"])

    intent = {"layout": "states", "target": cfg.states}
    if journal is not None:
        return journal.commit(window or f"{start}-{end}", intent, stage, apply)
    own = once(spark, "states")
    staged = own.commit(f"{start}-{end}", intent, stage, apply)
    remove(spark, own.root)
    return staged


def reprocess_day(spark: SparkSession, cfg: StateJobConfig, day: int) -> dict:
    """B2: take one corrected load day out and put it in again."""
    return load_days(spark, cfg, day, day)


__all__ = ["StateJobConfig", "day_states", "facts_of", "load_days", "reprocess_day", "stored_states"]
