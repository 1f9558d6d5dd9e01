"""Physical-plan properties that matter at scale."""

from usagetally import operators as op
from usagetally.plans.catalog import QUERIES

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_reaches_the_scan(spark):
    p = plan(QUERIES["fact_merge_left"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts," in p and "LessThan(ts," in p


def test_new_only_is_an_anti_join(spark):
    p = plan(QUERIES["fact_new_only"](spark, SF_SMALL))
    assert "LeftAnti" in p


def test_condense_aggregates_partially_before_the_shuffle(spark):
    p = QUERIES["fact_condense"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in p and "partial_min" in p


def test_no_python_in_any_plan(spark):
    for name, q in QUERIES.items():
        p = plan(q(spark, SF_SMALL))
        assert "EvalPython" not in p and "FlatMapGroupsInPandas" not in p, name


def test_missing_gids_are_dealt_over_the_shuffle(spark):
    """Facts without a gid are no hot key of the user join: with broadcasts off they fill many partitions."""
    from pyspark.sql import functions as F
    keep = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(1000).selectExpr("md5(cast(id as string)) as pId", "'N/A' as gid")
        users = spark.createDataFrame([("G1", 1, "n", "e", "m"), (None, 2, "x", None, "")],
                                      "gid string, user_id int, user_name string, email string, mobile string")
        got = op.enrich_users(facts, users)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 1000 and max(sizes) < 250
        assert got.where("user_name <> 'N/A'").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bucketed_history_is_not_shuffled(spark):
    import re
    import uuid

    from usagetally.plans import facts as fj
    from usagetally.plans.roundtrips import _fact_cfg
    from usagetally.schemas import ENRICHED_FACT_SCHEMA
    from usagetally.sources.fixtures import DAY_WINDOW, HISTORY_WINDOW
    from usagetally.sources.sinks import read_bucketed

    view = f"bk_{uuid.uuid4().hex[:8]}"
    cfg = _fact_cfg(spark, SF_SMALL, bucketed_view=view, buckets=8)
    fj.run_full(spark, cfg, *HISTORY_WINDOW, batch="h")
    hist = read_bucketed(spark, view, ENRICHED_FACT_SCHEMA)
    merged = fj.merge_full(fj.day_facts(spark, cfg, *DAY_WINDOW), op.user_lookup(spark.read.parquet(cfg.users)), hist)
    p = plan(merged)
    hist_ids = set(re.findall(r"FileScan parquet spark_catalog\.default\.%s_v\w+\[pId#(\d+)" % view, p))
    shuffled = set(re.findall(r"Exchange hashpartitioning\(pId#(\d+)", p))
    assert hist_ids and not (hist_ids & shuffled)


def test_unused_columns_are_not_read(spark):
    """``events.value`` is used by no query: no scan may read it."""
    scans = [line for line in plan(QUERIES["fact_condense"](spark, SF_SMALL)).splitlines()
             if "FileScan parquet" in line]
    assert scans and all("value#" not in line for line in scans), scans


def test_bucketed_append_history_is_not_shuffled(spark):
    import re
    import uuid

    from usagetally.operators import fact_new_only
    from usagetally.plans import facts as fj
    from usagetally.plans.roundtrips import _fact_cfg
    from usagetally.sources.fixtures import DAY_WINDOW, HISTORY_WINDOW

    table = f"bk_new_{uuid.uuid4().hex[:8]}"
    cfg = _fact_cfg(spark, SF_SMALL, bucketed_table=table, buckets=8)
    fj.run_new_only(spark, cfg, *HISTORY_WINDOW)
    hist = spark.table(table).select("pId")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:                      # a large history is never broadcast: plan as at scale
        spark.conf.set(k, "-1")
    try:
        df = fact_new_only(fj.day_facts(spark, cfg, *DAY_WINDOW, numeric_text_defaults=False), hist)
        df.write.format("noop").mode("overwrite").save()
        p = plan(df)
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hist_ids = set(re.findall(r"FileScan parquet spark_catalog\.default\.%s\[pId#(\d+)" % table, p))
    shuffled = set(re.findall(r"Exchange hashpartitioning\(pId#(\d+)", p))
    assert "SortMergeJoin" in p and "LeftAnti" in p
    assert hist_ids and not (hist_ids & shuffled)


def test_stored_log_window_prunes_and_pushes(spark):
    from usagetally.operators import fact_condense
    from usagetally.session import scratch_path
    from usagetally.sources.fixtures import DAY_WINDOW, load_userlog
    from usagetally.sources.log import read_log

    log = load_userlog(spark, SF_SMALL)
    by_day, flat = scratch_path(spark, "log-by-day"), scratch_path(spark, "log-flat")
    log.write.partitionBy("mday").parquet(by_day)
    log.write.parquet(flat)
    p = plan(fact_condense(read_log(spark, by_day, *DAY_WINDOW)))
    assert "PartitionFilters: [isnotnull(mday" in p and f"(mday#" in p and "20240121" in p
    p = plan(fact_condense(read_log(spark, flat, *DAY_WINDOW)))
    assert "GreaterThanOrEqual(mday,20240121)" in p and "LessThanOrEqual(mday,20240130)" in p


def test_hot_gid_is_split(spark):
    """Most facts on one gid, broadcasts off: the enriching join has a skewed side that is split."""
    keep = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"}
    before = {k: spark.conf.get(k, None) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(200_000, numPartitions=8).selectExpr(
            "md5(cast(id as string)) as pId", "case when id % 20 > 0 then 'G1' when id % 40 = 0 then 'N/A' else concat('G', id) end as gid")
        users = spark.range(50).selectExpr("concat('G', id) as gid", "id as user_id", "concat('n', id) as user_name",
                                           "'e' as email", "'m' as mobile")
        got = op.enrich_users(facts, users)
        assert sum(r["count"] for r in got.groupBy("user_name").count().collect() if r.user_name == "n1") >= 190_000
        got.write.format("noop").mode("overwrite").save()
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
