from pyspark.sql import functions as F

from usagetally.schemas import FACT_SCHEMA, PROJECT_USAGE_SCHEMA
from usagetally.session import scratch_path
from usagetally.sources.log import read_or_empty, usage_history
from usagetally.sources.sinks import append, current_version, read_versioned, replace_partitions, replace_table

from .test_merge import usage


def test_first_run_reads_empty(spark):
    p = scratch_path(spark, "absent")
    df = read_or_empty(spark, p, FACT_SCHEMA)
    assert df.count() == 0 and df.schema == FACT_SCHEMA


def test_partition_replace_keeps_other_days(spark):
    p = scratch_path(spark, "usage")
    a = usage(spark, "a", "t", 1, "x", day="20240101")
    b = usage(spark, "b", "t", 2, "x", day="20240102")
    replace_partitions(a.unionByName(b), p)
    replace_partitions(usage(spark, "c", "t", 9, "y", day="20240102"), p)
    got = sorted((r.key, r.tmday) for r in spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(p).collect())
    assert got == [("a", "20240101"), ("c", "20240102")]
    # the day column is read back as text; limiting to a day prunes partitions
    days = spark.createDataFrame([("20240102",)], "tmday string")
    h = usage_history(spark, p, PROJECT_USAGE_SCHEMA, days)
    assert [r.key for r in h.collect()] == ["c"]
    assert "PartitionFilters: [isnotnull(tmday" in h._jdf.queryExecution().executedPlan().toString() or \
        "tmday IN" in h._jdf.queryExecution().executedPlan().toString()
    # a long list of days still prunes at planning time
    many = spark.range(5000).selectExpr("date_format(date_add(date'2010-01-01', cast(id as int)), 'yyyyMMdd') as tmday")
    h2 = usage_history(spark, p, PROJECT_USAGE_SCHEMA, many.union(days))
    assert [r.key for r in h2.collect()] == ["c"]
    assert "PartitionFilters: [isnotnull(tmday" in h2._jdf.queryExecution().executedPlan().toString() or \
        "tmday" in h2._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_versioned_replace_is_rerunnable(spark):
    root = scratch_path(spark, "facts")
    df1 = spark.createDataFrame([("k1",) + ("x",) * 17], FACT_SCHEMA)
    replace_table(df1, root, "1")
    v1 = current_version(spark, root)
    # read the current version and publish a new one derived from it
    cur = read_versioned(spark, root, FACT_SCHEMA)
    replace_table(cur.withColumn("ver", F.lit("v2")), root, "2")
    assert current_version(spark, root) != v1
    assert [r.ver for r in read_versioned(spark, root, FACT_SCHEMA).collect()] == ["v2"]
    # the old version is still intact for readers that hold it
    assert spark.read.parquet(v1).count() == 1


def test_append_partitioned(spark):
    p = scratch_path(spark, "byproduct")
    df = spark.createDataFrame([("k1", "11036"), ("k2", "20001")], "pId string, pcode string")
    append(df, p, partition_by=["pcode"])
    append(df, p, partition_by=["pcode"])
    assert spark.read.parquet(p).count() == 4


def test_prune_keeps_the_newest_versions(spark):
    from usagetally.sources.sinks import prune_versions
    root = scratch_path(spark, "pruned")
    df = spark.createDataFrame([("k1",) + ("x",) * 17], FACT_SCHEMA)
    for b in ("1", "2", "3", "4"):
        replace_table(df.withColumn("ver", F.lit(b)), root, b)
    removed = prune_versions(spark, root, keep=2)
    assert len(removed) == 2
    assert [r.ver for r in read_versioned(spark, root, FACT_SCHEMA).collect()] == ["4"]
    replace_table(df.withColumn("ver", F.lit("5")), root, "5")      # publishing continues
    assert [r.ver for r in read_versioned(spark, root, FACT_SCHEMA).collect()] == ["5"]


def test_prune_bucketed_versions(spark):
    import uuid

    from usagetally.sources.sinks import prune_bucketed, read_bucketed, replace_bucketed
    view = f"pv_{uuid.uuid4().hex[:8]}"
    root = scratch_path(spark, "bk")
    df = spark.createDataFrame([("k1",) + ("x",) * 17], FACT_SCHEMA)
    for b in ("1", "2", "3"):
        replace_bucketed(df.withColumn("ver", F.lit(b)), view, root, 4, batch=b)
    assert len(prune_bucketed(spark, view, keep=1)) == 2
    assert [r.ver for r in read_bucketed(spark, view, FACT_SCHEMA).collect()] == ["3"]


def _failing(df):
    """The same rows, but the write job fails in its tasks (ANSI cast error)."""
    return df.withColumn("ver", F.expr("cast(concat('x', ver) as int)").cast("string"))


def test_failed_publish_keeps_the_current_version(spark):
    import pytest
    root = scratch_path(spark, "failing")
    df = spark.createDataFrame([("k1",) + ("x",) * 17], FACT_SCHEMA)
    replace_table(df.withColumn("ver", F.lit("good")), root, "1")
    with pytest.raises(Exception):
        replace_table(_failing(df), root, "2")
    assert [r.ver for r in read_versioned(spark, root, FACT_SCHEMA).collect()] == ["good"]


def test_failed_partition_replace_keeps_old_days(spark):
    import pytest
    p = scratch_path(spark, "usage-failing")
    replace_partitions(usage(spark, "a", "t", 1, "x", day="20240101"), p)
    bad = usage(spark, "b", "t", 2, "y", day="20240101").withColumn(
        "prjname", F.expr("cast(concat('x', prjname) as int)").cast("string"))
    with pytest.raises(Exception):
        replace_partitions(bad, p)
    got = [(r.key, r.prjname) for r in spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(p).collect()]
    assert got == [("a", "x")]
