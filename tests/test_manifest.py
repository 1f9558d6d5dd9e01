"""Manifest tables: copy-on-write buckets, publishers from one base, appends, compaction, retention."""

import random

import pytest
from pyspark.sql import functions as F

from usagetally.session import exists, scratch_path
from usagetally.sources import manifest as mf
from usagetally.sources.files import create_once, read_text
from usagetally.sources.sinks import Conflict, current_version

SCHEMA = "k string, v long"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def add(batch, stored):
    return batch.unionByName(stored).groupBy("k").agg(F.sum("v").alias("v"))


def content(spark, root, schema):
    return sorted(tuple(r) for r in mf.read(spark, root, schema).collect())


@pytest.fixture()
def filled(spark):
    """A table of 64 buckets, every one with files."""
    root, schema = scratch_path(spark, "manifest"), table(spark, [("a", 1)]).schema
    rows = spark.range(2000).selectExpr("concat('k', id) as k", "id as v")
    assert mf.upsert(spark, root, rows, add, schema, ("k",), 64, "w1")
    return root, schema


def test_a_batch_rewrites_only_its_buckets(spark, filled):
    root, schema = filled
    before = mf.load(spark, root)
    assert {b for _, _, b in before.files} == set(range(64))
    assert mf.upsert(spark, root, table(spark, [("k7", 100)]), add, schema, ("k",), 64, "w2")
    after = mf.load(spark, root)
    touched = {b for _, _, b in set(before.files) ^ set(after.files)}
    assert len(touched) == 1 and len({b for _, _, b in set(before.files) & set(after.files)}) == 63
    got = dict(content(spark, root, schema))
    assert len(got) == 2000 and got["k7"] == 107 and got["k8"] == 8
    # the same window again does nothing, another one adds
    assert not mf.upsert(spark, root, table(spark, [("k7", 100)]), add, schema, ("k",), 64, "w2")
    assert mf.load(spark, root).files == after.files
    assert mf.upsert(spark, root, table(spark, [("k7", 1), ("new", 5)]), add, schema, ("k",), 64, "w3")
    assert dict(content(spark, root, schema))["k7"] == 108 and dict(content(spark, root, schema))["new"] == 5
    with pytest.raises(ValueError):
        mf.upsert(spark, root, table(spark, [("k7", 1)]), add, schema, ("k",), 32, "w4")


def test_second_of_two_publishers_from_one_base_conflicts(spark, filled):
    root, schema = filled
    one, two = (mf.prepare_upsert(spark, root, table(spark, [(k, 1)]), add, schema, ("k",), 64) for k in ("k1", "k2"))
    assert mf.publish_upsert(spark, root, one, "a")
    with pytest.raises(Conflict):
        mf.publish_upsert(spark, root, two, "b")
    assert not mf.publish_upsert(spark, root, one, "a")           # a replay of the first
    got = dict(content(spark, root, schema))
    assert got["k1"] == 2 and got["k2"] == 2                        # k2 is its first value, 2


def test_reads_of_some_buckets_open_no_other_file(spark, filled):
    root, schema = filled
    batch = table(spark, [("k1", 0), ("k2", 0)])
    buckets = mf.touched_buckets(batch, ("k",), 64)
    files = mf.read(spark, root, schema, buckets).inputFiles()
    assert 1 <= len(files) <= 2 and all(f"/bucket={b}/" in " ".join(files) for b in buckets)
    near = mf.matching(spark, root, schema, batch, ("k",), 64)
    assert {"k1", "k2"} <= {r.k for r in near.collect()} and near.count() < mf.read(spark, root, schema, buckets).count()
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(k,k1)" in plan and "LessThanOrEqual(k,k2)" in plan
    assert mf.matching(spark, root, schema, batch.limit(0), ("k",), 64).count() == 0


def test_appends_are_compacted_to_size_while_a_reader_goes_on(spark):
    root, schema = scratch_path(spark, "appends"), table(spark, [("a", 1)]).schema
    for day in range(30):
        assert mf.append(spark, root, spark.range(day * 100, day * 100 + 100).selectExpr("concat('k', id) as k", "id as v"), f"d{day}")
    assert not mf.append(spark, root, table(spark, [("k1", 1)]), "d3")           # a window that is there
    before, rows = mf.load(spark, root), content(spark, root, schema)
    assert len(before.files) >= 30 and len(rows) == 3000
    reader = mf.read(spark, root, schema)
    target = 3 * sum(size for _, size, _ in before.files) // 10
    assert mf.compact(spark, root, schema, target) == len(before.files)
    after = mf.load(spark, root)
    assert 4 <= len(after.files) < 10 and all(size <= target for _, size, _ in after.files)
    assert content(spark, root, schema) == rows and after.windows == before.windows
    assert sorted(tuple(r) for r in reader.collect()) == rows                 # its files are still there
    assert mf.compact(spark, root, schema, target) in (0, 2, 3, 4) and content(spark, root, schema) == rows
    assert mf.vacuum(spark, root, keep=1) and content(spark, root, schema) == rows
    assert not exists(spark, f"{root}/{before.files[0][0]}")


def test_compaction_keeps_buckets_and_gives_way(spark, filled, monkeypatch):
    root, schema = filled
    for n in range(3):
        mf.append(spark, root, spark.range(500).selectExpr(f"concat('n{n}-', id) as k", "id as v"), f"a{n}", ("k",), 64)
    rows = content(spark, root, schema)
    real = mf.data_files

    def overtaken(spark_, folder):       # an append and an upsert of a bucket while the small files are rewritten
        monkeypatch.setattr(mf, "data_files", real)
        mf.append(spark, root, table(spark, [("late", 1)]), "late", ("k",), 64)
        return real(spark_, folder)

    monkeypatch.setattr(mf, "data_files", overtaken)
    assert mf.compact(spark, root, schema) > 64
    assert content(spark, root, schema) == sorted([*rows, ("late", 1)])
    now = mf.load(spark, root)
    assert len(now.files) <= 65
    for bucket in (0, 17):
        found = mf.read(spark, root, schema, [bucket])
        assert found.where(mf.bucket_of(("k",), 64) != bucket).count() == 0 and found.count() > 0

    def replaced(spark_, folder):
        monkeypatch.setattr(mf, "data_files", real)
        mf.upsert(spark, root, table(spark, [("late", 1)]), add, schema, ("k",), 64, "up")
        return real(spark_, folder)

    mf.append(spark, root, table(spark, [("late", 5)]), "later", ("k",), 64)
    monkeypatch.setattr(mf, "data_files", replaced)
    with pytest.raises(Conflict):
        mf.compact(spark, root, schema)
    assert dict(content(spark, root, schema))["late"] == 7


def test_packing_is_bounded_and_whole():
    pick = random.Random(1)
    for _ in range(50):
        sizes = [(f"f{i}", pick.randrange(1, 120)) for i in range(pick.randrange(1, 60))]
        bins = mf.packed(sizes, 100)
        by = dict(sizes)
        assert sorted(f for b in bins for f in b) == sorted(by)
        assert all(sum(by[f] for f in b) <= 100 or len(b) == 1 for b in bins)
        # at most one bin is less than half full, but for files larger than a bin
        assert sum(sum(by[f] for f in b) <= 50 for b in bins) <= 1


def test_a_pointer_without_content_is_passed_over(spark, filled):
    root, schema = filled
    here = current_version(spark, root)
    create_once(spark, f"{root}/_CURRENT-{99:012d}", "")
    assert current_version(spark, root) == here and len(content(spark, root, schema)) == 2000
    assert mf.upsert(spark, root, table(spark, [("k7", 1)]), add, schema, ("k",), 64, "w9")
    assert dict(content(spark, root, schema))["k7"] == 8
    assert read_text(spark, f"{root}/missing") is None


def test_empty_tables(spark):
    root, schema = scratch_path(spark, "none"), table(spark, [("a", 1)]).schema
    assert content(spark, root, schema) == [] and mf.compact(spark, root, schema) == 0 and mf.vacuum(spark, root) == []
    assert mf.upsert(spark, root, table(spark, []), add, schema, ("k",), 8, "w")
    assert content(spark, root, schema) == [] and mf.load(spark, root).windows == ["w"]
