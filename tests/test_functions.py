import datetime as dt

from pyspark.sql import functions as F

from usagetally.functions import day_from_time, hash_key, name_from_path, next_day, strip_backslashes, yesterday
from usagetally.functions.times import clean_trigger_time, time_to_millis


PATHS = [
    ("E:\\2016年项目\\地库\\华南城地库土建.GCL10", "华南城地库土建.GCL10"),
    ("C:\\a\\b\\", "b"),
    ("\\\\srv\\share\\x", "\\\\srv\\share\\x"),
    ("/home/u/x", "/home/u/x"),
    ("a/b/c//", "c"),
    ("C:\\d/x\\y", "y"),
    ("\\abc/def\\ghi", "defghi"),
    ("plain", "plain"),
    ("E:\\dir\\proj3.GCL10", "proj3.GCL10"),
    ("a/b/proj4", "proj4"),
    ("a\\\\b", "b"),
]


def test_name_from_path(spark):
    df = spark.createDataFrame(PATHS, "p string, want string")
    got = df.select("want", name_from_path("p").alias("got")).collect()
    for r in got:
        assert r.got == r.want


def test_backslash_only_variant(spark):
    df = spark.createDataFrame([("C:\\d/x\\y",), ("a/b/c",)], "p string")
    got = [r[0] for r in df.select(name_from_path("p", slash_rule=False)).collect()]
    assert got == ["y", "a/b/c"]


def test_strip_backslashes(spark):
    df = spark.createDataFrame([("a\\b\\c",), ("\\ab",), ("ab",)], "p string")
    assert [r[0] for r in df.select(strip_backslashes("p")).collect()] == ["abc", "\\ab", "ab"]


def test_trigger_day(spark):
    cases = [("2016/07/19 15:11:49", "20160719"), ("2016-07-19", "20160719"),
             ("2016年07月19日 15:11", "20160719"), ("20160719", "20160719"),
             (None, "20850101"), ("", "20850101"), ("N/A", "20850101"), ("junk", "20850101")]
    df = spark.createDataFrame(cases, "t string, want string")
    for r in df.select("want", day_from_time("t").alias("got")).collect():
        assert r.got == r.want


def test_clean_trigger_time(spark):
    df = spark.createDataFrame([("2016年07月19日 15:11",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(clean_trigger_time("t")).collect()] == ["20160719 15:11", "N/A", ""]


def test_hash_key_matches_md5_of_concat(spark):
    import hashlib
    df = spark.createDataFrame([("11036", "D1", "P2-3", "华南城")], "a string, b string, c string, d string")
    got = df.select(hash_key("a", "b", "c", "d")).first()[0]
    assert got == hashlib.md5("11036D1P2-3华南城".encode()).hexdigest()
    # a NULL part is written as the text "null", never a NULL key
    df2 = spark.createDataFrame([("x", None)], "a string, b string")
    assert df2.select(hash_key("a", "b")).first()[0] == hashlib.md5(b"xnull").hexdigest()


def test_next_day_and_yesterday(spark):
    df = spark.createDataFrame([(20161231,), (20160228,)], "d int")
    assert [r[0] for r in df.select(next_day("d")).collect()] == [20170101, 20160229]
    one = spark.range(1)
    assert one.select(yesterday(dt.date(2017, 1, 5))).first()[0] == 20170104


def test_time_to_millis(spark):
    df = spark.createDataFrame([("2016/07/19 15:11:49 123",), ("bad",)], "t string")
    got = [r[0] for r in df.select(time_to_millis("t")).collect()]
    assert got[0] == 1468941109123 and got[1] is None


def test_no_python_udfs_in_plans(spark):
    df = spark.createDataFrame(PATHS, "p string, want string").select(name_from_path("p"), day_from_time("p"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    _ = F


def test_value_helpers(spark):
    from usagetally.functions import (
        fill_missing_text,
        keep_unless_missing,
        missing_to,
        number_text,
        present_or_null,
        sum_as_text,
        to_number,
    )
    df = spark.createDataFrame([("3", "4", None, "N/A", 7), ("x", "5.100", "", "u1", None)],
                               "a string, b string, c string, d string, n int")
    got = df.select(
        sum_as_text("a", "b").alias("s"),                 # F8: unparsable counts as 0
        to_number("b").alias("b"),                        # F17
        fill_missing_text("c").alias("c"),                # P5/P6
        fill_missing_text("c", empty_is_missing=False).alias("c2"),
        present_or_null("d").alias("d"),
        keep_unless_missing("d", "a").alias("k"),         # F16
        missing_to("d", "0").alias("z"),                  # P7
        number_text("n").alias("n"),                      # F7
    ).collect()
    assert [tuple(r) for r in got] == [
        ("7.0", 4.0, "N/A", "N/A", None, "3", "0", "7"),
        ("5.1", 5.1, "N/A", "", "u1", "u1", "u1", "0"),
    ]
