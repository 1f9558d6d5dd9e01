from usagetally.operators import fact_merge_full, fact_merge_left, fact_new_only, usage_merge, insert_flag
from usagetally.schemas import ENRICHED_FACT_COLUMNS, PROJECT_USAGE_COLUMNS


def fact(spark, **kw):
    base = {c: "N/A" for c in ENRICHED_FACT_COLUMNS}
    base.update(pId="k1", first_open_datetime="2016/07/05", last_close_datetime="2016/07/05",
                total_duration="4", last_long="4", user_id="N/A", dognum="D1")
    base.update(kw)
    return spark.createDataFrame([tuple(base[c] for c in ENRICHED_FACT_COLUMNS)],
                                 ", ".join(f"{c} string" for c in ENRICHED_FACT_COLUMNS))


def test_full_merge_both_sides(spark):
    day = fact(spark, ver="N/A", user_id="N/A")
    hist = fact(spark, first_open_datetime="2016/07/01", last_close_datetime="2016/07/02",
                total_duration="3", ver="v1", user_id="u1")
    r = fact_merge_full(day, hist, with_insert_flag=True).first()
    assert r.first_open_datetime == "2016/07/01" and r.last_close_datetime == "2016/07/05"
    assert float(r.total_duration) == 7.0
    assert r.user_id == "u1"          # user missing today → history
    assert r.ver == "N/A"             # attribute missing today → today's N/A
    assert r.is_insert == 0


def test_full_merge_one_side(spark):
    day = fact(spark, pId="new", gid="N/A37")
    hist = fact(spark, pId="old")
    got = {r.pId: (r.is_insert, r.gid) for r in fact_merge_full(day, hist, True).collect()}
    assert got == {"new": (1, "N/A"), "old": (0, "N/A")}
    flags = {r.pId: r.is_insert for r in insert_flag(day, hist).collect()}
    assert flags == {"new": 1, "old": 0}


def test_first_run_has_no_history(spark):
    day = fact(spark)
    empty = day.limit(0)
    assert fact_merge_full(day, empty).count() == 1
    assert fact_new_only(day.select(*ENRICHED_FACT_COLUMNS[:18]), empty).count() == 1


def test_left_merge_widens_times(spark):
    day = fact(spark)
    hist = fact(spark, first_open_datetime="2016/07/01", last_close_datetime="N/A")
    r = fact_merge_left(day, hist).first()
    assert (r.first_open_datetime, r.last_close_datetime, r.is_insert) == ("2016/07/01", "2016/07/05", 0)


def test_new_only_needs_dongle(spark):
    day = fact(spark, pId="a").unionByName(fact(spark, pId="b", dognum="N/A"))
    hist = fact(spark, pId="zzz")
    assert [r.pId for r in fact_new_only(day.select(*ENRICHED_FACT_COLUMNS[:18]), hist).collect()] == ["a"]


def usage(spark, key, t, count, name, day="20160719"):
    vals = dict(key=key, tmday=day, pcode="11036", projectid="P", prjname=name, dognum="D", gid="G",
                hardwareid="H", fncode="1", fnname="f", count=count, trigertime=t)
    return spark.createDataFrame([tuple(vals[c] for c in PROJECT_USAGE_COLUMNS)],
                                 ", ".join(f"{c} {'int' if c == 'count' else 'string'}" for c in PROJECT_USAGE_COLUMNS))


def test_usage_merge_rules(spark):
    # history newer → history attributes, counts summed
    r = usage_merge(usage(spark, "k", "2016/07/19 01", 2, "day"), usage(spark, "k", "2016/07/19 09", 5, "hist")).first()
    assert (r.prjname, r["count"]) == ("hist", 7)
    # equal times → today's attributes
    r = usage_merge(usage(spark, "k", "t", 2, "day"), usage(spark, "k", "t", 5, "hist")).first()
    assert (r.prjname, r["count"]) == ("day", 7)
    # history only → unchanged
    r = usage_merge(usage(spark, "a", "t", 2, "day"), usage(spark, "b", "t", 5, "hist"))
    got = {x.key: (x.prjname, x["count"], x.tmday) for x in r.collect()}
    assert got == {"a": ("day", 2, "20160719"), "b": ("hist", 5, "20160719")}
