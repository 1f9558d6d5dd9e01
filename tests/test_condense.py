import random

from usagetally.operators import fact_condense, usage_condense, valid_actions, users_by_gid, enrich_users
from usagetally.schemas import LOG_SCHEMA

from .conftest import rows

BASE = dict(mday=20240101, pcode="11036", gid="G1", dognum="D1", ver="v1", projectid="P1",
            prjname="n1", prjfullpath="N/A", prjcost="5", prjsize="6", major="m", duration="10",
            utype="u", receivetime="2016/07/01 00:00:01", hardwareid="H", fncode=1, fnname="f",
            trigertime="2016/07/01 00:00:01")


def log(spark, specs):
    out = []
    for i, s in enumerate(specs):
        r = dict(BASE)
        r.update(s)
        out.append(tuple([r[f.name] for f in LOG_SCHEMA.fields] + [i]))
    schema = LOG_SCHEMA.simpleString()[len("struct<"):-1] + ",seq:bigint"
    return spark.createDataFrame(out, schema)


def test_valid_filter(spark):
    df = log(spark, [
        dict(projectid="", prjname="", prjfullpath=""),
        dict(projectid=None, prjname=None, prjfullpath=None),
        dict(projectid="N/A", prjname="N/A", prjfullpath="N/A"),
        dict(projectid="N/A", prjname=None, prjfullpath="x"),
    ])
    assert valid_actions(df).count() == 2
    # the kept all-empty row is filled with N/A and condensed
    facts = fact_condense(df)
    assert ("N/A", "N/A") in rows(facts, "projectid", "prjname")


def test_latest_non_missing_and_measures(spark):
    df = log(spark, [
        dict(receivetime="2016/07/01 00:00:01", ver="A", major="N/A", duration="3"),
        dict(receivetime="2016/07/01 00:00:02", ver="N/A", major="x", duration="N/A"),
        dict(receivetime="2016/07/01 00:00:03", ver="B", major="N/A", duration="4"),
    ])
    f = fact_condense(df).first()
    assert (f.ver, f.major) == ("B", "x")
    assert f.first_open_datetime == "2016/07/01 00:00:01"
    assert f.last_close_datetime == "2016/07/01 00:00:03" == f.receivetime
    assert f.total_duration == "7.0"
    assert f.last_long == "4" and f.duration == "4"


def test_order_independence(spark):
    specs = [dict(receivetime=f"2016/07/0{1 + i % 3} 00:00:0{i % 2}", ver=random.choice(["A", "B", "N/A", ""]),
                  gid=random.choice(["G1", "G2", None]), duration=str(i)) for i in range(30)]
    base = rows(fact_condense(log(spark, specs)))
    df = log(spark, specs)
    shuffled = df.repartition(7).orderBy(df.seq.desc())
    assert rows(fact_condense(shuffled)) == base


def test_name_derived_from_path_goes_into_key(spark):
    df = log(spark, [dict(prjname="N/A", prjfullpath="E:\\d\\x.GCL10"), dict(prjname="x.GCL10")])
    facts = fact_condense(df)
    assert facts.count() == 1 and facts.first().prjname == "x.GCL10"


def test_usage_condense_counts_and_names(spark):
    df = log(spark, [
        dict(trigertime="2016/07/19 10:00:00", fnname="a"),
        dict(trigertime="2016/07/19 11:00:00", fnname="N/A"),
        dict(trigertime="2016年07月19日 09:00", fnname="b", fncode=2),
        dict(trigertime=None, fnname="c"),
        dict(trigertime="", fnname="d"),
        dict(pcode="999", trigertime="2016/07/19 10:00:00"),
    ])
    u = usage_condense(df)
    got = {(r.tmday, r.fncode): (r["count"], r.fnname, r.trigertime) for r in u.collect()}
    assert got[("20160719", "1")] == (2, "a", "2016/07/19 11:00:00")
    # CJK marks are removed from the kept time; the day is still found
    assert got[("20160719", "2")] == (1, "b", "20160719 09:00")
    # NULL and '' trigger times share the sentinel day; fill gives 'N/A' to NULL
    assert got[("20850101", "1")][0] == 2


def test_enrich_gid_then_user_id(spark):
    users = spark.createDataFrame(
        [("G1", 7, "ann", None, ""), ("G1", 8, "bob", "b@x", "1"), ("X", 5, "cy", "c@x", None)],
        "gid string, user_id bigint, user_name string, email string, mobile string")
    assert rows(users_by_gid(users), "gid", "user_id", "user_name") == [("G1", "8", "bob"), ("X", "5", "cy")]
    facts = fact_condense(log(spark, [dict(gid="G1"), dict(gid="5", projectid="P2"), dict(gid="N/A", projectid="P3"),
                                      dict(gid="nobody", projectid="P4")]))
    got = {r.gid: (r.user_id, r.user_name, r.mobile) for r in enrich_users(facts, users).collect()}
    assert got["G1"] == ("8", "bob", "1")
    assert got["5"] == ("5", "cy", "N/A")
    assert got["N/A"] == ("N/A", "N/A", "N/A")
    assert got["nobody"] == ("N/A", "N/A", "N/A")
