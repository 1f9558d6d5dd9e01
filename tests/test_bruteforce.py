"""Spark operators against a plain-Python model of the reducer rules on
random rows (hypothesis).  The model follows the rules literally: Java-style
``split`` for names, a fold in ascending (time, id) order for attributes."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from usagetally.operators import fact_condense, usage_condense
from usagetally.schemas import FACT_ATTRIBUTES, LOG_SCHEMA

TEXT = st.one_of(st.none(), st.sampled_from(["", "N/A", "0", "x"]),
                 st.text(alphabet="ab\\/年.", min_size=1, max_size=7))
TIME = st.sampled_from(["2016/07/01 00:00:01", "2016/07/01 00:00:02", "2016/07/02 10:00:00",
                        "2016年07月03日 09:00", "", None])
ROW = st.fixed_dictionaries({
    "pcode": st.sampled_from(["11036", "-103000", None]), "gid": TEXT, "dognum": st.sampled_from(["D1", "", None]),
    "ver": TEXT, "projectid": st.sampled_from(["P1", "N/A", "", None]), "prjname": TEXT, "prjfullpath": TEXT,
    "prjcost": TEXT, "prjsize": TEXT, "major": TEXT, "duration": st.sampled_from(["1", "2.5", "N/A", "", None, "abc"]),
    "utype": TEXT, "receivetime": TIME, "fnname": TEXT, "trigertime": TIME,
    "fncode": st.sampled_from([1, 2, None]), "hardwareid": st.sampled_from(["H1", "H2"]),
})


def split_last(s, sep):
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts[-1]


def name_from_path(p):
    if p.find("\\") > 0:
        p = split_last(p, "\\")
    if p.find("/") > 0:
        p = split_last(p, "/")
    if p.find("\\") > 0:
        p = p.replace("\\", "")
    return p


def model_facts(rows):
    def ne(v):                      # SQL: v <> 'N/A' is unknown for NULL
        return v is not None and v != "N/A"
    groups = {}
    for i, r in enumerate(rows):
        if not (ne(r["projectid"]) or ne(r["prjname"]) or ne(r["prjfullpath"])):
            continue
        f = {c: ("N/A" if r[c] in (None, "") else r[c]) for c in FACT_ATTRIBUTES + ["receivetime"]}
        if f["prjname"] == "N/A" and f["prjfullpath"] != "N/A":
            f["prjname"] = name_from_path(f["prjfullpath"])
        for c in ("prjcost", "prjsize", "duration"):
            f[c] = "0" if f[c] == "N/A" else f[c]
        key = hashlib.md5((f["pcode"] + f["dognum"] + f["projectid"] + f["prjname"]).encode()).hexdigest()
        groups.setdefault(key, []).append((f["receivetime"], i, f))
    out = {}
    for key, items in groups.items():
        items.sort(key=lambda t: (t[0].encode(), t[1]))
        missing = {c: "N/A" for c in FACT_ATTRIBUTES}
        missing.update(prjcost="0", prjsize="0", duration="0")
        res = {c: missing[c] for c in FACT_ATTRIBUTES}
        total = 0.0
        for _, _, f in items:
            for c in FACT_ATTRIBUTES:
                if f[c] != missing[c]:
                    res[c] = f[c]
            try:
                total += float(f["duration"])
            except ValueError:
                pass
        times = [t for t, _, _ in items]
        res.update(first=min(times, key=str.encode), last=max(times, key=str.encode), total=total,
                   last_long=res["duration"])
        out[key] = res
    return out


def to_df(spark, rows):
    cols = [f.name for f in LOG_SCHEMA.fields]
    data = [tuple(20240101 if c == "mday" else r.get(c) for c in cols) + (i,) for i, r in enumerate(rows)]
    schema = LOG_SCHEMA.simpleString()[len("struct<"):-1] + ",seq:bigint"
    return spark.createDataFrame(data, schema)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=25))
def test_fact_condense_matches_model(spark, rows):
    got = {r.pId: r for r in fact_condense(to_df(spark, rows)).collect()}
    want = model_facts(rows)
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert [g[c] for c in FACT_ATTRIBUTES] == [w[c] for c in FACT_ATTRIBUTES]
        assert (g.first_open_datetime, g.last_close_datetime) == (w["first"], w["last"])
        assert float(g.total_duration) == w["total"] and g.last_long == w["last_long"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=25))
def test_usage_counts_match_model(spark, rows):
    import re
    got = {}
    for r in usage_condense(to_df(spark, rows)).collect():
        k = (r.tmday, r.gid, r.fncode)       # rows differing only in other key columns: summed
        got[k] = got.get(k, 0) + r["count"]
    want = {}
    for r in rows:
        if r["pcode"] not in ("11036", "-103000", "-103001"):
            continue
        t = (r["trigertime"] or "").replace("年", "").replace("月", "").replace("日", "")
        m = re.match(r"^([0-9]{4})[^0-9]?([0-9]{2})[^0-9]?([0-9]{2})", t)
        day = "".join(m.groups()) if m else "20850101"
        k = (day, "N/A" if r["gid"] is None else r["gid"], str(r["fncode"] or 0))
        want[k] = want.get(k, 0) + 1
    assert got == want


USER = st.tuples(st.sampled_from(["G1", "G2", "7", "N/A"]), st.sampled_from([7, 8, 12]),
                 st.sampled_from(["ann", "bob", "", None]), st.sampled_from(["a@x", None, ""]),
                 st.sampled_from(["1", "2", "", None]))


def model_enrich(users, gids):
    def per(key_idx, cols):
        out = {}
        for u in set(users):                          # distinct rows; max ignores duplicates anyway
            k = str(u[key_idx]) if key_idx == 1 else u[key_idx]
            row = {"user_id": str(u[1]), "user_name": u[2], "email": u[3], "mobile": u[4]}
            cur = out.setdefault(k, {c: None for c in cols})
            for c in cols:
                if row[c] is not None and (cur[c] is None or row[c].encode() > cur[c].encode()):
                    cur[c] = row[c]
        return out
    by_gid = per(0, ["user_id", "user_name", "email", "mobile"])
    by_id = per(1, ["user_name", "email", "mobile"])
    res = {}
    for g in gids:
        u = by_gid.get(g, {}) if g != "N/A" else {}
        d = by_id.get(g, {}) if g != "N/A" else {}
        vals = {"user_id": u.get("user_id") if u.get("user_id") is not None else (g if g in by_id else None)}
        for c in ("user_name", "email", "mobile"):
            vals[c] = u.get(c) if u.get(c) is not None else d.get(c)
        res[g] = tuple("N/A" if v in (None, "") else v for v in
                       (vals["user_id"], vals["user_name"], vals["email"], vals["mobile"]))
    return res


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(USER, min_size=0, max_size=12))
def test_enrich_matches_model(spark, users):
    from usagetally.operators import enrich_users
    gids = ["G1", "G2", "7", "8", "N/A", "zz"]
    facts = spark.createDataFrame([(f"k{i}", g) for i, g in enumerate(gids)], "pId string, gid string")
    udf = spark.createDataFrame(users, "gid string, user_id bigint, user_name string, email string, mobile string")
    got = {r.gid: (r.user_id, r.user_name, r.email, r.mobile) for r in enrich_users(facts, udf).collect()}
    assert got == model_enrich(users, gids)
