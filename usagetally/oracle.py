"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement is self-contained: it rebuilds the derived usage log and user
dimension from the pre-registered ``events`` and ``customer`` views with the
same rules as ``usagetally.sources.fixtures`` and then computes one result.
The SQL is written independently of the Spark code, from the operator
rules, so that the two can disagree.
"""

from __future__ import annotations

K = "cast(json_extract_string(props, '$.k') as int)"
FMT = "strftime(ts, '%Y/%m/%d %H:%M:%S')"


def _name_from_path(p: str) -> str:
    p1 = f"(case when instr({p}, '\\') > 1 then regexp_extract({p}, '([^\\\\]+)\\\\*$', 1) else {p} end)"
    p2 = f"(case when instr({p1}, '/') > 1 then regexp_extract({p1}, '([^/]+)/*$', 1) else {p1} end)"
    return f"(case when instr({p2}, '\\') > 1 then replace({p2}, '\\', '') else {p2} end)"


def _name_backslash_only(p: str) -> str:
    return f"(case when instr({p}, '\\') > 1 then regexp_extract({p}, '([^\\\\]+)\\\\*$', 1) else {p} end)"


def _strip(p: str) -> str:
    return f"(case when instr({p}, '\\') > 1 then replace({p}, '\\', '') else {p} end)"


def _fill(c: str) -> str:
    return f"(case when {c} is null or {c} = '' then 'N/A' else {c} end)"


def _latest(c: str, missing: str = "N/A", ord_: str = "ord") -> str:
    return f"coalesce(arg_max({c}, {ord_}) filter (where {c} <> '{missing}'), '{missing}')"


_DAY_RE = "'^([0-9]{4})[^0-9]?([0-9]{1,2})[^0-9]?([0-9]{1,2})'"


def _day(t: str) -> str:
    y, m, d = (f"regexp_extract({t}, {_DAY_RE}, {i})" for i in (1, 2, 3))
    return f"coalesce(strftime(try_cast({y} || '-' || {m} || '-' || {d} as date), '%Y%m%d'), '20850101')"


USERLOG = f"""
userlog AS (
 select event_id as seq, cast(strftime(ts, '%Y%m%d') as int) as mday,
  case event_type when 'click' then '11036' when 'view' then '-103000' when 'purchase' then '-103001'
   when 'signup' then '20001' else '20002' end as pcode,
  case when event_id % 31 = 0 then 'N/A7' else case user_id % 10 when 0 then 'N/A' when 1 then cast(user_id % 15 as varchar) when 2 then ''
   when 3 then cast(null as varchar) else concat('G', cast(user_id % 15 as varchar)) end end as gid,
  case when {K} % 7 = 0 then 'N/A' else concat('D', cast({K} % 5 as varchar)) end as dognum,
  case when event_id % 4 = 0 then '' else concat('v', cast(event_id % 3 as varchar)) end as ver,
  case when {K} % 3 = 0 then 'N/A'
   else concat('P', cast({K} % 20 as varchar), '-', cast(cast(strftime(ts, '%d') as int) % 16 as varchar)) end as projectid,
  case when event_id % 23 = 0 then concat('tmp', cast({K} % 10 as varchar)) else
   case {K} % 4 when 0 then 'N/A' when 1 then '' else concat('name', cast({K} % 10 as varchar)) end end as prjname,
  case {K} % 6 when 0 then 'N/A' when 1 then concat('E:\\dir\\proj', cast({K} % 10 as varchar), '.GCL10')
   when 2 then concat('a/b/proj', cast({K} % 10 as varchar))
   when 3 then concat('\\\\srv\\share\\p', cast({K} % 10 as varchar)) when 4 then cast(null as varchar)
   else concat('C:\\d/x\\y', cast({K} % 10 as varchar)) end as prjfullpath,
  case when event_id % 5 = 0 then cast(null as varchar) else cast(event_id % 1000 as varchar) end as prjcost,
  case when event_id % 6 = 0 then '' else cast(event_id % 900 as varchar) end as prjsize,
  case when event_id % 3 = 0 then 'N/A' else concat('m', cast(event_id % 4 as varchar)) end as major,
  case when event_id % 8 = 0 then 'N/A' when event_id % 29 = 0 then '12s' else cast(event_id % 600 as varchar) end as duration,
  case when event_id % 9 = 0 then cast(null as varchar) else concat('u', cast(event_id % 2 as varchar)) end as utype,
  {FMT} as receivetime,
  concat('H', cast(user_id % 3 as varchar)) as hardwareid,
  case when {K} % 11 = 0 then cast(null as int) else cast({K} % 4 as int) end as fncode,
  case when event_id % 7 = 0 then 'N/A' else concat('fn', cast(event_id % 5 as varchar)) end as fnname,
  case event_id % 13 when 0 then cast(null as varchar) when 1 then '' when 2 then strftime(ts, '%Y年%-m月%-d日 %H:%M:%S')
   when 3 then strftime(ts, '%Y%m%d') when 4 then '2024/13/41 08:00:00' else {FMT} end as trigertime
 from events),
day_log AS (select * from userlog where mday between 20240121 and 20240130),
hist_log AS (select * from userlog where mday between 20240101 and 20240120),
users AS (
 select concat('G', cast(c_custkey as varchar)) as gid, c_custkey as user_id, c_name as user_name,
  case when c_custkey % 4 = 0 then cast(null as varchar) else concat('u', cast(c_custkey as varchar), '@example.com') end as email,
  case when c_custkey % 6 = 0 then '' else concat('138', lpad(cast(c_custkey as varchar), 8, '0')) end as mobile
 from customer
 union all
 select concat('G', cast(c_nationkey as varchar)), c_custkey, concat(c_name, '-b'), cast(null as varchar), cast(null as varchar)
 from customer),
dim_user AS (select distinct gid, cast(user_id as varchar) as user_id, user_name, email, mobile from users),
dim_u AS (select gid, max(user_id) as user_id, max(user_name) as user_name, max(email) as email, max(mobile) as mobile
 from dim_user group by gid),
dim_du AS (select user_id, max(user_name) as user_name, max(email) as email, max(mobile) as mobile
 from dim_user group by user_id)"""

FACT_COLS = ["pcode", "gid", "dognum", "ver", "projectid", "prjname", "prjfullpath", "prjcost",
             "prjsize", "major", "duration", "utype", "receivetime"]
ATTRS = FACT_COLS[:12]
ENRICHED = (["pId"] + FACT_COLS + ["first_open_datetime", "last_close_datetime", "total_duration",
                                   "last_long", "user_id", "user_name", "email", "mobile"])


def _fact_rows(src: str, numeric_defaults: bool, slash_rule: bool = True, extra: str = "") -> str:
    filled = ", ".join(f"{_fill(c)} as {c}" for c in FACT_COLS)
    zero = ["prjcost", "prjsize", "duration"] if numeric_defaults else ["duration"]
    sel = ", ".join(
        f"(case when {c} = 'N/A' then '0' else {c} end) as {c}" if c in zero else
        (f"(case when {c} = 'N/A' and prjfullpath <> 'N/A' then "
         f"{_name_from_path('prjfullpath') if slash_rule else _name_backslash_only('prjfullpath')} "
         f"else {c} end) as {c}") if c == "prjname" else c
        for c in FACT_COLS)
    return (f"select md5(concat(pcode, dognum, projectid, prjname)) as pId, *, "
            f"concat(receivetime, '#', lpad(cast(seq as varchar), 20, '0')) as ord from ("
            f"select seq, {extra}{sel} from (select seq, {extra}{filled} from {src} "
            f"where projectid <> 'N/A' or prjname <> 'N/A' or prjfullpath <> 'N/A'))")


def _condense(rows: str, numeric_defaults: bool, by: str = "pId") -> str:
    miss = {c: "N/A" for c in ATTRS}
    miss["duration"] = "0"
    if numeric_defaults:
        miss["prjcost"] = miss["prjsize"] = "0"
    attrs = ", ".join(f"{_latest(c, miss[c])} as {c}" for c in ATTRS)
    return (f"select {by}, {attrs}, max(receivetime) as receivetime, min(receivetime) as first_open_datetime, "
            f"max(receivetime) as last_close_datetime, "
            f"cast(coalesce(sum(try_cast(duration as double)), 0.0) as varchar) as total_duration, "
            f"{_latest('duration', '0')} as last_long from ({rows}) group by {by}")


def _enrich(facts: str) -> str:
    picks = []
    for c in ["user_id", "user_name", "email", "mobile"]:
        v = f"coalesce(u.{c}, du.{c})"
        picks.append(f"(case when {v} is null or {v} = '' then 'N/A' else {v} end) as {c}")
    return (f"select f.*, {', '.join(picks)} from ({facts}) f "
            f"left join dim_u u on f.gid = u.gid and f.gid <> 'N/A' "
            f"left join dim_du du on f.gid = du.user_id and f.gid <> 'N/A'")


def _usage_rows(src: str, with_project: bool, all_products: bool = False) -> str:
    keycols = (["tmday", "pcode", "projectid", "dognum", "gid", "hardwareid", "fncode"] if with_project
               else ["tmday", "pcode", "dognum", "gid", "hardwareid", "fncode"])
    names = ["prjname", "fnname"] if with_project else ["fnname"]
    strs = [c for c in ["pcode", "projectid", "prjname", "dognum", "gid", "hardwareid", "fnname"]
            if with_project or c not in ("projectid", "prjname")]
    filled = ", ".join(f"coalesce({c}, 'N/A') as {c}" for c in strs)
    return (f"select md5(concat({', '.join(keycols)})) as key, {', '.join(keycols)}, {', '.join(names)}, trigertime, "
            f"concat(trigertime, '#', lpad(cast(seq as varchar), 20, '0')) as ord from ("
            f"select seq, {filled}, cast(coalesce(fncode, 0) as varchar) as fncode, "
            f"translate(coalesce(trigertime, 'N/A'), '年月日', '') as trigertime, {_day('trigertime')} as tmday "
            f"from {src}" + ("" if all_products else " where pcode in ('11036', '-103000', '-103001')") + ")")


def _usage_condense(src: str, with_project: bool, all_products: bool = False) -> str:
    cols = (["key", "tmday", "pcode", "projectid", "prjname", "dognum", "gid", "hardwareid", "fncode",
             "fnname", "count", "trigertime"] if with_project else
            ["key", "tmday", "pcode", "dognum", "gid", "hardwareid", "fncode", "fnname", "count", "trigertime"])
    sel = []
    for c in cols[1:]:
        if c in ("prjname", "fnname"):
            sel.append(f"{_latest(c)} as {c}")
        elif c == "count":
            sel.append("cast(count(*) as integer) as count")
        elif c == "trigertime":
            sel.append("max(trigertime) as trigertime")
        else:
            sel.append(f"arg_max({c}, ord) as {c}")
    return f"select key, {', '.join(sel)} from ({_usage_rows(src, with_project, all_products)}) group by key"


def _usage_merge(with_project: bool, all_products: bool = False) -> str:
    day = _usage_condense("day_log", with_project, all_products)
    hist = _usage_condense("hist_log", with_project, all_products)
    cols = (["key", "tmday", "pcode", "projectid", "prjname", "dognum", "gid", "hardwareid", "fncode",
             "fnname", "count", "trigertime"] if with_project else
            ["key", "tmday", "pcode", "dognum", "gid", "hardwareid", "fncode", "fnname", "count", "trigertime"])
    hw = "((d.key is not null and a.key is not null and d.trigertime < a.trigertime) or d.key is null)"
    sel = []
    for c in cols:
        if c == "key":
            sel.append("coalesce(d.key, a.key) as key")
        elif c == "count":
            sel.append("cast(case when d.key is not null and a.key is not null then d.count + a.count "
                       "else coalesce(d.count, a.count) end as integer) as count")
        elif c == "tmday":
            sel.append(f"coalesce(case when {hw} then a.tmday else d.tmday end, '20850101') as tmday")
        else:
            sel.append(f"case when {hw} then a.{c} else d.{c} end as {c}")
    return (f"WITH {USERLOG}, du AS ({day}), hu AS ({hist}) select {', '.join(sel)} from du d full join "
            f"(select * from hu where tmday in (select tmday from du)) a on d.key = a.key")


WHOLE_FACTS = _condense(_fact_rows("userlog", True), True)
DAY_FACTS = _condense(_fact_rows("day_log", True), True)
HIST_FACTS = _condense(_fact_rows("hist_log", True), True)
DAY_FACTS_PFA = _condense(_fact_rows("day_log", False), False)
HIST_FACTS_PFA = _condense(_fact_rows("hist_log", False), False)
PREFIX = (f"WITH {USERLOG}, day_facts AS ({DAY_FACTS}), hist_facts AS ({HIST_FACTS}), "
          f"day_enriched AS ({_enrich('select * from day_facts')}), "
          f"hist_enriched AS ({_enrich('select * from hist_facts')})")


def _merge_full_select() -> str:
    sel = []
    both = "d.pId is not null and a.pId is not null"
    for c in ENRICHED:
        side = f"case when d.pId is not null then d.{c} else a.{c} end"
        if c == "first_open_datetime":
            v = f"case when {both} then least(a.{c}, d.{c}) else {side} end"
        elif c == "last_close_datetime":
            v = f"case when {both} then greatest(a.{c}, d.{c}) else {side} end"
        elif c == "total_duration":
            v = (f"case when {both} then cast(coalesce(try_cast(a.{c} as double), 0.0) + "
                 f"coalesce(try_cast(d.{c} as double), 0.0) as varchar) else {side} end")
        elif c in ("user_id", "user_name", "email", "mobile"):
            v = f"case when {both} then (case when d.{c} = 'N/A' then a.{c} else d.{c} end) else {side} end"
        else:
            v = side
        if c == "gid":
            v = f"case when starts_with({v}, 'N/A') then 'N/A' else {v} end"
        sel.append(f"{v} as {c}")
    return (f"select {', '.join(sel)} from day_enriched d full join hist_enriched a on a.pId = d.pId")


def _merge_left_select() -> str:
    sel = []
    for c in ENRICHED:
        if c == "first_open_datetime":
            v = (f"case when a.pId is not null and a.{c} <> 'N/A' and a.{c} < d.{c} then a.{c} else d.{c} end")
        elif c == "last_close_datetime":
            v = (f"case when a.pId is not null and a.{c} <> 'N/A' and a.{c} > d.{c} then a.{c} else d.{c} end")
        elif c == "gid":
            v = f"case when starts_with(d.gid, 'N/A') then 'N/A' else d.gid end"
        else:
            v = f"d.{c}"
        sel.append(f"{v} as {c}")
    sel.append("case when a.pId is not null then 0 else 1 end as is_insert")
    return f"select {', '.join(sel)} from day_enriched d left join hist_enriched a on a.pId = d.pId"


REL_MAP = [("id", "pId"), ("product_id", "pcode"), ("lock_number", "dognum"),
           ("yun_account_id", "user_id"), ("yun_account_name", "user_name"), ("mobile", "mobile"),
           ("email", "email"), ("version", "ver"), ("project_id", "projectid"),
           ("project_name", "prjname"), ("project_addr", "prjfullpath"), ("project_type", "utype"),
           ("project_size", "prjsize"), ("project_cost", "prjcost"), ("total_long", "total_duration"),
           ("first_open_datetime", "first_open_datetime"), ("last_close_datetime", "last_close_datetime"),
           ("last_long", "last_long")]


def _relational(src: str) -> str:
    cols = ", ".join(f"try_cast({s} as double) as {d}" if d in ("total_long", "last_long") else f"{s} as {d}"
                     for d, s in REL_MAP)
    return f"select {cols} from ({src})"


def _dim(facts: str) -> str:
    attrs = ["projectid", "prjname", "prjfullpath", "prjcost", "prjsize", "major", "duration", "utype"]
    inner = (f"select md5(concat(projectid, prjname)) as pId, projectid, {_strip('prjname')} as prjname, "
             f"prjfullpath, prjcost, prjsize, major, duration, utype, concat(receivetime, '#', pId) as ord "
             f"from {facts}")
    return f"select pId, {', '.join(f'arg_max({c}, ord) as {c}' for c in attrs)} from ({inner}) group by pId"


def _relational_update(mode: str, changed_only: bool = False) -> str:
    stored = _relational("select * from hist_enriched")
    changes = _relational(f"select * from ({_merge_left_select()}) where is_insert = 0")
    total = "c.total_long" if mode == "set" else "t.total_long + c.total_long"
    rules = {
        "yun_account_id": "case when t.yun_account_id = 'N/A' then c.yun_account_id else t.yun_account_id end",
        "total_long": total,
        "first_open_datetime": "c.first_open_datetime",
        "last_close_datetime": "c.last_close_datetime",
        "last_long": "c.last_long",
    }
    sel = ", ".join(
        f"case when c.id is not null then {rules[d]} else t.{d} end as {d}" if d in rules else f"t.{d} as {d}"
        for d, _ in REL_MAP)
    join = "join" if changed_only else "left join"
    return f"{PREFIX} select {sel} from ({stored}) t {join} ({changes}) c on t.id = c.id"


def _sql() -> dict[str, str]:
    u = f"WITH {USERLOG}"
    fill13 = ", ".join(
        f"(case when {_fill(c)} = 'N/A' then '0' else {_fill(c)} end) as {c}"
        if c in ("prjcost", "prjsize", "duration") else f"{_fill(c)} as {c}" for c in FACT_COLS)
    valid = "where projectid <> 'N/A' or prjname <> 'N/A' or prjfullpath <> 'N/A'"
    rel_dim = ", ".join(f"{s} as {d}" for d, s in [
        ("pid", "pId"), ("project_id", "projectid"), ("project_name", "prjname"),
        ("prjfullpath", "prjfullpath"), ("prjcost", "prjcost"), ("prjsize", "prjsize"),
        ("major", "major"), ("duration", "duration"), ("utype", "utype")])
    q = {
        "window_scan": f"{u} select * from day_log",
        "valid_actions": f"{u} select * from userlog {valid}",
        "product_filter": f"{u} select * from userlog where pcode in ('11036', '-103000', '-103001')",
        "fill_missing": f"{u} select seq, {fill13} from userlog {valid}",
        "project_name": (f"{u} select seq, prjfullpath, (case when prjname = 'N/A' and prjfullpath <> 'N/A' "
                         f"then {_name_from_path('prjfullpath')} else prjname end) as name from "
                         f"(select seq, {_fill('prjname')} as prjname, {_fill('prjfullpath')} as prjfullpath "
                         f"from userlog {valid})"),
        "project_key": f"{u} select seq, pId from ({_fact_rows('userlog', True)})",
        "trigger_day": (f"{u} select seq, translate(coalesce(trigertime, 'N/A'), '年月日', '') as trigertime, "
                        f"{_day('trigertime')} as tmday from userlog"),
        "fact_condense": f"{u} {WHOLE_FACTS}",
        "users_by_gid": f"{PREFIX} select * from dim_u",
        "users_by_id": f"{PREFIX} select * from dim_du",
        "enrich_users": f"{u}, wf AS ({WHOLE_FACTS}) {_enrich('select * from wf')}",
        "fact_merge_full": f"{PREFIX} {_merge_full_select()}",
        "fact_merge_left": f"{PREFIX} {_merge_left_select()}",
        "insert_flag": (f"{PREFIX} select coalesce(d.pId, a.pId) as pId, case when a.pId is not null then 0 else 1 end "
                        f"as is_insert from day_facts d full join hist_facts a on d.pId = a.pId"),
        "fact_new_only": (f"WITH {USERLOG}, dp AS ({DAY_FACTS_PFA}), hp AS ({HIST_FACTS_PFA}) "
                          f"select * from dp where dognum <> 'N/A' and pId not in (select pId from hp)"),
        "dim_condense": f"{u}, wf AS ({WHOLE_FACTS}) {_dim('wf')}",
        "dim_new_only": (f"{PREFIX}, dd AS ({_dim('day_facts')}), hd AS ({_dim('hist_facts')}) "
                         f"select * from dd where pId not in (select pId from hd)"),
        "project_summary": (f"{PREFIX}, m AS ({_merge_full_select()}) select pcode as product_id, ver, "
                            f"dognum as lock_number, count(*) as project_cnt from m group by pcode, ver, dognum"),
        "project_summary_filtered": (
            f"{PREFIX}, m AS ({_merge_full_select()}) select pcode as product_id, ver, dognum as lock_number, "
            f"count(*) as project_cnt from m where prjname <> 'N/A' and instr(prjname, 'tmp') = 0 "
            f"group by pcode, ver, dognum"),
        "usage_condense": f"{u} {_usage_condense('userlog', True)}",
        "usage_merge": _usage_merge(True),
        "user_usage_condense": f"{u} {_usage_condense('userlog', False)}",
        "user_usage_merge": _usage_merge(False),
        "affected_days": f"{u} select distinct tmday from ({_usage_condense('userlog', True)})",
        "relational_insert_rows": (
            f"{PREFIX} select * from ({_relational(f'select * from ({_merge_left_select()}) where is_insert = 1')}) "
            f"where id not in (select pId from hist_enriched)"),
        "relational_update_result": _relational_update("add"),
        "relational_update_result_set": _relational_update("set"),
        "relational_changed_rows": _relational_update("add", changed_only=True),
        "dim_insert_rows": (f"{PREFIX}, dd AS ({_dim('day_facts')}), hd AS ({_dim('hist_facts')}) "
                            f"select {rel_dim}, 'N/A' as regionrule from dd where pId not in (select pId from hd)"),
        "next_window": (f"{u} select cast(strftime(strptime(cast(max(mday) as varchar), '%Y%m%d') + interval 1 day, "
                        f"'%Y%m%d') as int) as batch_start, "
                        f"cast(strftime(date '2024-01-31' - interval 1 day, '%Y%m%d') as int) as batch_end "
                        f"from hist_log"),
    }
    # sink round trips: the published table after a first run over the
    # history window and a second run over the day window
    q["table_replace_roundtrip"] = q["fact_merge_full"]
    q["bucketed_merge_roundtrip"] = q["fact_merge_full"]
    q["batch_summary_roundtrip"] = q["project_summary"]
    q["fact_append_roundtrip"] = (
        f"WITH {USERLOG}, dp AS ({DAY_FACTS_PFA}), hp AS ({HIST_FACTS_PFA}) "
        f"select * from hp where dognum <> 'N/A' union all "
        f"select * from dp where dognum <> 'N/A' and pId not in (select pId from hp where dognum <> 'N/A')")
    q["bucketed_append_roundtrip"] = q["fact_append_roundtrip"]
    q["dim_append_roundtrip"] = (
        f"{PREFIX}, dd AS ({_dim('day_facts')}), hd AS ({_dim('hist_facts')}) "
        f"select * from hd union all select * from dd where pId not in (select pId from hd)")
    merged = _usage_merge(True)
    q["partition_replace_roundtrip"] = (
        merged.replace(" select coalesce(d.key, a.key) as key", " , m AS (select coalesce(d.key, a.key) as key", 1)
        + ") select * from m union all select * from hu where tmday not in (select tmday from du)")
    q["user_usage_roundtrip"] = (
        _usage_merge(False).replace(" select coalesce(d.key, a.key) as key", " , m AS (select coalesce(d.key, a.key) as key", 1)
        + ") select * from m union all select * from hu where tmday not in (select tmday from du)")
    unsalted = ", ".join("case when starts_with(gid, 'N/A') then 'N/A' else gid end as gid" if c == "gid" else c for c in ENRICHED)
    q["left_append_roundtrip"] = (
        f"{PREFIX} select {unsalted} from hist_enriched union all "
        f"select {', '.join(ENRICHED)} from ({_merge_left_select()}) where is_insert = 1")
    q["time_millis"] = (f"{u} select seq, epoch_ms(try_strptime(trigertime, '%Y/%m/%d %H:%M:%S')) as millis from userlog")
    q["usage_stream_roundtrip"] = q["partition_replace_roundtrip"]
    q["usage_key_bucket_roundtrip"] = q["partition_replace_roundtrip"]
    q["usage_product_partition_roundtrip"] = (
        _usage_merge(True, all_products=True).replace(
            " select coalesce(d.key, a.key) as key", " , m AS (select coalesce(d.key, a.key) as key", 1)
        + ") select * from m union all select * from hu where tmday not in (select tmday from du)")
    q["fact_condense_backslash_names"] = f"{u} {_condense(_fact_rows('userlog', True, False), True)}"
    q["distinct_users"] = f"{PREFIX} select * from dim_user"
    # product lists, int product codes, a log without a row id
    products = "('11036', '-103000', '-103001')"
    listed = f"{u}, listed AS (select * from userlog where pcode in {products})"
    q["fact_condense_products"] = f"{listed} {_condense(_fact_rows('listed', True), True)}"
    q["fact_condense_int_pcode"] = q["fact_condense"]
    q["usage_condense_no_row_id"] = (
        f"{u} select key, tmday, pcode, projectid, dognum, gid, hardwareid, fncode, cast(count(*) as integer) as count, "
        f"max(trigertime) as trigertime from ({_usage_rows('userlog', True)}) group by all")
    q["next_window_two_jobs"] = (
        f"{u} select job, cast(strftime(strptime(cast(d as varchar), '%Y%m%d') + interval 1 day, '%Y%m%d') as int) as batch_start, "
        f"20240130 as batch_end from (select 'late' as job, max(mday) as d from hist_log union all "
        f"select 'early', max(mday) from userlog where mday between 20240101 and 20240121)")
    # reruns, catching up, reprocessing: both windows at once, or as merged
    q["rerun_after_failure_roundtrip"] = q["partition_replace_roundtrip"]
    q["rerun_after_failure_facts_roundtrip"] = q["manifest_merge_roundtrip"] = q["fact_merge_full"]
    q["first_state_roundtrip"] = q["user_usage_roundtrip"]
    both = f"{PREFIX}, both_log AS (select * from userlog where mday between 20240101 and 20240130)"
    q["partial_jobs_roundtrip"] = q["reprocess_from_states_roundtrip"] = (
        f"{both}, bf AS ({_condense(_fact_rows('both_log', True), True)}) select {unsalted} from ({_enrich('select * from bf')})")
    q["reprocess_roundtrip"] = (
        f"{both}, days AS (select distinct tmday from ({_usage_rows('day_log', True)})) "
        f"select * from ({_usage_condense('both_log', True)}) where tmday in (select tmday from days) union all "
        f"select * from ({_usage_condense('hist_log', True)}) where tmday not in (select tmday from days)")
    sentinel = f"{_day('trigertime')} = '20850101'"
    kept = "(projectid <> 'N/A' or prjname <> 'N/A' or prjfullpath <> 'N/A')"
    q["batch_quality_roundtrip"] = (
        f"{u}, f AS (select count(*) as n, count(*) filter (where not coalesce({kept}, false)) as dropped, count(*) filter (where "
        f"coalesce({kept}, false) and duration not in ('', 'N/A') and try_cast(duration as double) is null) as bad from day_log), "
        f"g AS (select count(*) as n, count(*) filter (where {sentinel}) as sentinel, count(*) filter (where {sentinel} and "
        f"trigertime not in ('', 'N/A')) as bad from day_log) "
        f"select 'facts' as job, 'rows' as metric, n from f union all select 'facts', 'dropped', dropped from f union all "
        f"select 'facts', 'bad_durations', bad from f union all select 'usage', 'rows', n from g union all "
        f"select 'usage', 'sentinel_days', sentinel from g union all select 'usage', 'bad_times', bad from g")
    # manifest tables
    q["keyed_update_roundtrip"] = q["relational_update_result"]
    q["fact_new_only_skipping"] = q["fact_new_only"]
    q["day_path_scan"] = q["window_scan"]
    cols = ", ".join(["pId", *FACT_COLS, "first_open_datetime", "last_close_datetime", "total_duration", "last_long"])
    daily = _condense(_fact_rows("both_log", False, extra="mday, "), False, by="mday, pId")
    q["compaction_roundtrip"] = (
        f"{both} select {cols} from (select *, row_number() over (partition by pId order by mday) as r from ({daily}) "
        f"where dognum <> 'N/A') where r = 1")
    batches = _condense(_fact_rows("three", True, extra="w, "), True, by="w, pId")
    q["summary_delta_roundtrip"] = (
        f"{both}, three AS (select *, case when mday <= 20240110 then 1 when mday <= 20240120 then 2 else 3 end as w from both_log), "
        f"m AS (select *, row_number() over (partition by pId order by w desc) as r from ({batches})) "
        f"select pcode as product_id, ver, dognum as lock_number, count(*) as project_cnt from m where r = 1 group by pcode, ver, dognum")
    return q
    return q


ORACLE_SQL = _sql()
