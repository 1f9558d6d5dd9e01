"""Usage log and user dimension derived from the driver's tables.

The driver's data has no usage log, so one is derived row by row from
``events`` (one log row per event) and a user dimension from ``customer``
(every customer, plus a second, coarser identity per nation so that user ids
repeat and some gids are shared by many people).  The derivation rules
below are a fixture contract shared with the SQL oracle; their constants are
fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# the driver's input tables, declared (no footer-reading job per read)
EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")
CUSTOMER_SCHEMA = ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                   "c_mktsegment string")

# ---------------------------------------------------------------------------
# Fixed values of the derived log (shared with the SQL oracle)
# ---------------------------------------------------------------------------
EVENT_PRODUCT = {"click": "11036", "view": "-103000", "purchase": "-103001", "signup": "20001"}
OTHER_PRODUCT = "20002"
HISTORY_WINDOW = (20240101, 20240120)   # log days condensed into "history"
DAY_WINDOW = (20240121, 20240130)       # log days processed as "today's" batch
FIXTURE_TODAY = "2024-01-31"            # run date of the fixed next-window query
# ---------------------------------------------------------------------------


# parsed once a row by a generator: an expression over ``props`` would be copied into each use of each
# derived column, and with them into every filter
_PARSED = "inline(array(named_struct('_k', cast(get_json_object(props, '$.k') as int)))) as (_k)"
_K = "_k"
_CJK_TIME = "date_format(ts, 'yyyy年M月d日 HH:mm:ss')"
_TIME = "date_format(ts, 'yyyy/MM/dd HH:mm:ss')"
# Spark SQL text of each derived log column (backslashes doubled for SQL literals)
_PCODE = "case event_type " + " ".join(
    f"when '{et}' then '{code}'" for et, code in EVENT_PRODUCT.items()) + f" else '{OTHER_PRODUCT}' end"
USERLOG_COLUMNS = [
    "event_id as seq",
    "cast(date_format(ts, 'yyyyMMdd') as int) as mday",
    f"{_PCODE} as pcode",
    "case when event_id % 31 = 0 then 'N/A7' else case user_id % 10 when 0 then 'N/A' when 1 then cast(user_id % 15 as string) when 2 then '' "
    "when 3 then cast(null as string) else concat('G', cast(user_id % 15 as string)) end end as gid",
    f"case when {_K} % 7 = 0 then 'N/A' else concat('D', cast({_K} % 5 as string)) end as dognum",
    "case when event_id % 4 = 0 then '' else concat('v', cast(event_id % 3 as string)) end as ver",
    f"case when {_K} % 3 = 0 then 'N/A' else concat('P', cast({_K} % 20 as string), '-', "
    f"cast(cast(date_format(ts, 'dd') as int) % 16 as string)) end as projectid",
    f"case when event_id % 23 = 0 then concat('tmp', cast({_K} % 10 as string)) else "
    f"case {_K} % 4 when 0 then 'N/A' when 1 then '' else concat('name', cast({_K} % 10 as string)) end end as prjname",
    f"case {_K} % 6 when 0 then 'N/A' "
    f"when 1 then concat('E:\\\\dir\\\\proj', cast({_K} % 10 as string), '.GCL10') "
    f"when 2 then concat('a/b/proj', cast({_K} % 10 as string)) "
    f"when 3 then concat('\\\\\\\\srv\\\\share\\\\p', cast({_K} % 10 as string)) "
    f"when 4 then cast(null as string) "
    f"else concat('C:\\\\d/x\\\\y', cast({_K} % 10 as string)) end as prjfullpath",
    "case when event_id % 5 = 0 then cast(null as string) else cast(event_id % 1000 as string) end as prjcost",
    "case when event_id % 6 = 0 then '' else cast(event_id % 900 as string) end as prjsize",
    "case when event_id % 3 = 0 then 'N/A' else concat('m', cast(event_id % 4 as string)) end as major",
    "case when event_id % 8 = 0 then 'N/A' when event_id % 29 = 0 then '12s' else cast(event_id % 600 as string) end as duration",
    "case when event_id % 9 = 0 then cast(null as string) else concat('u', cast(event_id % 2 as string)) end as utype",
    f"{_TIME} as receivetime",
    "concat('H', cast(user_id % 3 as string)) as hardwareid",
    f"case when {_K} % 11 = 0 then cast(null as int) else cast({_K} % 4 as int) end as fncode",
    "case when event_id % 7 = 0 then 'N/A' else concat('fn', cast(event_id % 5 as string)) end as fnname",
    f"case event_id % 13 when 0 then cast(null as string) when 1 then '' when 2 then {_CJK_TIME} "
    f"when 3 then date_format(ts, 'yyyyMMdd') when 4 then '2024/13/41 08:00:00' else {_TIME} end as trigertime",
]


def userlog_from_events(events: DataFrame) -> DataFrame:
    """18 log columns + ``seq`` (the event id, used only to break time ties)."""
    return events.selectExpr("*", _PARSED).selectExpr(*USERLOG_COLUMNS)


def users_from_customer(customer: DataFrame) -> DataFrame:
    """User dimension: ``gid, user_id, user_name, email, mobile``.

    One row per customer, and one more per customer under the shared gid of
    its nation (``G<nationkey>``, no contact details), so gids and user ids
    repeat and a nation's gid can hold a large share of all rows.
    """
    own = customer.selectExpr(
        "concat('G', cast(c_custkey as string)) as gid",
        "c_custkey as user_id",
        "c_name as user_name",
        "case when c_custkey % 4 = 0 then cast(null as string) "
        "else concat('u', cast(c_custkey as string), '@example.com') end as email",
        "case when c_custkey % 6 = 0 then '' else concat('138', lpad(cast(c_custkey as string), 8, '0')) end as mobile",
    )
    shared = customer.selectExpr(
        "concat('G', cast(c_nationkey as string)) as gid",
        "c_custkey as user_id",
        "concat(c_name, '-b') as user_name",
        "cast(null as string) as email",
        "cast(null as string) as mobile",
    )
    return own.unionByName(shared)


def load_userlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return userlog_from_events(read_events(spark, sf_dir))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def load_userlog_window(spark: SparkSession, sf_dir: str, start: int, end: int) -> DataFrame:
    """The derived log of the inclusive ``mday`` window ``[start, end]``.

    ``mday`` is derived from ``ts`` here, so the window is also stated as a
    ``ts`` range that reaches the Parquet scan (row-group pruning), exactly
    as a stored ``mday`` column would be pushed for a real log."""
    lo = F.to_timestamp_ntz(F.lit(str(start)), F.lit("yyyyMMdd"))
    hi = F.to_timestamp_ntz(F.lit(str(end)), F.lit("yyyyMMdd")) + F.expr("INTERVAL 1 DAY")
    events = read_events(spark, sf_dir).where((F.col("ts") >= lo) & (F.col("ts") < hi))
    log = userlog_from_events(events)
    return log.where(F.col("mday").between(F.lit(int(start)), F.lit(int(end))))


def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_from_customer(spark.read.schema(CUSTOMER_SCHEMA).parquet(f"{sf_dir}/customer.parquet"))
