"""Table schemas, column lists and fixed values of the usage-log engine.

Every table keeps the text-typed layout of the original job so that a user
can switch without re-typing their downstream readers.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values (must equal the original job's constants for equal results)
# ---------------------------------------------------------------------------
MISSING = "N/A"                 # text marker for a missing value
MISSING_NUMBER = "0"            # marker for missing numeric text (cost, size, duration)
SENTINEL_DAY = "20850101"       # trigger day used when the trigger time is missing
USAGE_PRODUCTS = ("11036", "-103000", "-103001")   # products of the feature-usage jobs
CJK_DATE_MARKS = "年月日"       # year / month / day characters removed from times
TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"
DAY_FORMAT = "yyyyMMdd"
# ---------------------------------------------------------------------------

# the 13 log columns a project fact is built from
FACT_LOG_COLUMNS = [
    "pcode", "gid", "dognum", "ver", "projectid", "prjname", "prjfullpath",
    "prjcost", "prjsize", "major", "duration", "utype", "receivetime",
]
# attributes that take the latest non-missing value when facts are condensed
FACT_ATTRIBUTES = [
    "pcode", "gid", "dognum", "ver", "projectid", "prjname", "prjfullpath",
    "prjcost", "prjsize", "major", "duration", "utype",
]
FACT_MEASURES = ["first_open_datetime", "last_close_datetime", "total_duration", "last_long"]
FACT_COLUMNS = ["pId"] + FACT_LOG_COLUMNS + FACT_MEASURES            # 18
USER_COLUMNS = ["user_id", "user_name", "email", "mobile"]
ENRICHED_FACT_COLUMNS = FACT_COLUMNS + USER_COLUMNS                   # 22

DIM_COLUMNS = ["pId", "projectid", "prjname", "prjfullpath", "prjcost", "prjsize",
               "major", "duration", "utype"]

USAGE_LOG_COLUMNS = ["mday", "pcode", "projectid", "prjname", "dognum", "gid",
                     "hardwareid", "fncode", "fnname", "trigertime"]
USER_USAGE_LOG_COLUMNS = ["mday", "pcode", "dognum", "gid", "hardwareid", "fncode",
                          "fnname", "trigertime"]
# key parts, in hashing order
PROJECT_USAGE_KEY = ["tmday", "pcode", "projectid", "dognum", "gid", "hardwareid", "fncode"]
USER_USAGE_KEY = ["tmday", "pcode", "dognum", "gid", "hardwareid", "fncode"]
PROJECT_USAGE_COLUMNS = ["key", "tmday", "pcode", "projectid", "prjname", "dognum", "gid",
                         "hardwareid", "fncode", "fnname", "count", "trigertime"]
USER_USAGE_COLUMNS = ["key", "tmday", "pcode", "dognum", "gid", "hardwareid", "fncode",
                      "fnname", "count", "trigertime"]

SUMMARY_COLUMNS = ["product_id", "ver", "lock_number", "project_cnt"]

# relational copy of a fact: (relational name, fact column)
RELATIONAL_FACT_MAP = [
    ("id", "pId"), ("product_id", "pcode"), ("lock_number", "dognum"),
    ("yun_account_id", "user_id"), ("yun_account_name", "user_name"),
    ("mobile", "mobile"), ("email", "email"), ("version", "ver"),
    ("project_id", "projectid"), ("project_name", "prjname"),
    ("project_addr", "prjfullpath"), ("project_type", "utype"),
    ("project_size", "prjsize"), ("project_cost", "prjcost"),
    ("total_long", "total_duration"), ("first_open_datetime", "first_open_datetime"),
    ("last_close_datetime", "last_close_datetime"), ("last_long", "last_long"),
]
RELATIONAL_DOUBLE_COLUMNS = ("total_long", "last_long")
RELATIONAL_DIM_MAP = [
    ("pid", "pId"), ("project_id", "projectid"), ("project_name", "prjname"),
    ("prjfullpath", "prjfullpath"), ("prjcost", "prjcost"), ("prjsize", "prjsize"),
    ("major", "major"), ("duration", "duration"), ("utype", "utype"),
]


def _strings(names):
    return StructType([StructField(n, StringType(), True) for n in names])


FACT_SCHEMA = _strings(FACT_COLUMNS)
ENRICHED_FACT_SCHEMA = _strings(ENRICHED_FACT_COLUMNS)
DIM_SCHEMA = _strings(DIM_COLUMNS)
USER_DIM_SCHEMA = StructType([
    StructField("gid", StringType()), StructField("user_id", LongType()),
    StructField("user_name", StringType()), StructField("email", StringType()),
    StructField("mobile", StringType()),
])
LOG_SCHEMA = StructType(
    [StructField("mday", IntegerType())]
    + [StructField(c, StringType()) for c in FACT_LOG_COLUMNS]
    + [StructField("hardwareid", StringType()), StructField("fncode", IntegerType()),
       StructField("fnname", StringType()), StructField("trigertime", StringType())]
)
PROJECT_USAGE_SCHEMA = StructType(
    [StructField(c, IntegerType() if c == "count" else StringType())
     for c in PROJECT_USAGE_COLUMNS]
)
USER_USAGE_SCHEMA = StructType(
    [StructField(c, IntegerType() if c == "count" else StringType())
     for c in USER_USAGE_COLUMNS]
)
SUMMARY_SCHEMA = StructType([
    StructField("product_id", StringType()), StructField("ver", StringType()),
    StructField("lock_number", StringType()), StructField("project_cnt", LongType()),
])
RELATIONAL_FACT_SCHEMA = StructType([
    StructField(n, DoubleType() if n in RELATIONAL_DOUBLE_COLUMNS else StringType())
    for n, _ in RELATIONAL_FACT_MAP
])
STATE_SCHEMA = _strings(["id", "param_key", "param_value", "project"])
