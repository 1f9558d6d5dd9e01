"""Filters and missing-value cleaning of log and fact rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagetally.functions import missing_to, name_from_path
from usagetally.functions.keys import hash_key
from usagetally.schemas import FACT_LOG_COLUMNS, MISSING, MISSING_NUMBER

# fact columns that hold numbers as text: their missing value is "0"
NUMERIC_TEXT = ("prjcost", "prjsize", "duration")


def valid_actions(log: DataFrame) -> DataFrame:
    """Keep rows naming a project by id, name or path.

    Applied before any filling: ``''`` passes, a row whose three columns are
    all NULL or all ``'N/A'`` is dropped (SQL three-valued logic)."""
    return log.where(
        (F.col("projectid") != MISSING) | (F.col("prjname") != MISSING)
        | (F.col("prjfullpath") != MISSING)
    )


def product_filter(log: DataFrame, products: Iterable[str] | None) -> DataFrame:
    """Keep the listed product codes; an empty or absent list keeps all."""
    codes = [str(p) for p in (products or [])]
    if not codes:
        return log
    return log.where(F.col("pcode").cast("string").isin(codes))


def fill_missing(df: DataFrame, columns: Sequence[str] | None = None,
                 empty_is_missing: bool = True, missing: str = MISSING) -> DataFrame:
    """NULL (and ``''``) → ``'N/A'`` on the listed string columns.

    Without a list every string column is filled and numeric columns get 0
    (``na.fill(0)``); columns not listed are untouched.  Built as one
    projection of SQL expressions."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = set(columns) if columns is not None else {n for n, k in kinds.items() if k == "string"}
    numeric = {"int", "bigint", "double", "float", "smallint"}
    lit = _sql_text(missing)
    exprs = []
    for name, kind in kinds.items():
        q = f"`{name}`"
        if name in cols and kind == "string":
            cond = f"{q} is null or {q} = ''" if empty_is_missing else f"{q} is null"
            exprs.append(f"case when {cond} then {lit} else {q} end as {q}")
        elif columns is None and kind in numeric:
            exprs.append(f"coalesce({q}, cast(0 as {kind})) as {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)


def _sql_text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def numeric_defaults(df: DataFrame, columns: Sequence[str] = NUMERIC_TEXT) -> DataFrame:
    """``'N/A'`` → ``'0'`` in numeric-text columns."""
    return df.withColumns({c: missing_to(c, MISSING_NUMBER) for c in columns})


def missing_of(df: DataFrame, column: str) -> str:
    """The text that fills a NULL (P5): 0 in a numeric column such as an int product code, else ``N/A``."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return MISSING_NUMBER if dict(df.dtypes).get(column, "").startswith(numeric) else MISSING


def order_key(time_col: str, tiebreak: str | None, columns: Sequence[str] = ()) -> Column:
    """Total order of rows: the time text, then a unique row id (or, without
    one, a hash of the row) so that ties never depend on arrival order."""
    if tiebreak is not None:
        tb = F.lpad(F.col(tiebreak).cast("string"), 20, "0")
    else:
        tb = F.xxhash64(*[F.col(c) for c in columns]).cast("string")
    return F.concat(F.coalesce(F.col(time_col), F.lit("")), F.lit("#"), tb)


def fact_rows(log: DataFrame, numeric_text_defaults: bool = True, slash_rule: bool = True,
              tiebreak: str | None = "seq", key_delimiter: str = "",
              keep: Sequence[str] = ()) -> DataFrame:
    """One cleaned, keyed row per valid log action.

    Output: ``pId``, the 13 fact log columns, ``_ord`` (the row order) and
    the ``keep`` columns.
    ``numeric_text_defaults=False`` is the insert-only job, where only the
    duration defaults to ``'0'``.
    """
    tb = tiebreak if tiebreak is not None and tiebreak in log.columns else None
    extra = list(dict.fromkeys(([tb] if tb else []) + list(keep)))
    # P1 on the raw values, then P2 + P5/P6 in one projection (any type read as text)
    filled = valid_actions(log).selectExpr(
        *[f"case when cast(`{c}` as string) is null or cast(`{c}` as string) = '' then '{missing_of(log, c)}' "
          f"else cast(`{c}` as string) end as `{c}`" for c in FACT_LOG_COLUMNS],
        *[f"`{c}`" for c in extra])
    # F2/F3 name from path, P7 numeric defaults, row order
    zero = NUMERIC_TEXT if numeric_text_defaults else ("duration",)
    name = F.when((F.col("prjname") == MISSING) & (F.col("prjfullpath") != MISSING),
                  name_from_path("prjfullpath", slash_rule)).otherwise(F.col("prjname"))
    rows = filled.select(
        *[name.alias(c) if c == "prjname" else missing_to(c, MISSING_NUMBER).alias(c) if c in zero
          else F.col(c) for c in FACT_LOG_COLUMNS],
        order_key("receivetime", tb, FACT_LOG_COLUMNS).alias("_ord"),
        *keep,
    )
    # F1 key over the derived name
    return rows.select(
        hash_key("pcode", "dognum", "projectid", "prjname", delimiter=key_delimiter).alias("pId"),
        *FACT_LOG_COLUMNS, "_ord", *keep,
    )


def unsalt_gid(df: DataFrame) -> DataFrame:
    """Any gid starting with ``N/A`` is the missing gid."""
    return df.withColumn("gid", F.when(F.col("gid").startswith(MISSING), F.lit(MISSING))
                         .otherwise(F.col("gid")))


def with_dongle(df: DataFrame) -> DataFrame:
    """Drop facts without a licence dongle."""
    return df.where(F.col("dognum") != MISSING)


def named_projects(df: DataFrame, name_col: str = "prjname") -> DataFrame:
    """Keep facts with a project name that does not contain ``tmp``."""
    return df.where((F.col(name_col) != MISSING) & (F.instr(F.col(name_col), "tmp") == 0))
