"""Times held as text."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagetally.schemas import CJK_DATE_MARKS, DAY_FORMAT, SENTINEL_DAY

_DAY_DIGITS = r"^([0-9]{4})[^0-9]?([0-9]{1,2})[^0-9]?([0-9]{1,2})"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_trigger_time(t, missing: str = "N/A") -> Column:
    """NULL becomes ``missing``; the year/month/day characters are removed."""
    return F.translate(F.coalesce(_col(t), F.lit(missing)), CJK_DATE_MARKS, "")


def day_from_time(t) -> Column:
    """``yyyyMMdd`` text of a time such as ``2016/07/19 15:11:49``,
    ``2016-07-19``, ``20160719`` or ``2016年7月9日 15:11``, read before any mark is
    removed; the sentinel day when the time is missing or doesn't begin with a date
    of the calendar."""
    part = [F.regexp_extract(_col(t), _DAY_DIGITS, i) for i in (1, 2, 3)]
    text = F.concat(part[0], F.lpad(part[1], 2, "0"), F.lpad(part[2], 2, "0"))
    day = F.date_format(F.try_to_timestamp(F.when(part[0] != "", text), F.lit(DAY_FORMAT)), DAY_FORMAT)
    return F.coalesce(day, F.lit(SENTINEL_DAY))


def next_day(day) -> Column:
    """the day after a ``yyyyMMdd`` int, as an int."""
    d = F.to_date(_col(day).cast("string"), DAY_FORMAT)
    return F.date_format(F.date_add(d, 1), DAY_FORMAT).cast("int")


def yesterday(today: _dt.date | None = None) -> Column:
    """the day before ``today`` (default: the session's current date)."""
    base = F.lit(today) if today is not None else F.current_date()
    return F.date_format(F.date_sub(base, 1), DAY_FORMAT).cast("int")


def time_to_millis(t, pattern: str = "yyyy/MM/dd HH:mm:ss SSS") -> Column:
    """epoch millis of a time text; NULL when it does not parse."""
    return F.unix_millis(F.try_to_timestamp(_col(t), F.lit(pattern)))
