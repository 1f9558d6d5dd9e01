"""Missing markers and numbers held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagetally.schemas import MISSING


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_missing_text(c, missing: str = MISSING, empty_is_missing: bool = True) -> Column:
    """P5/P6 for one column: NULL (and ``''``) become ``missing``."""
    x = _col(c)
    if empty_is_missing:
        return F.when(x.isNull() | (x == ""), F.lit(missing)).otherwise(x)
    return F.coalesce(x, F.lit(missing))


def missing_to(c, value: str, missing: str = MISSING) -> Column:
    """Replace the missing marker by ``value`` (``'N/A'`` → ``'0'``)."""
    x = _col(c)
    return F.when(x == missing, F.lit(value)).otherwise(x)


def is_present(c, missing: str = MISSING) -> Column:
    x = _col(c)
    return x.isNotNull() & (x != missing)


def present_or_null(c, missing: str = MISSING) -> Column:
    """The value, or NULL when it is missing (NULL never joins)."""
    x = _col(c)
    return F.when(is_present(x, missing), x)


def keep_unless_missing(current, new, missing: str = MISSING) -> Column:
    """F16: ``if(current = missing, new, current)``."""
    cur = _col(current)
    return F.when(cur == missing, _col(new)).otherwise(cur)


def to_number(c, type_: str = "double") -> Column:
    """parse text as a number; NULL when it does not parse."""
    return _col(c).try_cast(type_)


def sum_as_text(*cols) -> Column:
    """F8: double sum of numeric texts, written back as text (``12.0`` style)."""
    total = None
    for c in cols:
        v = F.coalesce(to_number(c), F.lit(0.0))
        total = v if total is None else total + v
    return total.cast("string")


def number_text(c) -> Column:
    """an int column as text, NULL read as 0."""
    return F.coalesce(_col(c), F.lit(0)).cast("string")
