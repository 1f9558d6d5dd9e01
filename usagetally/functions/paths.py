"""project file name from a full project path.

Rule: when the first backslash is past position 0, keep the last
backslash-separated part (trailing separators ignored); then the same for
``/``; then, if a backslash is still past position 0, drop all backslashes.
A path that starts with its separator (``/home/x``, ``\\\\srv\\share``) is
kept whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_part(path: Column, separator: str) -> Column:
    """What follows the last separator, trailing separators ignored; without a regular expression,
    whose backtracking grows with the square of the path."""
    return F.substring_index(F.rtrim(path, F.lit(separator)), separator, -1)


def strip_backslashes(path) -> Column:
    """remove every backslash when the first one is past position 0."""
    p = _col(path)
    return F.when(F.instr(p, "\\") > 1, F.translate(p, "\\", "")).otherwise(p)


def name_from_path(path, slash_rule: bool = True) -> Column:
    """F2 (+F3): file name of a Windows, UNC, Unix or mixed path.

    ``slash_rule=False`` gives the backslash-only variant of the later job.
    """
    p = _col(path)
    p = F.when(F.instr(p, "\\") > 1, last_part(p, "\\")).otherwise(p)
    if slash_rule:
        p = F.when(F.instr(p, "/") > 1, last_part(p, "/")).otherwise(p)
        p = strip_backslashes(p)
    return p
