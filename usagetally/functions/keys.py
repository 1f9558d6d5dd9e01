"""surrogate keys, lowercase MD5 hex of the concatenated parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts, delimiter: str = "", null_as: str = "null") -> Column:
    """MD5 hex of ``part1 ‖ part2 ‖ …`` over the UTF-8 bytes.

    The parts are joined without a delimiter by default, which is how the
    original keys were made; pass ``delimiter`` to avoid collisions such as
    ``'ab'‖'c' = 'a'‖'bc'`` in new tables.  A NULL part is written as the text
    ``null_as`` (string building on the JVM writes ``"null"``), so a key is
    never NULL.
    """
    cols = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit(null_as)) for p in parts]
    return F.md5(F.concat_ws(delimiter, *cols))
