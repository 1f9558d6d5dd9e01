"""Column expressions (built-in Spark functions only; no Python UDF)."""

from usagetally.functions.keys import hash_key
from usagetally.functions.paths import name_from_path, strip_backslashes
from usagetally.functions.times import (
    clean_trigger_time,
    day_from_time,
    next_day,
    time_to_millis,
    yesterday,
)
from usagetally.functions.values import (
    fill_missing_text,
    is_present,
    keep_unless_missing,
    missing_to,
    number_text,
    present_or_null,
    sum_as_text,
    to_number,
)

__all__ = [
    "hash_key", "name_from_path", "strip_backslashes", "clean_trigger_time", "day_from_time",
    "next_day", "time_to_millis", "yesterday", "fill_missing_text", "is_present",
    "keep_unless_missing", "missing_to", "number_text", "present_or_null", "sum_as_text",
    "to_number",
]
