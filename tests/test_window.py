import datetime as dt

import pytest

from usagetally.plans.window import advance_state, check_window, next_window, param
from usagetally.schemas import STATE_SCHEMA


def state(spark, end="20161231", stop="0", start="20161201"):
    return spark.createDataFrame([
        ("usage-facts", "start_date", start, "batch"), ("usage-facts", "end_date", end, "batch"),
        ("usage-facts", "stop_date", stop, "batch")], STATE_SCHEMA)


def test_next_window_yesterday(spark):
    r = next_window(state(spark), today=dt.date(2017, 1, 5)).first()
    assert (r.batch_start, r.batch_end) == (20170101, 20170104)


def test_next_window_stop_and_overrides(spark):
    r = next_window(state(spark, stop="20170102")).first()
    assert (r.batch_start, r.batch_end) == (20170101, 20170102)
    r = next_window(state(spark), today=dt.date(2017, 1, 5), reprocess=True).first()
    assert r.batch_start == 20161201
    r = next_window(state(spark), start=20170301, end=20170302).first()
    assert (r.batch_start, r.batch_end) == (20170301, 20170302)


def test_advance_and_guard(spark):
    s = advance_state(state(spark), 20170101, 20170104)
    assert param(s, "end_date").first()[0] == "20170104"
    assert param(s, "start_date").first()[0] == "20170101"
    with pytest.raises(ValueError):
        check_window(s, 20170104)
    check_window(s, 20170105)
    check_window(s, 20170101, reprocess=True)
