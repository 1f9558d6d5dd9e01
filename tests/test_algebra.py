"""Batching algebra: days {1, 2} at once equal day 1 then day 2.

Holds for usage counts and for fact totals / open / close times; not for
fact attributes (today's value wins even when missing), so those are not
compared."""

from usagetally.operators import enrich_users, fact_condense, fact_merge_full, usage_condense, usage_merge
from usagetally.sources.fixtures import load_userlog, load_users
from usagetally.sources.log import window_scan

from .conftest import SF_SMALL


def test_fact_merge_is_associative_in_days(spark):
    log, users = load_userlog(spark, SF_SMALL), load_users(spark, SF_SMALL)
    both = enrich_users(fact_condense(window_scan(log, 20240121, 20240130)), users)
    d1 = enrich_users(fact_condense(window_scan(log, 20240121, 20240125)), users)
    d2 = enrich_users(fact_condense(window_scan(log, 20240126, 20240130)), users)
    step = fact_merge_full(d2, d1)
    cols = ("pId", "first_open_datetime", "last_close_datetime")
    a = {r[0]: (r[1], r[2], float(r[3])) for r in both.select(*cols, "total_duration").collect()}
    b = {r[0]: (r[1], r[2], float(r[3])) for r in step.select(*cols, "total_duration").collect()}
    assert a == b


def test_usage_merge_is_associative_in_days(spark):
    log = load_userlog(spark, SF_SMALL)
    both = usage_condense(window_scan(log, 20240121, 20240130))
    d1 = usage_condense(window_scan(log, 20240121, 20240125))
    d2 = usage_condense(window_scan(log, 20240126, 20240130))
    step = usage_merge(d2, d1)
    a = sorted((r.key, r.tmday, r["count"], r.trigertime) for r in both.collect())
    b = sorted((r.key, r.tmday, r["count"], r.trigertime) for r in step.collect())
    assert a == b
