"""Every registered query equals its DuckDB oracle on the smallest tables."""

import hashlib
import os

import duckdb
import pytest

from .conftest import SF_SMALL

import __spark_entry__ as entry
from usagetally.oracle import ORACLE_SQL
from usagetally.plans.catalog import QUERIES


def _hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: "NULL" if v is None else repr(round(v, 6)) if isinstance(v, float) else str(v)
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _hash(df.columns, srows) == _hash(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 22
