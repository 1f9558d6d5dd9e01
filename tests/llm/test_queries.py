"""Registered queries against their SQL, and the pipeline against its stages applied one by one."""

import os
import sys

import duckdb
import pytest

from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from tools.compare import table_hash  # noqa: E402
from usagetally.llm import mixing, neardup, pieces, quality, queries, toxicity  # noqa: E402


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    cur = con.execute(queries.ORACLE_SQL[name])
    columns, rows = [d[0] for d in cur.description], cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns) and len(got) == len(rows) > 0
    assert table_hash(df.columns, got) == table_hash(columns, rows)


def test_pipeline_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score_documents(docs, model).collect() if r.score < 0.7}
    good = {r.doc_id for r in quality.quality_report(docs).collect() if r.kept} & clean
    left = docs.where(docs.doc_id.isin(sorted(good)))
    alone = {r.doc_id for r in neardup.near_duplicates(left).collect() if r.kept}
    mixed = sorted(r.doc_id for r in mixing.mix_sources(left.where(left.doc_id.isin(sorted(alone))), queries.MIX_WEIGHTS).collect())
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == mixed
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = pieces.load_model()["out"]
    assert all(r.decoded == texts[r.doc_id] == pieces.decode_ids(r.token_ids, out) for r in got)
    assert len(corpus_pipeline.STAGES) == 5
