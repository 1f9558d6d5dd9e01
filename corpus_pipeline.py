"""Corpus preparation: toxicity, quality rules, near duplicates, source mixing, pieces.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.  ``run`` applies them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagetally.llm import mixing, neardup, pieces, quality, toxicity
from usagetally.llm.common import ROWS_AT_ONCE, cut
from usagetally.llm.queries import MIX_WEIGHTS


def small_batches(spark: SparkSession) -> None:
    """Python stages get whole texts in Arrow batches of ``ROWS_AT_ONCE`` rows: a batch is held several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.7; the model learns from labelled rows of ``docs``."""
    small_batches(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that every quality rule keeps."""
    return quality.drop_low_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity of 0.8 or more."""
    return neardup.drop_near_duplicates(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights, shuffled."""
    return mixing.mix_sources(docs, MIX_WEIGHTS, numbered=False)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and the text decoded from them."""
    small_batches(spark)
    return pieces.encode(docs, pieces.load_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", apply_quality_rules),
    ("near_duplicates", drop_near_duplicates),
    ("source_mixing", mix),
    ("sentencepiece", encode),
]

#: The first stage scores with a fitted model, which SQL can't express; tests/llm holds run() against its
#: stages applied one by one, and each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
