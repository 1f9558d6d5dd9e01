"""Token counts (operator 5): delta-maintained rollups.

A batch of changes has rows (``sign``, ``source``, ``lang``, ``text``): +1 adds a
document, -1 takes it away; a revised document is its old row with -1 and its new
row with +1.  Each row is counted by every tokenizer version; signed documents
and tokens are added up within a task, then by (source, lang, tokenizer), and
written as one small table for the batch.  Totals are the sum over the committed
batches: sums don't depend on the order of batches.

A batch is committed by the rename of its finished folder
(``deltas/<batch>``); a batch whose folder is there is not applied again, and a
batch that failed half-way left only a folder of its own attempt that nobody
reads.

Defined results: null and empty texts have no tokens but count as documents; null
source or language is a group of its own; repeated rows count each time; an empty
batch commits an empty table; groups whose documents and tokens are both 0 vanish
from the totals; extra columns are not read.
"""

from __future__ import annotations

import base64
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagetally.llm.common import BLANKS, batches_of, ship
from usagetally.session import exists

ship(__name__)

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits a text for the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"


def word_counter() -> Callable[[list[str]], list[int]]:
    """Words between blanks."""
    import re

    words = re.compile(f"[^{BLANKS}]+")
    return lambda texts: [sum(1 for _ in words.finditer(t)) for t in texts]


def byte_pair_counter(ranks: bytes) -> Callable[[], Callable[[list[str]], list[int]]]:
    """Tokens of a public byte-level vocabulary (the content of its rank file)."""
    def make() -> Callable[[list[str]], list[int]]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        code = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        return lambda texts: [len(code.encode_ordinary(t)) for t in texts]

    return make


def tokenizers(path: str = RANKS) -> dict[str, Callable]:
    """Tokenizer version -> maker of a counter (texts -> counts)."""
    with open(path, "rb") as f:
        return {"words-1": word_counter, "byte_bpe_50k-1": byte_pair_counter(f.read())}


def deltas(changes: DataFrame, versions: dict[str, Callable]) -> DataFrame:
    """source, lang, tokenizer, docs, tokens: the signed sums of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {name: make() for name, make in versions.items()}
        for batch in batches:
            sign, source, lang, texts = (batch.column(k).to_pylist() for k in range(4))
            total = defaultdict(lambda: [0, 0])
            for a, b in batches_of(texts, rows=512):
                block = [t or "" for t in texts[a:b]]
                for name, count in counters.items():
                    for k, n in enumerate(count(block), a):
                        cell = total[source[k], lang[k], name]
                        cell[0] += sign[k]
                        cell[1] += sign[k] * n
            rows = [(*key, *cell) for key, cell in total.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.string()] * 3 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["source", "lang", "tokenizer", "docs", "tokens"])

    return (changes.select(F.col("sign").cast("long"), "source", "lang", "text").mapInArrow(run, SCHEMA)
            .groupBy("source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")))


def commit(spark: SparkSession, root: str, batch: str, changes: DataFrame, versions: dict[str, Callable]) -> bool:
    """Apply a batch once; False if it was committed before."""
    final = f"{root}/deltas/{batch}"
    if exists(spark, final):
        return False
    attempt = f"{root}/attempts/{batch}-{uuid.uuid4().hex}"
    deltas(changes, versions).write.parquet(attempt)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(attempt).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(f"{root}/deltas"))
    # a rename onto a folder that another writer finished meanwhile would move into it: look again
    return not exists(spark, final) and bool(fs.rename(path(attempt), path(final)))


def totals(spark: SparkSession, root: str) -> DataFrame:
    """source, lang, tokenizer, docs, tokens over all committed batches."""
    if not exists(spark, f"{root}/deltas"):
        return spark.createDataFrame([], SCHEMA)
    return (spark.read.schema(SCHEMA).parquet(f"{root}/deltas/*").groupBy("source", "lang", "tokenizer")
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0"))


__all__ = ["deltas", "commit", "totals", "tokenizers", "byte_pair_counter", "word_counter"]
