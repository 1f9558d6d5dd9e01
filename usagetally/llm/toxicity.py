"""Toxicity (operator 10): FTRL-proximal logistic regression over hashed word features.

Features of a text are the distinct words, word bigrams and skip-grams (two
words with one between), lower-cased, each hashed to one of ``2**bits``
coordinates.  FTRL-proximal with a rate for each coordinate and an L1 term is
fitted on a bounded sample of labelled rows (``max_rows``, texts of at most
``max_chars``), in one task; it leaves a sparse vector of non-zero weights that
is sent to every executor.  Its size is bounded by the sample, not the corpus.
The rates were chosen by log loss inside the learning rows alone (fitted on those with
remainder 0, judged on those with remainder 2), never on the held-out third.
Scoring covers every row and whole texts in one narrow pass, without a shuffle.

Defined results: a null or empty text has no features and scores the bias; a
repeated row is scored again; labels of one id are reduced to their maximum and its
texts to one to learn from; an empty label table gives the score 0.5; extra columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagetally.llm.common import cut, held_out, in_sample, ship, tidy
from usagetally.llm.words import PLAIN, mix, word_hashes, word_multipliers

ship(__name__)

BITS = 22
MAX_ROWS = 16_000
MAX_CHARS = 20_000
REJECT = 0.7


def features(text: str | None, bits: int, multipliers: np.ndarray) -> np.ndarray:
    """Distinct hashed coordinates of a text."""
    h, _, _ = word_hashes((text or "").encode("utf-8", "replace").translate(PLAIN), multipliers)
    if not len(h):
        return np.empty(0, np.int64)
    parts = [h.copy()]
    for gap in (1, 2):
        if len(h) > gap:
            parts.append(mix(h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:] + np.uint64(gap)))
    return np.unique(np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int, alpha: float, l1: float, l2: float,
         passes: int, weight: float = 1.0) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates and weights that aren't zero, and the bias.

    Each pass sees the rows in the given order; each coordinate keeps its own sum
    of squared gradients, hence its own rate.  ``weight`` multiplies the gradient
    of toxic rows, which are the rare ones."""
    size = 1 << bits
    z, n = np.zeros(size), np.zeros(size)
    toxic = sum(y for _, y in rows)
    bias = float(np.log((toxic + 0.5) / (len(rows) - toxic + 0.5)))
    for _ in range(passes):
        for at, y in rows:
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((1.0 + root) / alpha + l2))
            p = 1.0 / (1.0 + np.exp(-np.clip(bias + w.sum(), -35, 35)))
            g = (p - y) * (weight if y else 1.0)
            z[at] = zi + g - (np.sqrt(ni + g * g) - root) / alpha * w
            n[at] = ni + g * g
    kept = np.flatnonzero(np.abs(z) > l1)
    w = (np.sign(z[kept]) * l1 - z[kept]) / ((1.0 + np.sqrt(n[kept])) / alpha + l2)
    return kept, w, bias


def train(docs: DataFrame, labels: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS,
          max_chars: int = MAX_CHARS, alpha: float = 2.0, l1: float = 6.0, l2: float = 0.1,
          passes: int = 3, weight: float = 1.0) -> dict:
    """Fit on labelled rows outside the held-out third: ``{at, weight, bias, bits}``.

    ``max_rows`` bounds the rows: a hash of the id picks labels, one text of each
    id is learned from (the one with the least hash), and of more than ``max_rows``
    such rows those with the least hash of text and id.  ``max_chars`` bounds the
    length of a text to learn from."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y")))
    total = known.count()              # of the labels that may be learned from
    picked = known.where(in_sample(F.col("doc_id"), max_rows / max(total, 1), 10)).withColumnRenamed("doc_id", "id")
    # at most about max_rows narrow rows: a broadcast of proven size
    rows = (docs.select("doc_id", "text").where(F.char_length("text") <= max_chars)
            .join(F.broadcast(picked), F.col("doc_id") == F.col("id"))
            .groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text", "id").alias("at"), "text")).alias("one"))
            .select("one.at", "one.text", "y").orderBy("at", "text", "y").limit(max_rows))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        m = word_multipliers()
        pdf = pdf.sort_values(["at", "text", "y"], kind="stable")
        at, w, bias = ftrl([(features(t, bits, m), int(y)) for t, y in zip(pdf["text"], pdf["y"], strict=True)],
                           bits, alpha, l1, l2, passes, weight)
        return pd.DataFrame({"at": np.append(at, -1), "weight": np.append(w, bias)})

    fitted = cut(rows.groupBy(F.lit("all")).applyInPandas(fit, "at long, weight double"), "toxicity-weights").toPandas()
    fitted = fitted.sort_values("at", kind="stable")
    sparse = fitted[fitted["at"] >= 0]
    bias = fitted.loc[fitted["at"] < 0, "weight"]
    return {"bits": bits, "at": sparse["at"].to_numpy(), "weight": sparse["weight"].to_numpy(),
            "bias": float(bias.iloc[0]) if len(bias) else 0.0}


def scorer(spark, model: dict):
    """A column function text -> score; the sparse weights are broadcast once."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, dense = word_multipliers(), np.zeros(1 << sent.value["bits"], np.float32)
        dense[sent.value["at"]] = sent.value["weight"]
        for batch in texts:
            total = [float(dense[features(t, sent.value["bits"], m)].sum()) for t in batch]
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(np.array(total, float) + sent.value["bias"], -35, 35))))
        tidy()

    return score


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    score = scorer(docs.sparkSession, model)
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= REJECT).cast("int")))


def drop_toxic(docs: DataFrame, model: dict, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` (all columns) that score below ``reject``."""
    verdict: Column = scorer(docs.sparkSession, model)(F.col("text")) < reject
    return docs.where(verdict)


__all__ = ["train", "score_documents", "drop_toxic", "features", "ftrl", "REJECT"]
