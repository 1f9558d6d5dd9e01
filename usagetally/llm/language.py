"""Language identification (operator 1): string kernels, Nystroem landmarks, kernel ridge regression.

The kernel of two texts is the blended-spectrum presence kernel: the number of
code-point n-grams (n = 1, 2, 3, lower-cased) present in both, over the square
root of the product of their numbers of present n-grams.  n-grams are those of the
landmark texts.  Nystroem: a text is described by its kernel values with the
landmarks, whitened by the landmarks' own kernel matrix; ridge regression fits one
score for each language against the rest.

Learning uses a bounded sample (``max_rows`` texts of at most ``max_chars``
code points, spread evenly over the languages).  Scoring covers whole texts of
all rows in one narrow pass: presence rows of a block of texts times the
landmarks' presence matrix, times the fitted matrix.

Defined results: a text that is null or has no letter is ``und`` with score 0;
repeated rows are scored alike; with nothing to learn from, every row is ``und``;
an empty table gives no rows; extra columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.llm.common import batches_of, cut, held_out, ship

ship(__name__)

ORDERS = (1, 2, 3)
#: Sample to learn from: rows, and first code points of a text.
MAX_ROWS, MAX_CHARS = 3_000, 4_000
LANDMARKS, GRAMS = 160, 12_000
SLOTS = 20
RIDGE = 1e-3
UNKNOWN = "und"


def gram_codes(text: str, n: int) -> np.ndarray:
    """The n-grams of a lower-cased text, each as one number (21 bits a code point)."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    codes = points[: max(len(points) - n + 1, 0)].copy()
    for j in range(1, n):
        codes = (codes << 21) | points[j : j + len(codes)]
    return codes


def slot(codes: np.ndarray) -> np.ndarray:
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).astype(np.int64)


def grams_of(landmarks: list[str], most: int = GRAMS) -> dict:
    """The n-grams present in most landmarks (at most ``most``), with a look-up table for each order."""
    found: dict[tuple[int, int], int] = {}
    for text in landmarks:
        for n in ORDERS:
            for c in np.unique(gram_codes(text, n)).tolist():
                found[n, c] = found.get((n, c), 0) + 1
    chosen = sorted(found, key=lambda g: (-found[g], g))[:most]
    tables, size = {}, 0
    for n in ORDERS:
        codes = np.array([c for m, c in chosen if m == n], np.int64)
        if len(codes):
            codes = codes[np.sort(np.unique(slot(codes), return_index=True)[1])]    # one n-gram a slot
        table = np.zeros(1 << SLOTS, np.int32)
        table[slot(codes)] = np.arange(1, len(codes) + 1)
        tables[n] = (codes, table, size)
        size += len(codes)
    return {"tables": tables, "size": size}


def presence(texts: list[str], grams: dict) -> np.ndarray:
    """A row for each text: 1 where it has the n-gram."""
    rows = np.zeros((len(texts), grams["size"] + 1), np.float32)
    for row, text in zip(rows, texts, strict=True):
        for n, (codes, table, first) in grams["tables"].items():
            if not len(codes):
                continue
            for a in range(0, max(len(text), 1), 1 << 18):      # long texts in overlapping pieces
                own = gram_codes(text[a : a + (1 << 18) + n - 1], n)
                at = table[slot(own)]
                at = at[(at > 0) & (codes[at - 1] == own)]
                row[at - 1 + first] = 1
    return rows[:, :-1]


def kernel(rows: np.ndarray, landmark_rows: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of two sets of rows."""
    norm = np.sqrt(np.maximum(rows.sum(axis=1), 1))[:, None] * np.sqrt(np.maximum(landmark_rows.sum(axis=1), 1))
    return rows @ landmark_rows.T / norm


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> dict:
    """Nystroem features of the sample and ridge regression of +1 / -1 for each language against the rest."""
    classes = sorted(set(langs))
    if not classes:
        return {"classes": []}
    by_class = [[t for t, x in zip(texts, langs, strict=True) if x == c] for c in classes]
    each = max(1, landmarks // len(classes))
    chosen = [t for own in by_class for t in list(dict.fromkeys(own))[:each]]
    grams = grams_of(chosen)
    base = presence(chosen, grams)
    value, vector = np.linalg.eigh(kernel(base, base).astype(np.float64))
    use = value > value.max() * 1e-6
    whiten = vector[:, use] / np.sqrt(value[use])
    gram = np.zeros((use.sum() + 1,) * 2)
    moment = np.zeros((use.sum() + 1, len(classes)))
    for a in range(0, len(texts), 256):
        x = kernel(presence(texts[a : a + 256], grams), base) @ whiten
        x = np.hstack([x, np.ones((len(x), 1))])
        y = np.array([[1.0 if lang == c else -1.0 for c in classes] for lang in langs[a : a + 256]])
        gram += x.T @ x
        moment += x.T @ y
    solved = np.linalg.solve(gram + ridge * len(texts) * np.eye(len(gram)), moment)
    return {"classes": classes, "grams": grams, "base": base, "matrix": (whiten @ solved[:-1]).astype(np.float32),
            "offset": solved[-1]}


def predict(texts: list[str], model: dict) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1) of each text."""
    if not model["classes"]:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    scores = kernel(presence(texts, model["grams"]), model["base"]) @ model["matrix"] + model["offset"]
    best = scores.argmax(axis=1)
    return [model["classes"][i] for i in best], np.clip((scores[np.arange(len(best)), best] + 1) / 2, 0, 1)


def train(docs: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> dict:
    """Fit on rows with a language outside the held-out third.  Bounded by ``max_rows``
    rows, of which the first ``max_chars`` code points are learned from, in expectation equally many for
    each language.  A hash of id and text picks rows, equal ones count once, and of more than
    ``max_rows`` those with the least hash reach the driver; of every language, however rare or long its texts, the
    text with the least hash is among them as long as there are no more languages than rows."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    usable = usable.select(F.substring("text", 1, max_chars).alias("text"), "lang", F.xxhash64("doc_id", "text").alias("at"))
    counts = usable.groupBy(F.col("lang").alias("of")).agg(F.approx_count_distinct("at").alias("n"), F.min("at").alias("least"))
    counts = cut(counts, "language-counts")
    languages = counts.count()
    if not languages:
        return {"classes": []}
    drawn = F.pmod(F.xxhash64("at", F.lit(1)), F.lit(1 << 30)) < F.lit(max_rows / languages * (1 << 30)) / F.col("n")
    sample = (usable.join(counts, F.col("lang") == F.col("of")).withColumn("first", F.col("at") == F.col("least"))
              .where(drawn | F.col("first")).select("text", "lang", "at", "first").distinct()
              .orderBy(F.desc("first"), "at", "lang", "text").limit(max_rows).select("text", "lang").toPandas().sort_values(["lang", "text"]))
    sample = sample.sample(frac=1, random_state=1) if len(sample) else sample
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in batches_of(texts, rows=64, chars=4 << 20):
                full = [i for i in range(a, b) if texts[i] is not None]
                lang, score = np.full(b - a, UNKNOWN, object), np.zeros(b - a)
                if full:
                    at = np.array(full) - a
                    lang[at], score[at] = predict([texts[i] for i in full], sent.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(lang, pa.string()),
                     pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), lettered.alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


__all__ = ["train", "identify", "fit", "predict", "kernel", "presence", "grams_of"]
