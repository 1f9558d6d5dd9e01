"""Spelling variants (operator 13): Bloom-guided neighbourhoods of a corpus vocabulary.

1. Words are the letter runs of whole texts (``vocabulary``), counted per task and
   then by Spark; the vocabulary is a written table.
2. Blocked Bloom filters, one shard a word length, hold every word: a word sets one
   bit in each of the eight longs of its block.  The blocks are made by Spark (bits
   joined by OR), and what is broadcast at a time is at most ``FILTER_BYTES``: a larger
   vocabulary is dealt by hash over several rounds, each with filters of its own.
3. Each word's edits are generated in arrays: every deletion, and every replacement
   by a later symbol, so that each pair of near words is generated from one side
   alone (an insertion is the deletion seen from the longer word).  A positional
   hash gives the hash of an edit without spelling it out.  Only edits that the
   filter of their length holds are spelt out and shuffled.
4. An exact join with the vocabulary removes the filters' false positives.  Filters
   have no false negatives, so no pair is lost at any size.
5. Each word takes the form its near words decide; forms are followed to the
   root by pointer doubling (a form occurs ``RATIO`` times as often as its word, so
   chains are short).

Defined results: a null or empty text, or one without long runs, gives no words;
a null id hashes as empty text; repeated rows count again; ties between forms go to
the smallest word in code-point order; a very long run is one word like any other;
an empty table gives no rows; extra columns are neither read nor returned.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.llm.common import cut, ship
from usagetally.llm.words import mix, salts

ship(__name__)

#: Least code points and occurrences of a word, and how much more often its form occurs.
SHORTEST, LEAST, RATIO = 7, 2, 10
#: One run in so many loses a code point.
SLIPS = 31
#: The symbols of words, in code-point order.
SYMBOLS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
#: Filter bits for each word, longs of a block, and the bytes of filters that are broadcast at a time.
BITS_EACH, LONGS, FILTER_BYTES = 16, 8, 32 << 20
#: Words of this length and longer share a shard.
LONG = 65
#: Words that a task counts before it hands them on; edits that are probed at a time; code points handed on at a time.
HELD, AT_ONCE, CHARS = 200_000, 1 << 19, 4 << 20

RUNS = re.compile("[A-Za-zÀ-ÿ]{%d,}" % SHORTEST)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = np.uint64(pow(_STEP, -1, 1 << 64))


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """The words of one text with their occurrences, slips applied."""
    found: Counter = Counter()
    if not text:
        return found
    lowered = text.encode("utf-8", "replace").translate(LOWER).decode("utf-8")
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUNS.findall(lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % SLIPS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= SHORTEST:
            found[run] += n
    return found


def vocabulary(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """word, n of the words of ``docs`` (doc_id, text) with at least ``least`` occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                             ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                total.update(words_of(doc_id.as_py(), text.as_py()))
                if len(total) > HELD:
                    yield hand_on()
        yield hand_on()

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- hashes of words and of their edits

def powers(size: int) -> np.ndarray:
    steps = np.full(size, _STEP, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def symbol_values() -> np.ndarray:
    """A value for each place of the symbol list."""
    return salts(len(SYMBOLS), 13)


def symbol_places(words: list[str]) -> np.ndarray:
    """Words of one length as rows of places in the symbol list."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    return np.searchsorted(np.array(SYMBOLS, np.uint32), points)


def finished(h: np.ndarray, length: int) -> np.ndarray:
    return mix(h + np.uint64(length))


def word_hash(places: np.ndarray) -> np.ndarray:
    """Sum of symbol value times a power by position, before finishing."""
    return (symbol_values()[places] * powers(places.shape[1])).sum(axis=1, dtype=np.uint64)


def deletions(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word without one code point (words x positions), and which to use: of equal neighbours only the first."""
    terms = symbol_values()[places] * powers(places.shape[1])
    ahead = np.cumsum(terms, axis=1, dtype=np.uint64)
    h = (ahead - terms) + (ahead[:, -1:] - ahead) * _BACK
    use = np.ones(places.shape, bool)
    use[:, 1:] = places[:, 1:] != places[:, :-1]
    return h, use


def replacements(places: np.ndarray, first: int, last: int, symbols: np.ndarray) -> np.ndarray:
    """Hashes of each word with a symbol of ``symbols`` at a position of [first, last): words x positions x symbols."""
    values = symbol_values()
    part = places[:, first:last]
    change = (values[symbols] - values[part][:, :, None]) * powers(last)[first:last][:, None]
    return word_hash(places)[:, None, None] + change


class Layout:
    """Where a hash lies in the filters: round, block and bits."""

    def __init__(self, sizes: dict[int, int], bound: int = FILTER_BYTES):
        each = 64 * LONGS
        self.rounds = max(1, -(-sum(sizes.values()) * BITS_EACH // (8 * bound)))
        self.blocks = {s: -(-n * BITS_EACH // (each * self.rounds)) for s, n in sizes.items()}
        self.first, at = {}, 0
        for s in sorted(self.blocks):
            self.first[s] = at
            at += self.blocks[s]
        self.total = at

    def shard(self, length: int) -> int:
        return min(length, LONG)

    def round_of(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(40)) % np.uint64(self.rounds)

    def block(self, h: np.ndarray, shard: int) -> np.ndarray:
        return (np.uint64(self.first[shard]) + (h & np.uint64(0xFFFFFFFF)) % np.uint64(self.blocks[shard])).astype(np.int64)

    def bit(self, h: np.ndarray, j: int) -> np.ndarray:
        """The bit that a hash sets in long ``j`` of its block."""
        return np.uint64(1) << ((h * salts(LONGS, 17)[j]) >> np.uint64(58))


def filter_rows(words: DataFrame, layout: Layout) -> DataFrame:
    """round, block and the longs b0.. of all blocks that hold a word."""
    names = [f"b{j}" for j in range(LONGS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in by_length(batch.column(0).to_pylist()):
                h = finished(word_hash(symbol_places(group)), len(group[0]))
                bits = [pa.array(layout.bit(h, j).view(np.int64)) for j in range(LONGS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(layout.round_of(h).astype(np.int32)), pa.array(layout.block(h, layout.shard(len(group[0])))), *bits],
                    ["round", "block", *names])

    rows = words.select("word").mapInArrow(run, "round int, block long, " + ", ".join(f"{n} long" for n in names))
    return rows.groupBy("round", "block").agg(*[F.bit_or(n).alias(n) for n in names])


def by_length(words: list[str]) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    yield from groups.values()


def held(h: np.ndarray, length: int, layout: Layout, number: int, table: np.ndarray) -> np.ndarray:
    """Places in ``h`` of the edits of ``length`` that the filters of round ``number`` hold."""
    shard = layout.shard(length)
    if not layout.blocks.get(shard):
        return np.empty(0, np.int64)
    h = finished(h, length)
    left = np.arange(len(h)) if layout.rounds == 1 else np.flatnonzero(layout.round_of(h) == number)
    h = h[left]
    at = layout.block(h, shard) * LONGS
    for j in range(LONGS):
        bit = layout.bit(h, j)
        ok = (table[at + j] & bit) == bit
        left, h, at = left[ok], h[ok], at[ok]
    return left


def probed(group: list[str], layout: Layout, number: int, table: np.ndarray, symbols: np.ndarray) -> Iterator[tuple[int, str]]:
    """(number of the word, edit) of the edits of words of one length that pass the filters."""
    size, step = len(group[0]), max(1, AT_ONCE // (len(group[0]) * 8))
    for a in range(0, len(group), step):
        words = group[a : a + step]
        places = symbol_places(words)
        h, use = deletions(places)
        who, where = np.nonzero(use)
        for k in held(h[who, where], size - 1, layout, number, table).tolist():
            w, i = words[who[k]], where[k]
            yield a + int(who[k]), w[:i] + w[i + 1 :]
        width = max(1, AT_ONCE // (len(words) * len(symbols)))
        for first in range(0, size, width):
            last = min(size, first + width)
            later = symbols > places[:, first:last, None]
            h = replacements(places, first, last, symbols)[later]
            hit = held(h, size, layout, number, table)
            if len(hit):
                who, where, what = (x[hit] for x in np.nonzero(later))
                for k, i, s in zip(who.tolist(), (where + first).tolist(), symbols[what].tolist(), strict=True):
                    yield a + k, words[k][:i] + chr(SYMBOLS[s]) + words[k][i + 1 :]


def candidates(words: DataFrame, layout: Layout, blocks: DataFrame, number: int, symbols: np.ndarray) -> DataFrame:
    """word, n, near: the edits of each word that the filters of one round hold."""
    found = blocks.where(F.col("round") == number).drop("round").toArrow()       # at most FILTER_BYTES of longs
    table = np.zeros(layout.total * LONGS, np.uint64)
    at = found["block"].to_numpy()
    for j in range(LONGS):
        table[at * LONGS + j] = found[f"b{j}"].to_numpy().view(np.uint64)
    sent = words.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for group in by_length(list(counts)):
                rows, held_chars = [], 0
                for k, near in probed(group, layout, number, sent.value, symbols):
                    rows.append((group[k], counts[group[k]], near))
                    held_chars += len(near)
                    if held_chars > CHARS:
                        yield record(rows)
                        rows, held_chars = [], 0
                yield record(rows)

    def record(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                                           pa.array(columns[2], pa.string())], ["word", "n", "near"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, near string")


def near_pairs(words: DataFrame, bound: int = FILTER_BYTES) -> DataFrame:
    """word, n, near, near_n: each pair of near words of a written vocabulary once."""
    sizes = {r[0]: r[1] for r in words.groupBy(F.least(F.char_length("word"), F.lit(LONG))).count().collect()}  # a row a shard
    layout = Layout(sizes, bound)
    used = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()      # the symbols
    symbols = np.array(sorted(SYMBOLS.index(ord(r.c)) for r in used), np.int64)
    blocks = cut(filter_rows(words, layout), "spelling-filters")
    right = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = None
    for number in range(layout.rounds):
        some = cut(cut(candidates(words, layout, blocks, number, symbols), "spelling-positives").join(right, "near")
                   .select("word", "n", "near", "near_n"), "spelling-pairs")
        found = some if found is None else found.union(some)
    return found


def roots(links: DataFrame) -> DataFrame:
    """word, root: the end of each chain of ``links`` (word, form), by pointer doubling."""
    now = cut(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        joined = now.join(onward, F.col("root") == F.col("__word"), "left")
        step = cut(joined.select("word", F.coalesce("__root", "root").alias("root"),
                                 F.col("__root").isNotNull().alias("moved")), "spelling-roots")
        now = step.drop("moved")
        if step.where("moved").isEmpty():
            return now


def group_variants(words: DataFrame, ratio: int = RATIO, bound: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of a vocabulary (word, n)."""
    words = cut(words.select("word", "n"), "spelling-words")
    if words.isEmpty():
        return words.selectExpr("word", "word as form", "word as root", "n", "n as n_near", "n as form_n")
    pairs = near_pairs(words, bound)
    each = pairs.select("word", "near", "near_n").union(pairs.select("near", "word", "n"))
    best = each.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("most"))
    formed = (-F.col("most.less")) >= ratio * F.col("n")
    named = cut(words.join(best, "word", "left").select(
        "word", F.when(formed, F.col("most.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, -F.col("most.less")).alias("form_n")), "spelling-forms")
    ends = roots(named.where("form is not null"))
    return (named.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


__all__ = ["vocabulary", "group_variants", "near_pairs", "roots", "words_of", "Layout"]
