"""Document fingerprints (operator 4): I-Match over randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band:
neither the very common ones nor those of a few documents.  A text keeps its
distinct lexicon terms; for each of ``SUBSETS`` random subsets of the lexicon the
sorted terms of the text that are in the subset are hashed.  The fingerprint is
the row of these hashes (``....`` for a subset without a term).  The likeness of
two fingerprints is the share of equal hashes among the subsets where either has
a term.

The lexicon's size has a bound that doesn't grow with the corpus: a term of at
least a share f of the N documents takes f * N of all (document, term) pairs, so
there are at most (mean distinct terms a document) / f of them.  It is counted
over all documents and broadcast as sorted 64-bit hashes: 8 bytes a term, 32 MB for
a mean of 2,000 distinct terms.

The next document is found by range partitioning on id and a hash of the text: the first
key of each of ``PLACES_ROWS``-row ranges comes from a pass over keys alone, and the row
with such a key is sent to the range before it too.  Null or repeated ids are split by
the hash, equal rows are put together before the shuffle.

Defined results: a null text counts as empty; a text without any lexicon term
gets ``=`` and a hash of all its distinct terms (or of the whole text, if it has no
term), which is like an equal fingerprint (1) and unlike any other (0); equal texts
have equal fingerprints; ids that tie are ordered by a hash of the text, null ids come
first; an
empty table gives no rows; extra columns are neither read nor returned.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.llm.common import ship

ship(__name__)

#: The band: terms of at least LEAST and at most MOST of all documents.
LEAST, MOST = 1 / 2_000, 1 / 10
SUBSETS = 128
NONE = "...."
#: Rows of a range of neighbours; equal rows (id and text) and bytes that a task holds to put them together.
PLACES_ROWS, HELD_ROWS, HELD_BYTES = 2_000, 2_000, 16 << 20


def terms_of(text: str) -> set[str]:
    return set(re.findall(r"\w+", text.lower()))


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """Terms of the band, counted over all documents; a task adds up its documents before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                             ["term", "n"])
            seen.clear()
            return out

        for batch in batches:
            for t in batch.column(0):
                seen.update(terms_of(t.as_py()))
                if len(seen) > 300_000:
                    yield flush()
        yield flush()

    total = docs.count()
    return (docs.where(F.col("text").isNotNull()).select("text").mapInArrow(count, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= least * total) & (F.col("n") <= max(most * total, 1))).select("term"))


def term_hashes(terms) -> np.ndarray:
    """Sorted distinct 64-bit hashes of terms."""
    return np.unique(np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) for t in terms], np.uint64))


def subset_of(hashes: np.ndarray) -> np.ndarray:
    """The random subset that each lexicon term belongs to."""
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(SUBSETS)


def fingerprint(text: str, lexicon_hashes: np.ndarray) -> str:
    """One 16-bit hash of the sorted terms for each lexicon subset."""
    found = terms_of(text)
    h = term_hashes(found)
    if len(lexicon_hashes):
        at = np.minimum(np.searchsorted(lexicon_hashes, h), len(lexicon_hashes) - 1)
        h = h[lexicon_hashes[at] == h]
    if not len(h) or not len(lexicon_hashes):
        return "=" + blake2b("\n".join(sorted(found) or [text]).encode("utf-8", "replace"), digest_size=16).hexdigest()
    subset = subset_of(h)
    order = np.argsort(subset, kind="stable")            # within a subset the terms stay sorted
    h, subset = h[order], subset[order]
    edges = np.flatnonzero(np.diff(subset)) + 1
    parts = [NONE] * SUBSETS
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(h)], strict=True):
        parts[int(subset[a])] = blake2b(h[a:b].tobytes(), digest_size=2).hexdigest()
    return "".join(parts)


def likeness(a: str, b: str) -> float:
    if a[0] == "=" or b[0] == "=":
        return float(a == b)
    pairs = [(a[i : i + 4], b[i : i + 4]) for i in range(0, len(a), 4)]
    filled = [x == y for x, y in pairs if x != NONE or y != NONE]
    return sum(filled) / len(filled)


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many first code points of ``following`` (or all)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def keyed(docs: DataFrame) -> DataFrame:
    """given (false for a null id), doc_id, tie, text: the first three order the rows."""
    text = F.coalesce("text", F.lit(""))
    i = F.col("doc_id").cast("long")
    return docs.select(i.isNotNull().alias("given"), F.coalesce(i, F.lit(0)).alias("doc_id"), F.xxhash64(text).alias("tie"),
                       text.alias("text"))


def first_keys(rows: DataFrame, each: int) -> list[tuple]:
    """The first key of each range of about ``each`` rows, from a range-partitioned sort of the keys alone.

    One key a range reaches the driver: 1 / ``each`` of the table, about 20 bytes each."""
    key = ("given", "doc_id", "tie")
    ranges = max(1, -(-rows.count() // each))
    # some rows more in a range if many tie, since a key is never cut in two
    firsts = (rows.select(*key).repartitionByRange(ranges, *key).groupBy(F.spark_partition_id().alias("place"))
              .agg(F.min(F.struct(*key)).alias("first")))
    return sorted({tuple(r.first) for r in firsts.collect()})


def with_next(docs: DataFrame, rows_each: int = PLACES_ROWS) -> DataFrame:
    """place, peek, given, doc_id, tie, packed, n: documents dealt to ranges of keys, each range with a copy of the row that
    follows it (``peek`` 1; 2 for the first of all, which follows the last range).

    ``n`` equal rows of a task come as one.  Texts move in one shuffle, compressed, which halves what is written."""
    rows = keyed(docs)
    firsts = first_keys(rows, rows_each)
    bounds, start = firsts[1:], firsts[0] if firsts else None

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0

        def hand_on() -> pa.RecordBatch:
            out = []
            for key, (packed, n) in held.items():
                place = bisect_right(bounds, key)
                out.append((place, 0, *key, packed, n))
                if place and bounds[place - 1] == key:
                    out.append((place - 1, 1, *key, packed, 1))
                if key == start:
                    out.append((len(bounds), 2, *key, packed, 1))
            held.clear()
            columns = list(zip(*out, strict=True)) or [[] for _ in DEALT]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, DEALT.values(), strict=True)], list(DEALT))

        for batch in batches:
            for given, i, tie, text in zip(*(batch.column(k) for k in range(4)), strict=True):
                key = given.as_py(), i.as_py(), tie.as_py()
                if key in held:
                    held[key][1] += 1
                    continue
                packed = zlib.compress(text.as_py().encode("utf-8", "replace"), 3)
                held[key] = [packed, 1]
                size += len(packed)
                if len(held) >= HELD_ROWS or size > HELD_BYTES:
                    yield hand_on()
                    size = 0
        yield hand_on()

    dealt = rows.mapInArrow(deal, "place int, peek int, given boolean, doc_id long, tie long, packed binary, n long")
    return dealt.repartitionById(max(1, len(bounds) + 1), "place").sortWithinPartitions("place", "peek", "given", "doc_id", "tie")


#: The columns of dealt rows.
DEALT = {"place": pa.int32(), "peek": pa.int32(), "given": pa.bool_(), "doc_id": pa.int64(), "tie": pa.int64(),
         "packed": pa.binary(), "n": pa.int64()}


def fingerprints(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(term_hashes(batch.column(0).to_pylist()).view(np.int64))], ["h"])

    found = terms.mapInArrow(hashed, "h long").toArrow()["h"].to_numpy()       # a bounded lexicon, see above
    sent = spark.sparkContext.broadcast(np.unique(found.view(np.uint64)))
    dealt = with_next(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon_hashes, names = sent.value, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                      "near_edited", "near_next"]
        waiting, out = None, []              # the last document, until its next one is known

        def pair(following: str, next_print: str) -> None:
            i, text, own = waiting
            edited = edited_text(text, following)
            other = own if edited == text else fingerprint(edited, lexicon_hashes)
            out.append((i, len(text), sha256(edited.encode("utf-8", "replace")).hexdigest(), own, other,
                        likeness(own, other), likeness(own, next_print)))

        def flush() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = list(zip(*out, strict=True)) or [[] for _ in names]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        place = None
        for batch in batches:
            for to, peek, given, i, packed, n in zip(*(batch.column(k) for k in range(6)), strict=True):
                to, peek, n = to.as_py(), peek.as_py(), n.as_py()
                if to != place:
                    waiting, place = None, to
                if peek and waiting is None:
                    continue                 # only the first row after a range follows it
                text = zlib.decompress(packed.as_py()).decode()
                own = fingerprint(text, lexicon_hashes)
                if waiting is not None:
                    pair(text, own)
                waiting = None if peek else (i.as_py() if given.as_py() else None, text, own)
                if not peek and n > 1:       # equal rows follow one another
                    pair(text, own)
                    same = out.pop()
                    for _ in range(n - 1):
                        out.append(same)
                        if len(out) >= 500:
                            yield flush()
                if len(out) >= 500:
                    yield flush()
        yield flush()

    return dealt.select("place", "peek", "given", "doc_id", "packed", "n").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


__all__ = ["lexicon", "fingerprints", "fingerprint", "likeness", "edited_text", "terms_of", "with_next"]
