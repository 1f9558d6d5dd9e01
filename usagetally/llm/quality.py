"""Quality rules (operator 9): a short-circuit cascade in built-in expressions only.

Each rule is a reject condition over the whole text.  Its cost (seconds a row)
and its selectivity (share of rows rejected) are measured on a bounded sample;
the rules then run in the order of rejection per cost inside one CASE, which
stops at the first rule that rejects.  The order changes the time and the name
of the first failed rule, never the verdict.

Arrays of one text are handled inside its row: no explode, no shuffle, no group.

Defined results: a null or empty text has no words and fails ``few_words``; a
repeated row gets its own verdict; an empty table keeps the rules' given order;
extra columns are kept by ``drop_low_quality`` and not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagetally.llm.common import BLANKS, cut, in_sample, let

WINDOW = 5
SAMPLE_ROWS = 2_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), lambda w: w != "")


def lines_of(text: Column) -> Column:
    """The ``\\n``-split lines that have a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0)).cast("long")


def duplicate_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeat_words(words: Column) -> Column:
    """Words that lie in a 5-word window found at least twice in the text.

    Windows are compared by a 64-bit hash.  Only a text that has a repeated
    window sorts its windows; neighbours of one hash are the repeats, and the
    union of their spans is the sum of the gaps between starts, at most 5 each."""
    def covered(windows: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(s, j + 1)["h"] == x["h"], F.lit(False))
            starts = F.array_sort(F.transform(F.filter(s, same), lambda x: x["i"]))
            return let(starts, lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
                F.lit(0), lambda total, x: total + x))
        return let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of_sorted)

    def of_hashes(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                              lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(let(hashes, of_hashes)).cast("long")


@dataclass(frozen=True)
class Measures:
    """The measures a rule may use: expressions over the text, or columns made before."""

    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_dup_lines: Column
    n_lines: Column
    n_repeat_words: Column

    @staticmethod
    def of_words(text: Column, w: Column) -> Measures:
        """Over a split that is made once (``w``: its words); a measure is worked out only where a rule asks for it."""
        return Measures(F.size(w).cast("long"), word_chars(w), symbols(text), let(lines_of(text), duplicate_lines),
                        F.size(lines_of(text)).cast("long"), repeat_words(w))

    @staticmethod
    def of_struct(m: Column) -> Measures:
        return Measures(*[m[n] for n in Measures.__dataclass_fields__])

    def struct(self) -> Column:
        return F.struct(*[getattr(self, n).alias(n) for n in Measures.__dataclass_fields__])


def measured(text: Column) -> Column:
    """All measures of a text as one struct; its words and lines are split once."""
    return let(F.struct(words_of(text).alias("w"), lines_of(text).alias("l")), lambda x: Measures(
        F.size(x["w"]).cast("long"), word_chars(x["w"]), symbols(text), duplicate_lines(x["l"]),
        F.size(x["l"]).cast("long"), repeat_words(x["w"])).struct())


#: name -> reject condition (true rejects).  The first two are the base rules.
RULES: dict[str, Callable[[Measures], Column]] = {
    "few_words": lambda m: m.n_words < 10,
    "repeated_words": lambda m: 100 * m.n_repeat_words > 20 * m.n_words,
    "word_length": lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 20 * m.n_words),
    "symbols": lambda m: 10 * m.n_symbols > 4 * m.n_words,
    "duplicate_lines": lambda m: 10 * m.n_dup_lines > 3 * m.n_lines,
}


def rule_order(docs: DataFrame, rules: dict[str, Callable[[Measures], Column]] | None = None,
               sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(name, share rejected, seconds a row), by rejection per cost, on about ``sample_rows`` rows.

    The sample (bounded: ``sample_rows`` expected, chosen by a hash of the id) is
    written once.  Rules share one split of a text, so a rule's cost is the time of split and
    rule less that of the split alone; the fastest of three runs counts, so that compiling and
    scheduling aren't charged to a rule."""
    rules = rules or RULES
    total = docs.count()
    if not total:
        return [(name, 0.0, 0.0) for name in rules]
    sample = cut(docs.select("doc_id", "text").where(in_sample(F.col("doc_id"), sample_rows / total, 9)).select("text"),
                 "quality-sample")

    def timed(rule: Callable[[Measures], Column]) -> tuple[float, int, int]:
        """Seconds, rows rejected and rows, over the shared split."""
        verdict, runs = over_words(F.col("text"), rule), []
        for _ in range(3):
            began = time.perf_counter()
            counts = sample.agg(F.count_if(verdict), F.count(F.lit(1))).first()
            runs.append((time.perf_counter() - began, *counts))
        return min(runs)

    split = timed(lambda m: m.n_words < 0)[0]
    found = []
    for place, (name, rule) in enumerate(rules.items()):
        seconds, rejected, n = timed(rule)
        found.append((name, rejected / max(n, 1), max(seconds - split, 0.02 * split) / max(n, 1), place))
    found.sort(key=lambda x: (-x[1] / max(x[2], 1e-12), x[3]))
    return [x[:3] for x in found]


def over_words(text: Column, body: Callable[[Measures], Column]) -> Column:
    """``body`` over the measures of a text whose words are split once."""
    return let(words_of(text), lambda w: body(Measures.of_words(text, w)))


def failed_rule(order: list[str], m: Measures, rules: dict[str, Callable[[Measures], Column]] | None = None) -> Column:
    """Name of the first rule that rejects, in the given order; null for a kept text."""
    verdict = None
    for name in order:
        reject = (rules or RULES)[name](m)
        verdict = F.when(reject, name) if verdict is None else verdict.when(reject, name)
    return verdict


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed, failed_rule and kept of every row."""
    order = [name for name, *_ in rule_order(docs)]
    base = docs.select("doc_id", measured(F.col("text")).alias("m"))
    m = Measures.of_struct(F.col("m"))
    return (base.select("doc_id", "m.*", (RULES["few_words"](m) | RULES["repeated_words"](m)).alias("base_failed"),
                        failed_rule(order, m).alias("failed_rule"))
            .withColumn("kept", F.col("failed_rule").isNull()))


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that every rule keeps; later rules aren't run on rejected rows."""
    order = [name for name, *_ in rule_order(docs)]
    return docs.where(over_words(F.col("text"), lambda m: failed_rule(order, m)).isNull())


__all__ = ["quality_report", "drop_low_quality", "rule_order", "failed_rule", "over_words", "RULES", "Measures", "measured"]
