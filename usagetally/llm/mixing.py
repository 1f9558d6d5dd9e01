"""Mixing sources to target weights (operator 8): Poisson replication, built-in expressions only.

Each source gets the mean repetition rate
``rate = share of its target weight * budget / its documents``.  A document's
number of copies is the inverse of the Poisson distribution with that mean at a
uniform number hashed from its id and a seed (without an id, from all its columns
and its number among equal rows); the document is exploded by that
count and all copies are shuffled by a hash of (id, copy, seed).  Counts of
documents with the same rate are independent, so a source's total has the
target as its mean.  A rate above ``STEP`` is split into equal parts whose
independent Poisson counts add up, so no exponent underflows and no copy count
is capped.

Defined results: a null source is a source of its own; each row without an id has a
draw of its own, equal rows too; a null or empty text is mixed like any other; repeated
rows of one id share its count; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagetally.llm.common import cut, free_name, let

#: Largest mean inverted at once; the walk over the distribution ends after TERMS counts,
#: where its tail is below 2**-52, the resolution of the hashed uniform number.
STEP = 8.0
TERMS = 48
#: Above this many sources the rates are joined without a broadcast.
BROADCAST_SOURCES = 10_000
#: Equal rows without an id are numbered in blocks of this many, each block in any task.
BLOCK = 1_000
CONTRACT = ("text", "lang", "source", "n_chars")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of the parts, joined by ':'."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """P(count <= n) for n = 0 .. TERMS, for a mean up to STEP."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)), start,
        lambda s, k: F.struct((s["p"] * mean / k).alias("p"), F.concat(
            s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * mean / k)).alias("cdf")))["cdf"]


def copies(key: Column, parts: Column, cdf: Column, seed: int) -> Column:
    """Sum of ``parts`` inverted Poisson counts, fixed by key and seed.

    The inverse at u is the number of cumulative probabilities that don't exceed u."""
    inverse = lambda u: F.size(F.filter(cdf, lambda c: c <= u))
    return F.aggregate(
        F.sequence(F.lit(1), parts), F.lit(0),
        lambda total, j: total + let(uniform(F.lit(str(seed)), j.cast("string"), key), inverse))


def keyed(docs: DataFrame) -> DataFrame:
    """``__row`` and ``__key``, the text that is hashed: the id, or for a row without one the
    digest of its columns, followed by its number among equal rows (the first has none).
    Where all of CONTRACT is null the empty text stands for the digest.

    Equal rows are counted and made again, so which of them has which number is no matter
    and a large group of them is neither sorted nor numbered in one task."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("__row")
    bare_row = F.coalesce(*[F.col("__row")[c].cast("string") for c in CONTRACT if c in docs.columns]).isNull()
    groups = (docs.where(docs["doc_id"].isNull()).select(row).groupBy("__row").agg(F.count(F.lit(1)).alias("__rows"))
              .withColumn("__key", F.when(bare_row, "").otherwise(F.md5(F.to_json("__row").cast("binary"))))
              .withColumn("__first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__rows") - 1, F.lit(BLOCK).cast("long"))))
              .repartition("__key", "__first"))
    number = F.explode(F.sequence(F.col("__first"), F.least(F.col("__first") + BLOCK, F.col("__rows")) - 1))
    numbered = (groups.select("__row", "__key", number.alias("__number"))
                .withColumn("__key", F.when(F.col("__number") == 0, F.col("__key")).otherwise(F.concat_ws(":", "__key", "__number"))))
    return docs.where(docs["doc_id"].isNotNull()).select(row, docs["doc_id"].cast("string").alias("__key")).unionByName(numbered.select("__row", "__key"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0,
                budget: float = 1.0, seed: int = 8, numbered: bool = True) -> DataFrame:
    """Documents replicated to the target weights and shuffled globally.

    ``weights``: target weight by source; a source not listed (and null) gets
    ``default_weight``; 0 leaves a source out.  ``budget``: expected output rows
    as a multiple of the input rows.  With ``numbered``, a column ``copy``
    (0, 1, ..) is appended; its name gets a ``_`` where the table has it."""
    names, weights = docs.columns, weights or {}
    source = F.col("source")
    target = F.lit(float(default_weight))
    for name, w in sorted(weights.items()):
        target = F.when(source == name, float(w)).otherwise(target)
    sizes = cut(docs.groupBy("source").agg(F.count(F.lit(1)).alias("docs")).withColumn("weight", target), "mix-sizes")
    total, weight, n_sources = sizes.agg(F.sum("docs"), F.sum("weight"), F.count(F.lit(1))).first()
    rate = (F.col("weight") / F.lit(float(weight or 1)) * F.lit(float(budget * (total or 0))) / F.col("docs"))
    parts = F.greatest(F.ceil(rate / STEP), F.lit(1)).cast("int")
    rates = sizes.select(F.col("source").alias("__source"), parts.alias("__parts"), poisson_cdf(rate / parts).alias("__cdf"))
    if n_sources <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    counted = (keyed(docs).join(rates, F.col("__row")["source"].eqNullSafe(F.col("__source")))
               .withColumn("__n", copies(F.col("__key"), F.col("__parts"), F.col("__cdf"), seed)).where(F.col("__n") > 0))
    spread = (counted.select("__row", "__key", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("__copy"))
              .withColumn("__at", F.xxhash64("__key", "__copy", F.lit(seed))))
    mixed = spread.repartition(F.col("__at")).sortWithinPartitions("__at")
    extra = [F.col("__copy").alias(free_name(docs, "copy"))] if numbered else []
    return mixed.select(*[F.col("__row")[c].alias(c) for c in names], *extra)


__all__ = ["mix_sources", "keyed", "copies", "poisson_cdf", "uniform"]
