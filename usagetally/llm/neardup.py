"""MinHash near-duplicates with odd sketches (operator 2).

1. Each text becomes its set of word shingles (64-bit hashes).  Its MinHash
   samples are cut into bands; the same samples are folded into a parity bitmap,
   the odd sketch: each (sample number, minimum) flips one bit.  The XOR of two
   sketches has a population count that estimates a high Jaccard similarity from
   a few machine words.
2. Equal sets collapse to one representative, so a group of thousands of copies
   costs one row from here on.
3. Representatives that share a band meet in a bucket.  Each is compared with the
   smallest of its bucket (a star, linear in the bucket): sketches sift the
   candidates, the full shingle sets confirm them, confirmed links are joined to
   components.  A document's smallest pivots come first, the others only where
   they still lie in another component.
4. Buckets whose members still lie in different components are searched again, and
   only pairs of different components whose set sizes allow the similarity are looked at:
   * a bucket with at most ``WIDE`` members outside its largest component: these
     against all members of other components, which is linear in the bucket, sifted inside
     the join by finer odd sketches (eight times the samples);
   * a wider bucket, such as pages of one template that are all a little too different:
     an exact prefix join of its members' shingles, sifted inside the join as well.  Shingles are ordered by how many
     members have them, rarest first; two sets at the similarity share one of the first
     few of the order, however the rest looks.  A template's shingles are the commonest and
     come last, so such pages never meet, and the work follows the rare shingles shared.
   Candidates are confirmed on full sets.  So every pair that shares a band is either
   confirmed, refused, or already connected; nothing is capped.

With 32 bands of 4 samples a pair at similarity 0.8 misses all bands with
probability 5e-8; a sketch refuses it with probability ``REFUSED`` at most (from the exact
distribution of the weight of two sketches: binomial samples, parity of random bits).

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; rows of one id are one document (links of any of its
texts count); a row with a null id is returned with a null component, kept; an
empty table gives no rows; extra columns are neither read nor returned, but
``drop_near_duplicates`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagetally.llm.common import batches_of, cut, free_name, ship, tidy
from usagetally.llm.words import mix, salts, shingles, word_hashes, word_multipliers

ship(__name__)

SAMPLES, BANDS = 128, 32
#: Samples of the finer sketches, made only for documents of buckets that stay open after the stars.
FINE_SAMPLES = 1024
#: Bits of a sketch for each of its samples.
BITS_EACH = 4
#: Largest probability that a sketch refuses a pair at the similarity.
REFUSED = 1e-7
#: Members outside its largest component up to which an open bucket is searched member by member: so many
#: comparisons of sketches (2 to 3 microseconds each) cost about as much as sorting one member's shingles.
WIDE = 1_024
#: Smallest pivots of a document that are compared first; the others are compared only where
#: these links leave them in another component, so a large group isn't compared BANDS times over.
FIRST_PIVOTS = 3
#: Up to this many ids (16 MB) the texts to confirm are picked by a broadcast, beyond it by a shuffled join.
BROADCAST_IDS = 2_000_000


def text_shingles(text: str | None, words: int, multipliers: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, A-Z lower-cased."""
    h, _, _ = word_hashes((text or "").encode("utf-8", "replace").lower(), multipliers)
    return shingles(h, words)


def minima(s: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash samples of a set that isn't empty: (sample number, minimum) as one hash each."""
    low = np.full(len(factors), np.uint64(2**64 - 1))
    for i in range(0, len(s), 2048):
        block = s[i : i + 2048, None] * factors + offsets
        np.minimum(low, block.min(axis=0), out=low)
    return mix(low ^ offsets)


def odd_sketch(samples: np.ndarray) -> list[int]:
    """Parity bitmap of the samples, as signed longs."""
    size = BITS_EACH * len(samples)
    bits = np.bincount((samples >> np.uint64(32)).astype(np.int64) % size, minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def band_keys(samples: np.ndarray) -> list[int]:
    band = np.zeros(BANDS, np.uint64)
    for j in range(len(samples) // BANDS):
        band = mix(band * np.uint64(0x9E3779B97F4A7C15) + samples[j :: len(samples) // BANDS])
    return mix(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64).tolist()


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, d1, d2 (128-bit digest of the set), sketch, bands of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, factors, offsets = word_multipliers(), salts(SAMPLES, 5), salts(SAMPLES, 6)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in batches_of(texts, rows=1024, chars=4 << 20):
                out = {"n": [], "d1": [], "d2": [], "sketch": [], "bands": []}
                for t in texts[a:b]:
                    s = text_shingles(t, words, m)
                    digest = np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                    samples = minima(s, factors, offsets) if len(s) else None
                    found = (None, None) if samples is None else (odd_sketch(samples), band_keys(samples))
                    for k, v in zip(out, (len(s), int(digest[0]), int(digest[1]), *found), strict=True):
                        out[k].append(v)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(out["n"], pa.int64()), pa.array(out["d1"], pa.int64()),
                     pa.array(out["d2"], pa.int64()), pa.array(out["sketch"], pa.list_(pa.int64())),
                     pa.array(out["bands"], pa.list_(pa.int64()))], ["doc_id", *out])
        tidy()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, d1 long, d2 long, sketch array<long>, bands array<long>")


def fine_sketches(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """rep, sketch of FINE_SAMPLES samples for the documents of ``ids`` (rep)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, factors, offsets = word_multipliers(), salts(FINE_SAMPLES, 7), salts(FINE_SAMPLES, 8)
        for batch in batches:
            sketches = [odd_sketch(minima(text_shingles(t.as_py(), words, m), factors, offsets)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sketches, pa.list_(pa.int64()))], ["rep", "sketch"])
        tidy()

    return texts_of(docs, ids.withColumnRenamed("rep", "id")).where("length(text) > 0").mapInArrow(
        run, "rep long, sketch array<long>")


@lru_cache
def heaviest(percent: int, samples: int) -> int:
    """Largest XOR weight of two sketches that are compared in full: a pair at the similarity is heavier with
    probability ``REFUSED`` at most.

    Of the samples of such a pair a binomial number differ, and each of these flips two random bits."""
    bits, share = BITS_EACH * samples, 1 - percent / 100
    differ = np.arange(samples + 1)
    log_choose = lgamma(samples + 1) - np.array([lgamma(d + 1) + lgamma(samples - d + 1) for d in differ])
    with np.errstate(divide="ignore", invalid="ignore"):
        chance = np.exp(log_choose + np.where(differ, differ * np.log(share), 0) + (samples - differ) * np.log1p(-share))
    weight, place, total = np.zeros(bits + 1), np.arange(bits + 1), np.zeros(bits + 1)
    weight[0] = 1.0
    for d in differ:
        total += chance[d] * weight
        if chance[d:].sum() < 1e-15:
            break
        for _ in range(2):
            up, down = weight * (bits - place) / bits, weight * place / bits
            weight = np.zeros(bits + 1)
            weight[1:] += up[:-1]
            weight[:-1] += down[1:]
    heavier = np.append(np.cumsum(total[::-1])[::-1], 0.0)      # heavier[w]: w or more
    return int(np.argmax(heavier[1:] <= REFUSED))


def sift(a: Column, b: Column, percent: int, samples: int) -> Column:
    """True where the XOR of two odd sketches is light enough."""
    longs = BITS_EACH * samples // 64
    if longs <= 8:
        weight = sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(longs)), F.lit(0))
    else:
        weight = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    return weight <= heaviest(percent, samples)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, text of the documents whose id is in ``ids`` (id)."""
    many = ids.limit(BROADCAST_IDS + 1).count() > BROADCAST_IDS
    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(
        ids if many else F.broadcast(ids), "id", "left_semi")


def confirm(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those ``pairs`` (a, b: ids) whose full shingle sets reach ``percent`` % Jaccard similarity."""
    ids = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "id")
    texts = texts_of(docs, ids)
    both = (pairs.join(texts.withColumnsRenamed({"id": "a", "text": "ta"}), "a")
            .join(texts.withColumnsRenamed({"id": "b", "text": "tb"}), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, last, kept = word_multipliers(), None, None
        for batch in batches:
            hit = []
            for ta, tb in zip(batch.column(2), batch.column(3), strict=True):
                left, right = ta.as_py(), tb.as_py()
                if right != last:      # the rows of one b come together after the join
                    last, kept = right, text_shingles(right, words, m)
                s = text_shingles(left, words, m)
                shared = len(s) + len(kept) - len(np.union1d(s, kept))
                hit.append(100 * shared >= percent * (len(s) + len(kept) - shared) and shared > 0)
            yield batch.select([0, 1]).filter(pa.array(hit, pa.bool_()))
        tidy()

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, label: the smallest id reachable from each id of ``edges`` (a, b).

    Alternating large-star and small-star steps, each one or two aggregations
    with partial sums; the edges never leave the executors.  Ends when a round
    changes nothing (a logarithmic number of rounds)."""
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    now, before = cut(edges.select(hi, lo).where("hi > lo").distinct(), "cc"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("hi").alias("id"), F.col("lo").alias("label"))
        before = mark
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-min")
        large = cut(both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(),
                    "cc-large")
        roots = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(roots, "hi").select(F.explode(F.array(
            F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        now = cut(small.select("e.hi", "e.lo").where("hi > lo").distinct(), "cc")


def size_ratio(a: Column, b: Column, percent: int) -> Column:
    """True where sets of these sizes can reach the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def member_shingles(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """rep, sid, n, token: the shingles of the documents of ``ids`` (rep), a row each; sid tells the texts of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = word_multipliers()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in batches_of(texts, rows=512, chars=1 << 20):
                sets = [text_shingles(t, words, m) for t in texts[a:b]]
                sids = [int(np.frombuffer(blake2b(s.tobytes(), digest_size=8).digest(), np.int64)[0]) for s in sets]
                tokens = pa.ListArray.from_arrays(np.cumsum([0] + [len(s) for s in sets]).astype(np.int32),
                                                  pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), tokens],
                    ["rep", "sid", "n", "tokens"])

    sets = texts_of(docs, ids.withColumnRenamed("rep", "id")).where("length(text) > 0").mapInArrow(
        run, "rep long, sid long, n long, tokens array<long>")
    return sets.dropDuplicates(["rep", "sid"]).select("rep", "sid", "n", F.explode("tokens").alias("token"))


def prefix_pairs(docs: DataFrame, members: DataFrame, fine: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: pairs of ``members`` (rep, comp) of different components that share a shingle of their prefixes
    and whose ``fine`` sketches (rep, sketch) may be those of sets at the similarity.

    In one order of all shingles (rarest first), a set x and a smaller or equal set y at the similarity share
    one of the first |x| - ceil(p|x|) + 1 shingles of x and the first |y| - ceil(2p|y| / (1 + p)) + 1 of y.  After the
    first shared shingle, enough of both sets must be left to reach p(|x| + |y|) / (1 + p) shared ones."""
    tokens = cut(member_shingles(docs, members.select("rep").distinct(), words), "nd-tokens")
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    order = Window.partitionBy("rep", "sid").orderBy("often", "token")
    n = F.col("n")
    ranked = (tokens.join(often, "token").withColumn("rank", F.row_number().over(order))
              .where((F.col("rank") <= n - F.ceil(percent * n / 100) + 1) & (F.col("often") > 1))
              .withColumn("early", F.col("rank") <= n - F.ceil(2 * percent * n / (100 + percent)) + 1))
    prefixes = cut(ranked.join(members, "rep").select("token", "rep", "comp", "n", "early", "rank"), "nd-prefixes")
    parts = prefixes.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("rows"))
    shared = (parts.groupBy("token").agg(F.max(F.struct("rows", "comp")).alias("most"), F.count(F.lit(1)).alias("parts"))
              .where("parts > 1").select("token", F.col("most.comp").alias("largest")))
    rows = cut(prefixes.join(shared, "token").withColumn("major", F.col("comp") == F.col("largest")).drop("largest")
               .join(fine, "rep"), "nd-prefix-rows")
    small = rows.where("early").select(F.col("token").alias("token_y"), F.col("rep").alias("y"), F.col("comp").alias("comp_y"),
                                       F.col("n").alias("n_y"), F.col("major").alias("major_y"), F.col("rank").alias("rank_y"),
                                       F.col("sketch").alias("sketch_y"))
    left = F.least(n - F.col("rank"), F.col("n_y") - F.col("rank_y")) + 1
    meet = ((F.col("token") == F.col("token_y")) & (F.col("comp") != F.col("comp_y")) & (100 * F.col("n_y") >= percent * n)
            & ((n > F.col("n_y")) | ((n == F.col("n_y")) & F.col("early") & (F.col("rep") > F.col("y"))))
            & ((100 + percent) * left >= percent * (n + F.col("n_y")))
            & sift(F.col("sketch"), F.col("sketch_y"), percent, FINE_SAMPLES))
    # members of a shingle's largest component aren't compared with one another
    found = (small.where("not major_y").join(rows, meet).select("rep", "y")
             .union(small.where("major_y").join(rows.where("not major"), meet).select("rep", "y")))
    return found.select(F.greatest("rep", "y").alias("a"), F.least("rep", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of the group), kept, for every row of ``docs``."""
    sets = cut(signatures(docs, words), "nd-sets")
    linked = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # sketch and bands follow from the set, so any row's will do
    reps = cut(linked.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
                                              F.first("bands").alias("bands")), "nd-reps")
    members = cut(sets.select("doc_id", "n", "d1", "d2").join(
        reps.select("d1", "d2", "rep"), ["d1", "d2"], "left").select("doc_id", "n", "rep"), "nd-members")
    # an id with several texts links their representatives: a star, so no group is collected
    several = cut(members.where("doc_id is not null and rep is not null").groupBy("doc_id")
                  .agg(F.min("rep").alias("a"), F.max("rep").alias("top")).where("a <> top").select("doc_id", "a"), "nd-several")
    same_id = members.join(several, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b")).distinct()

    rows = reps.select("rep", F.explode("bands").alias("key"))
    pivots = cut(rows.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("top"))
                 .where("pivot <> top").drop("top"), "nd-pivots")
    shared = cut(rows.join(pivots, "key"), "nd-buckets")
    sketches = reps.select("rep", "sketch")
    left = sketches.withColumnsRenamed({"rep": "a", "sketch": "sa"})
    right = sketches.withColumnsRenamed({"rep": "b", "sketch": "sb"})

    def linked_pairs(pairs: DataFrame, name: str) -> DataFrame:
        sifted = cut(pairs.join(left, "a").join(right, "b").where(sift(F.col("sa"), F.col("sb"), percent, SAMPLES))
                     .select("a", "b"), name)
        return confirm(docs, sifted, words, percent)

    star = (shared.where("rep <> pivot").groupBy(F.col("rep").alias("a"))      # at most BANDS pivots
            .agg(F.slice(F.array_sort(F.collect_set("pivot")), 1, FIRST_PIVOTS).alias("near"))
            .select("a", F.explode("near").alias("b")))
    links = cut(linked_pairs(star, "nd-star").union(same_id), "nd-links")
    first = components(links)
    # the other pivots, where they still lie in another component
    of_pivot = first.withColumnsRenamed({"id": "pivot_id", "label": "pivot_label"})
    apart = F.coalesce("label", "rep") != F.coalesce("pivot_label", "pivot")
    rest = cut(shared.where("rep <> pivot").join(first, F.col("rep") == F.col("id"), "left")
               .join(of_pivot, F.col("pivot") == F.col("pivot_id"), "left").where(apart)
               .select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct(), "nd-rest")
    if not rest.isEmpty():
        more = cut(linked_pairs(rest, "nd-rest-sifted"), "nd-rest-links")
        if not more.isEmpty():
            first = components(first.select(F.col("id").alias("a"), F.col("label").alias("b")).union(more))

    # buckets that still hold several components
    named = cut(shared.join(first, F.col("rep") == F.col("id"), "left")
                .select("key", "rep", F.coalesce("label", "rep").alias("comp")), "nd-named")
    sizes = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    open_keys = cut(sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("most"), F.count(F.lit(1)).alias("parts"),
                                             F.sum("n").alias("all"))
                    .where("parts > 1").select("key", F.col("most.comp").alias("largest"),
                                               (F.col("all") - F.col("most.n") > WIDE).alias("wide")), "nd-open")
    still = cut(named.join(open_keys, "key"), "nd-still")
    any_wide = not open_keys.where("wide").isEmpty()
    sized = reps.select("rep", "n").distinct()
    narrow = still.where("not wide")
    # at most BANDS keys each
    searched = narrow.groupBy("rep").agg(F.collect_set("key").alias("keys"))
    fine = cut(fine_sketches(docs, still.select("rep").distinct(), words).distinct(), "nd-fine")
    inside = cut(narrow.join(fine, "rep").join(sized, "rep").join(searched, "rep"), "nd-inside")
    minor = inside.where("comp <> largest").select(F.col("key").alias("in_key"), F.col("rep").alias("a"), F.col("comp").alias("ca"), F.col("sketch").alias("sa"),
                                                  F.col("keys").alias("keys_a"), F.col("n").alias("na"))
    every = inside.select("key", F.col("rep").alias("b"), F.col("comp").alias("cb"), F.col("sketch").alias("sb"), F.col("keys").alias("keys_b"),
                          F.col("n").alias("nb"), (F.col("comp") == F.col("largest")).alias("major"))
    late = cut(minor.join(every, (F.col("in_key") == F.col("key")) & (F.col("ca") != F.col("cb"))
                          & (F.col("major") | (F.col("a") < F.col("b"))) & size_ratio(F.col("na"), F.col("nb"), percent)
                          & sift(F.col("sa"), F.col("sb"), percent, FINE_SAMPLES)
                          # a pair that shares several narrow buckets comes from one of them alone
                          & (F.col("key") == F.array_min(F.array_intersect("keys_a", "keys_b"))))
               .select("a", "b").distinct(), "nd-late")
    if any_wide:
        wide = still.where("wide").select("rep", "comp").distinct()
        late = cut(late.union(prefix_pairs(docs, wide, fine, words, percent)).distinct(), "nd-late-all")
    final = first
    if not late.isEmpty():
        more = cut(confirm(docs, late, words, percent), "nd-late-links")
        if not more.isEmpty():
            final = components(first.select(F.col("id").alias("a"), F.col("label").alias("b")).union(more))
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("label", "rep", "doc_id"))
    return (members.join(final, F.col("rep") == F.col("id"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group (all columns): the one with the smallest id, once.

    Rows with a null id, and rows without words, stay."""
    found = cut(near_duplicates(docs, words, percent), "nd-found")
    gone_id, again_id = free_name(docs, "__gone"), free_name(docs, "__again")
    gone = found.where("not kept").select(F.col("doc_id").alias(gone_id)).distinct()
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    kept = docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == F.col(gone_id), "left_anti")
    again = (found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n"))
             .where("__n > 1").select(F.col("doc_id").alias(again_id)))
    if again.isEmpty():
        return kept
    again = cut(again, "nd-again")
    repeated = kept["doc_id"] == F.col(again_id)
    return (kept.join(again, repeated, "left_anti")
            .union(kept.join(again, repeated, "left_semi").dropDuplicates(["doc_id"])))


__all__ = ["near_duplicates", "drop_near_duplicates", "components", "signatures", "sift", "minima", "odd_sketch", "band_keys",
           "heaviest", "text_shingles"]
