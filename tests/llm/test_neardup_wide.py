"""Near duplicates: templated pages, the whole of sf0.01 by brute force, the limits of sketches."""

import random
import time
from collections import Counter, defaultdict

import numpy as np

from tests.llm.test_operators import blank_words
from usagetally.llm import neardup


def shingle_sets(rows, words):
    sets = {}
    for i, text in rows:
        w = blank_words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    return sets


def brute_groups(rows, words, percent=80):
    """Smallest id reachable, over all pairs that share a shingle."""
    sets, holders, shared = shingle_sets(rows, words), defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                shared[a, b] += 1
    group = {i: i for i in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            group[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def components_of(df, words):
    return {r.doc_id: r.component_id for r in neardup.near_duplicates(df, words=words).collect()}


def pages(count, own, seed, first=0):
    """Pages of one template of 120 words with so many words of their own."""
    rng = random.Random(seed)
    template = [f"t{seed}x{rng.randrange(5000)}" for _ in range(120)]
    return [(first + i, " ".join(template + [f"u{seed}x{i}x{j}" for j in range(own + i % 3)])) for i in range(count)]


def test_templated_pages_by_brute_force(spark, monkeypatch):
    """Pages just below and just above the similarity, groups of near copies among them, one bucket wide open."""
    monkeypatch.setattr(neardup, "WIDE", 40)
    rows = pages(200, 17, 1) + pages(120, 11, 2, 1000) + pages(150, 16, 3, 2000)
    for k in range(40):                  # near copies of some pages
        rows.append((3000 + k, rows[k * 7][1].replace("x1 ", "y1 ", 1)))
    random.Random(1).shuffle(rows)
    got = components_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 4)
    want = brute_groups(rows, 4)
    assert got == want and 5 < len(set(want.values())) < len(rows)


def test_work_on_templated_pages_grows_in_proportion(spark):
    took = {}
    for n in (2_000, 8_000):
        df = spark.createDataFrame(pages(n, 18, 5), "doc_id long, text string").repartition(8)
        start = time.perf_counter()
        assert len(set(components_of(df, 4).values())) == n
        took[n] = time.perf_counter() - start
    assert took[8_000] < 4 * took[2_000]


def test_every_document_by_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    for words in (4, 5):
        got = components_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words)
        assert got == brute_groups(rows, words)


def test_prefixes_of_every_similar_pair_meet(spark):
    """The prefix join alone, over random families: every pair at the similarity is a candidate."""
    rng, rows = random.Random(3), []
    for family in range(12):
        base = [f"w{family}x{rng.randrange(40)}" for _ in range(rng.randrange(5, 60))]
        for _ in range(10):
            words = [w if rng.random() > 0.04 else f"n{rng.randrange(10**6)}" for w in base]
            rows.append((len(rows), " ".join(words[: len(words) - rng.randrange(3)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members = spark.createDataFrame([(i, i) for i, _ in rows], "rep long, comp long")
    fine = neardup.fine_sketches(docs, members.select("rep"), 4)
    found = {(r.a, r.b) for r in neardup.prefix_pairs(docs, members, fine, 4, 80).collect()}
    sets, similar = shingle_sets(rows, 4), set()
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                similar.add((a, b))
    assert len(similar) > 50 and similar <= found and len(found) < len(rows) ** 2 / 8


def test_sketches_refuse_as_rarely_as_stated():
    """Random sketches of pairs at the similarity: the exact distribution agrees with a count of 40,000 of them."""
    rng, samples = np.random.default_rng(1), neardup.SAMPLES
    bits, differ = neardup.BITS_EACH * samples, rng.binomial(samples, 0.2, 40_000)
    weights = []
    for d in differ:
        weights.append(int((np.bincount(rng.integers(0, bits, 2 * d), minlength=bits) & 1).sum()))
    assert max(weights) <= neardup.heaviest(80, samples) < 100
    assert 400 < neardup.heaviest(80, neardup.FINE_SAMPLES) < 520
