"""I-Match: lexicon band, fingerprints and likeness by brute force; ranges of neighbours that stay even."""

import random
import re
from collections import Counter, defaultdict
from hashlib import blake2b, sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from usagetally.llm import imatch


def plain_terms(text):
    return set(re.findall(r"\w+", (text or "").lower()))


def plain_lexicon(texts, least, most):
    n = Counter(t for text in texts for t in plain_terms(text))
    return {t for t, k in n.items() if least * len(texts) <= k <= max(most * len(texts), 1)}


def plain_fingerprint(text, lexicon):
    terms = plain_terms(text)
    subsets = defaultdict(list)
    for h in sorted(xxhash.xxh3_64_intdigest(t.encode()) for t in terms & lexicon):
        subsets[((h * 0x9E3779B97F4A7C15) % 2**64 >> 32) % imatch.SUBSETS].append(h)
    if not subsets:
        return "=" + blake2b("\n".join(sorted(terms) or [text]).encode(), digest_size=16).hexdigest()
    digest = lambda hs: blake2b(b"".join(h.to_bytes(8, "little") for h in hs), digest_size=2).hexdigest()
    return "".join(digest(subsets[k]) if k in subsets else "...." for k in range(imatch.SUBSETS))


def plain_likeness(a, b):
    if "=" in a[0] + b[0]:
        return 1.0 if a == b else 0.0
    same = both = 0
    for k in range(imatch.SUBSETS):
        x, y = a[4 * k : 4 * k + 4], b[4 * k : 4 * k + 4]
        if (x, y) != ("....", "...."):
            both += 1
            same += x == y
    return same / both


def brute(rows, lexicon):
    """Rows by id (nulls first); every row once, next to the one after it; ties are equal rows here."""
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = (plain_fingerprint(t, lexicon) for t in (text, edited, following))
        out.append((i, len(text), sha256(edited.encode()).hexdigest(), own, other, plain_likeness(own, other), plain_likeness(own, after)))
    return out


def test_fingerprints_by_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = sorted((tuple(r) for r in table.collect()), key=lambda r: r[0])
    rows[3] = (rows[3][0], None)
    rows[5:5] = [rows[5]] * 3                                    # equal rows follow one another
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    lexicon = plain_lexicon([t for _, t in rows], imatch.LEAST, imatch.MOST)
    assert {r.term for r in imatch.lexicon(df).collect()} == lexicon and 100 < len(lexicon)
    got = [tuple(r) for r in imatch.fingerprints(df, imatch.lexicon(df)).collect()]
    assert Counter(got) == Counter(brute(rows, lexicon))


def test_a_narrow_band_and_no_lexicon(spark):
    rows = [(1, "a b c"), (2, "a b d"), (3, ""), (4, "a x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least, most in ((0.4, 0.6), (0.9, 0.95)):
        lexicon = plain_lexicon([t for _, t in rows], least, most)
        assert lexicon == ({"b"} if least == 0.4 else set())
        got = [tuple(r) for r in imatch.fingerprints(df, imatch.lexicon(df, least, most)).collect()]
        assert Counter(got) == Counter(brute(rows, lexicon))


@pytest.mark.parametrize("kind", ["null", "repeated", "equal"])
def test_hot_ids_are_spread(spark, kind):
    """A third of the rows share an id: null or not, with texts of their own or one text."""
    rng, n, rows = random.Random(2), 6_000, []
    for k in range(n):
        hot = k % 3 == 0
        rows.append(((None if kind != "repeated" else 77) if hot else 10 * k, "the one text" if hot and kind == "equal" else f"text {rng.random()}"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    dealt = imatch.with_next(df, 500)
    sizes = [r["count"] for r in dealt.where("peek = 0").groupBy("place").count().collect()]
    # a partition holds one place, but that AQE may join small ones
    assert sum(r[0] for r in dealt.where("peek = 0").agg(F.sum("n")).collect()) == n
    assert len(sizes) >= 8 and max(sizes) <= 2 * n / len(sizes)
    peeks = {(r.place, r.peek) for r in dealt.where("peek > 0").select("place", "peek").distinct().collect()}
    assert peeks == {(p, 1) for p in range(len(sizes) - 1)} | {(len(sizes) - 1, 2)}
    if kind == "equal":
        got = imatch.fingerprints(df, imatch.lexicon(df)).collect()
        assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
        same = [r.near_next for r in got if r.doc_id is None]
        assert sum(x == 1 for x in same) >= len(same) - 1


def test_many_terms_are_hashes(spark):
    """A lexicon is 8 bytes a term in each worker, whatever its terms."""
    h = imatch.term_hashes([f"term {k} " * 20 for k in range(5_000)])
    assert h.dtype == np.uint64 and len(h) == 5_000 and (np.diff(h) > 0).all()
    share = np.bincount(imatch.subset_of(h).astype(int), minlength=imatch.SUBSETS)
    assert share.min() > 10 and share.max() < 90
