"""Whole queries and the pipeline against plain-Python versions that share no code with the operators."""

import base64
import hashlib
import math
import os
import re
import struct
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import regex
import xxhash

from tests.conftest import SF_SMALL
from tests.llm.test_operators import brute_components
from usagetally.llm import language, queries, rollups, toxicity
from usagetally.llm.words import salts, word_multipliers

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

ROW = "doc_id long, text string, lang string, source string, n_chars long"
MASK = (1 << 64) - 1


def planted(documents):
    """Rows that each stage decides on: near copies, a chain, bad quality, no text, blanks at line ends, rare sources."""
    words = [f"plain{i}" for i in range(100)]
    copy = lambda *at: " ".join("other" if i in at else w for i, w in enumerate(words))
    texts = [copy(), copy(40), copy(), copy(40, 41), copy(10, 40, 41), copy(10, 30, 50, 70, 90),
             "", None, " \t\x0b\n", "too few words", "again and again and " * 12, "# $ % & | < > * " * 6,
             "\n".join(["one line of several words to read"] * 4 + ["and another line with other words in it"]),
             "one two  \nthree four\t\r\nfive six seven eight nine ten eleven twelve ", documents[0]["text"],
             documents[0]["text"] + " " + documents[1]["text"][:40]]
    return [{"doc_id": 9_000_000 + i, "text": t, "lang": "en" if i % 2 else None, "source": ("src0", "src1", None, "rare")[i % 4],
             "n_chars": len(t or "")} for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """(folder, documents, labels) of the small tables and the planted rows."""
    root = str(tmp_path_factory.mktemp("corpus"))
    documents = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    documents += planted(documents)
    labels = pq.read_table(f"{SF_SMALL}/labels.parquet").to_pylist()
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    spark.createDataFrame([tuple(d[n] for n in names) for d in documents], ROW).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    return root, documents, labels


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# ---- token counts

def byte_pairs(piece, ranks, known={}):  # noqa: B006
    """Number of tokens of a piece: the adjacent pair of least rank is joined until no pair has one."""
    if piece not in known:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        known[piece] = len(parts)
    return known[piece]


def test_rollup_query_by_brute_force(spark, corpus):
    """Inserted, revised, resent and deleted documents leave the counts of the revised texts that have a word."""
    root, documents, _ = corpus
    with open(rollups.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}
    split = regex.compile(rollups.PATTERN)
    want = defaultdict(lambda: [0, 0])
    for d in documents:
        if not words_in(d["text"]):
            continue
        text = re.sub(r"[ \t\r]+(?=\n|\Z)", "", d["text"])
        for tokenizer, n in (("words-1", len(words_in(text))),
                             ("byte_bpe_50k-1", sum(byte_pairs(p.encode(), ranks) for p in split.findall(text)))):
            cell = want[d["source"], d["lang"], tokenizer]
            cell[0] += 1
            cell[1] += n
    got = {(r.source, r.lang, r.tokenizer): [r.docs, r.tokens] for r in queries.op5_token_rollups(spark, root).collect()}
    assert got == dict(want)


# ---- toxicity

def finalised(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & MASK
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & MASK
    return h ^ h >> 31


def slow_features(text, bits, multipliers):
    """Coordinates of the distinct words, pairs and pairs with a word between, one at a time."""
    plain = "".join(chr(b) for b in (text or "").encode("utf-8", "replace"))
    found = re.findall(r"[0-9a-z\x80-\xff]+", re.sub("[A-Z]", lambda m: m[0].lower(), plain))
    hashes = {}
    for w in set(found):
        total = len(w) * 0xD6E8FEB86659FD93
        for i, c in enumerate(w):
            total += (ord(c) + 1) * int(multipliers[i])
        hashes[w] = finalised(total & MASK)
    codes = set(hashes.values())
    for gap in (1, 2):
        for a, b in zip(found, found[gap:]):  # noqa: B905
            codes.add(finalised(hashes[a] * 0x9E3779B97F4A7C15 + hashes[b] + gap & MASK))
    return {c >> 64 - bits for c in codes}


def slow_ftrl(rows, alpha, l1, l2, passes, weight=1.0):
    """A dictionary of weights and the bias: one coordinate at a time, as the published algorithm has it."""
    z, n = defaultdict(float), defaultdict(float)
    toxic = sum(y for _, y in rows)
    bias = math.log((toxic + 0.5) / (len(rows) - toxic + 0.5))

    def weight_of(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / (l2 + (1.0 + math.sqrt(n[i])) / alpha)

    for _ in range(passes):
        for at, y in rows:
            w = {i: weight_of(i) for i in at}
            p = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, bias + sum(w.values())))))
            g = (p - y) * (weight if y else 1.0)
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    return {i: weight_of(i) for i in z if abs(z[i]) > l1}, bias


def slow_scores(documents, labels):
    """(doc_id, score) of every row by the scalar features and fit over the rows that may be learned from."""
    multipliers = salts(200_000, 11)
    known = defaultdict(list)
    for r in labels:
        if r["doc_id"] is not None and r["toxic"] is not None and not is_held_out(r["doc_id"]):
            known[r["doc_id"]].append(r["toxic"])

    def order(d):
        h = xxhash.xxh64_intdigest(struct.pack("<q", d["doc_id"]), seed=xxhash.xxh64_intdigest(d["text"].encode(), seed=42))
        return h - (1 << 64) if h >> 63 else h

    learned = sorted((order(d), d["text"], int(max(known[d["doc_id"]]) > 0)) for d in documents
                     if d["doc_id"] in known and d["text"] is not None and len(d["text"]) <= toxicity.MAX_CHARS)
    weights, bias = slow_ftrl([(slow_features(t, toxicity.BITS, multipliers), y) for _, t, y in learned], 2.0, 6.0, 0.1, 3)
    total = lambda t: bias + sum(weights.get(i, 0.0) for i in slow_features(t, toxicity.BITS, multipliers))
    return [(d["doc_id"], 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, total(d["text"])))))) for d in documents]


def test_features_are_those_of_single_words():
    for text in (None, "", "One", "a-b A_B c9", "Ünïcode 日本語 words words words", "x " * 50, "w" * 300 + " end"):
        got = toxicity.features(text, 22, word_multipliers()).tolist()
        assert set(got) == slow_features(text, 22, salts(400, 11)) and len(set(got)) == len(got)


def test_ftrl_is_the_scalar_algorithm():
    rng = np.random.default_rng(10)
    rows = [(np.unique(rng.integers(0, 64, rng.integers(0, 12))), int(rng.random() < 0.3)) for _ in range(400)]
    rows = [(np.append(at[at != 5], 5) if y and rng.random() < 0.8 else at, y) for at, y in rows]
    for alpha, l1, l2, weight in ((2.0, 6.0, 0.1, 1.0), (0.5, 0.0, 1.0, 1.0), (1.0, 2.0, 0.0, 3.0)):
        at, w, bias = toxicity.ftrl(rows, 6, alpha, l1, l2, 3, weight)
        want, want_bias = slow_ftrl([(at.tolist(), y) for at, y in rows], alpha, l1, l2, 3, weight)
        assert sorted(want) == at.tolist() and bias == pytest.approx(want_bias)
        assert w == pytest.approx([want[i] for i in at.tolist()], rel=1e-9, abs=1e-12)
    assert len(toxicity.ftrl([], 6, 2.0, 6.0, 0.1, 3)[0]) == 0


def test_toxicity_query_by_brute_force(spark, corpus):
    root, documents, labels = corpus
    got = queries.op10_toxicity(spark, root).collect()
    want = dict(slow_scores(documents, labels))
    assert len(got) == len(documents) and {r.doc_id for r in got} == set(want)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-5)
        assert r.held_out == is_held_out(r.doc_id) and r.predicted == int(r.score >= 0.7)


# ---- language

def gram_set(text):
    return {text.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}


def test_ridge_by_its_dual():
    """Scores of the fit equal kernel ridge regression over the landmark kernel, solved in its dual form over sets."""
    source = {"aa": "the cat sat on a mat and then the rat ran to the hat", "bb": "le chat est sur la table et le rat aussi",
              "cc": "der hund ist auf dem tisch und die maus auch da"}
    texts, langs = [], []
    for lang, text in source.items():
        words = text.split()
        for i in range(8):
            texts.append(" ".join(words[i % 4 :: 1 + i % 3]) + f" {lang[0]}" * (i % 2))
            langs.append(lang)
    new = ["the rat sat", "la table est le chat", "die maus und der hund", "zzz", "the la der"]
    model = language.fit(texts, langs, landmarks=12)
    marks = [t for c in sorted(source) for t in list(dict.fromkeys(t for t, x in zip(texts, langs, strict=True) if x == c))[:4]]
    used = set().union(*(gram_set(t) for t in marks))

    def kernel(a, b):
        sets = lambda ts: [gram_set(t) & used for t in ts]
        return np.array([[len(x & y) / math.sqrt(max(len(x), 1) * max(len(y), 1)) for y in sets(b)] for x in sets(a)])

    middle = np.linalg.pinv(kernel(marks, marks), rcond=1e-6, hermitian=True)
    joint = lambda a, b: kernel(a, marks) @ middle @ kernel(marks, b) + 1.0
    y = np.array([[1.0 if lang == c else -1.0 for c in sorted(source)] for lang in langs])
    dual = np.linalg.solve(joint(texts, texts) + language.RIDGE * len(texts) * np.eye(len(texts)), y)
    scores = joint(new, texts) @ dual
    lang, score = language.predict(new, model)
    best = scores.argmax(axis=1)
    assert list(lang) == [sorted(source)[i] for i in best]
    assert score == pytest.approx(np.clip((scores[np.arange(len(new)), best] + 1) / 2, 0, 1), abs=2e-3)


# ---- the pipeline

def passes_rules(text):
    w = words_in(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {x for x, n in Counter(windows).items() if n > 1}
    repeated = len({i + k for i, x in enumerate(windows) if x in twice for k in range(5)})
    lines = [line for line in (text or "").split("\n") if words_in(line)]
    chars = sum(map(len, w))
    return not (len(w) < 10 or 100 * repeated > 20 * len(w) or not 2 * len(w) <= chars <= 20 * len(w)
                or 10 * len(re.findall(r"[#*$%&|<>]", text)) > 4 * len(w)
                or 10 * (len(lines) - len(set(lines))) > 3 * len(lines))


def poisson_copies(doc_id, rate):
    """Poisson counts inverted at the uniform numbers of an id, one for each part of the rate."""
    parts, total = max(math.ceil(rate / 8.0), 1), 0
    for j in range(1, parts + 1):
        u = int(hashlib.md5(f"8:{j}:{doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        p = c = math.exp(-rate / parts)
        k = 0
        while c <= u and k < 48:
            k += 1
            p *= rate / parts / k
            c += p
            total += 1
    return total


def test_pipeline_by_brute_force(spark, corpus):
    """Scalar toxicity, quality rules, all pairs of shingle sets and Poisson counts give the rows of run()."""
    root, documents, labels = corpus
    scores = dict(slow_scores(documents, labels))
    assert all(abs(s - 0.7) > 1e-4 for s in scores.values())
    text = {d["doc_id"]: d["text"] for d in documents}
    source = {d["doc_id"]: d["source"] for d in documents}
    clean = [i for i in text if scores[i] < 0.7]
    good = [i for i in clean if passes_rules(text[i])]
    groups = brute_components([(i, text[i]) for i in good], 5)
    alone = [i for i, (_, component) in groups.items() if component == i]
    assert len(text) > len(clean) > len(good) > len(alone)        # every stage has something to drop
    sizes = Counter(source[i] for i in alone)
    weight = {s: {"src0": 3.0, "src1": 2.0}.get(s, 1.0) for s in sizes}
    want = Counter({i: poisson_copies(i, weight[source[i]] / sum(weight.values()) * len(alone) / sizes[source[i]]) for i in alone})
    got = corpus_pipeline.run(spark, root).collect()
    assert Counter(r.doc_id for r in got) == +want
    assert all(r.decoded == text[r.doc_id] and r.n_tokens == len(r.token_ids) for r in got)
