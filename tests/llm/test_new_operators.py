"""Personal data, whitening and spelling variants: brute force, exact values, hard rows."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from usagetally.llm import pii, queries, spelling, whitening

DOC = "doc_id long, text string, spans string, word string"


# ---- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sum_is_luhn(digits):
    total = 0
    for k, d in enumerate(int(c) for c in reversed(digits)):
        total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def plain_base(text):
    """The contract's patterns as they stand."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 13 <= len(digits) <= 19 and sum_is_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_are_the_patterns():
    pick = random.Random(3)
    for alphabet, n in (("ab1.@-", 14), ("12.+ -()", 30), ("0.25", 16), ("49 -", 24), ("a@b.c1+ ", 40)):
        for _ in range(3000):
            text = "".join(pick.choice(alphabet) for _ in range(pick.randrange(n)))
            assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == plain_base(text), text
    with_card = "x 4785380592391139 4111 1111 1111 1111 é😀 a.b@c.d-e.f +1 (499) 555-6503 1.2.3.4 256.1.1.1 " * 3
    assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(with_card)] == plain_base(with_card)


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/../sf0.1/documents.parquet")
    return pii.train(docs)


def segmentations(found):
    """Every set of candidates that don't overlap, with a type each."""
    for size in range(len(found) + 1):
        for some in itertools.combinations(range(len(found)), size):
            spans = sorted((found[n][0], found[n][1], n) for n in some)
            if all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)):
                for kinds in itertools.product(*[found[n][2] for _, _, n in spans]):
                    yield [(k, s, e, n) for k, (s, e, n) in zip(kinds, spans, strict=True)]


def test_best_segmentation_and_marginals_by_enumeration():
    pick = random.Random(4)
    for _ in range(60):
        f = pii.Field()
        f.follow = np.array([[pick.gauss(0, 1) for _ in range(5)] for _ in range(5)])
        found = []
        for n in range(pick.randrange(1, 6)):
            s = pick.randrange(8)
            found.append((s, s + pick.randrange(1, 5), tuple(sorted(pick.sample(range(4), pick.randrange(1, 4)))), [f"f{n % 3}"]))
        found = sorted({(s, e): (s, e, k, x) for s, e, k, x in found}.values(), key=lambda x: (x[1], x[0]))
        f.weights = {f"f{n}": np.array([pick.gauss(0, 2) for _ in range(4)]) for n in range(3)}
        scored = []
        for path in segmentations(found):
            truth = [(k, s, e) for k, s, e, _ in path]
            scored.append((float((pii.label_pairs(found, truth) * f.follow).sum() + sum(f.score(found[n][3])[k] for k, _, _, n in path)), path))
        top, best = max(scored, key=lambda x: x[0])
        assert f.best(found) == [(k, s, e) for k, s, e, _ in best]
        total = np.logaddexp.reduce([x for x, _ in scored])
        want = defaultdict(float)
        for x, path in scored:
            for k, _, _, n in path:
                want[n, k] += math.exp(x - total)
        chances, pairs = f.marginals(found)
        assert all(abs(chances.get(key, 0) - p) < 1e-9 for key, p in want.items())
        expected = sum(math.exp(x - total) * pii.label_pairs(found, [(k, s, e) for k, s, e, _ in path]) for x, path in scored)
        assert np.allclose(pairs, expected, atol=1e-9)


def test_added_spans_on_disguised_entities(field):
    """Made from numbers and names that no sample holds; near misses stay alone."""
    pick, found, wrong, total = random.Random(9), 0, 0, 0
    for k in range(300):
        kind = k % 4
        if kind == pii.EMAIL:
            plain = f"{pick.choice(['ann', 'lee.wu', 'max'])}{pick.randrange(99)}@{pick.choice(['shop', 'post', 'uni-x'])}.{pick.choice(['com', 'org'])}"
        elif kind == pii.IP:
            plain = ".".join(str(pick.randrange(256)) for _ in range(4))
        elif kind == pii.CARD:
            head = "4" + "".join(str(pick.randrange(10)) for _ in range(14))
            plain = next(head + str(c) for c in range(10) if sum_is_luhn(head + str(c)))
        else:
            plain = f"+1 ({pick.randrange(200, 999)}) 555-{pick.randrange(1000, 9999)}"
        hidden = pii.disguised(kind, plain, pick)
        text = f"the rewhnd of {hidden} there. Inti"
        total += 1
        found += (kind, text.index(hidden), text.index(hidden) + len(hidden)) in [x[:3] for x in pii.all_spans(text, field)]
        near = f"the rewhnd of {pii.spoiled(kind, plain, pick)} there. Inti"
        wrong += any(not b for *_, b in pii.all_spans(near, field))
    assert found >= 0.9 * total and wrong <= 0.08 * total, (found, wrong, total)


def test_hard_texts_of_personal_data(spark, field):
    rows = [(1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (None, "ip 1.2.3.4 ip"), (4, "1" * 60_000), (5, "1 " * 30_000),
            (6, "@" * 30_000), (7, "a" * 200_000 + "@"), (8, "+" * 30_000 + "1" + " (" * 30_000), (9, "1." * 30_000), (10, "é😀 x@y.z 日"),
            (11, "x at y dot z " * 5_000)]
    docs = spark.createDataFrame([(i, t, "s", "w") for i, t in rows], DOC)
    start = time.time()
    got = pii.digest_columns(pii.find(docs, field)).collect()
    assert time.time() - start < 60 and len(got) == len(rows)
    want = Counter()
    for i, t in rows:
        base = plain_base(t) if t and len(t) < 100 else [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(t or "")]
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        want[i, hashlib.sha256(text.encode()).hexdigest(), *(sum(k == x for k, _, _ in base) for x in pii.KINDS)] += 1
    assert Counter((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == want
    assert next(r for r in got if r.doc_id == 10).spans == "email:3:8"
    masked = {r.doc_id: r.text for r in pii.redact(docs.limit(5), field).collect()}
    assert masked[3] == "[EMAIL]" and masked[1] is None and masked[None] == "ip [IP] ip" and len(pii.redact(docs, field).columns) == 4
    empty = spark.createDataFrame([], DOC)
    assert pii.find(empty, pii.train(empty)).collect() == []


def test_personal_data_query(spark):
    got = queries.op11_personal_data(spark, SF_SMALL).collect()
    texts = dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    assert len(got) == len(texts)
    for r in got:
        base = [f"{k}:{s}:{e}" for k, s, e in plain_base(texts[r.doc_id] or "")]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans) and len(spans) == len(base) + r.n_added
        order = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)


# ---- whitening

VEC = "vec_id long, embedding array<float>, component string, n string"


def whitened_by_numpy(vectors, wanted=32):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:wanted], q[:, ::-1][:, :wanted]
    return e / (np.trace(c.T @ c) / n), (c @ q) / np.sqrt(e), ((n * x - s) ** 2).sum(axis=1), e


def check_whitened(got, vectors, wanted=32):
    share, white, deviation, e = whitened_by_numpy(vectors, wanted)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(by) == len(vectors) * len(e)
    mine = np.array([[by[i, k + 1].whitened for k in range(len(e))] for i in range(len(vectors))])
    signs = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * signs - white).max() < 1e-6
    assert np.allclose([by[0, k + 1].explained for k in range(len(e))], share, rtol=1e-9)
    assert all(by[i, 1].deviation == deviation[i] and by[i, 1].n == len(vectors) for i in range(len(vectors)))
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_query_by_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    by = {r.vec_id: r.embedding for r in rows}
    got = queries.op12_embedding_whitening(spark, SF_SMALL).collect()
    assert sorted(by) == list(range(len(by)))
    check_whitened(got, [by[i] for i in range(len(by))])


def test_whitening_of_few_dimensions_and_dependent_ones(spark):
    r = np.random.default_rng(1)
    v = r.standard_normal((300, 5)).astype(np.float32) * [1, 4, 0.5, 2, 9]
    rows = [(i, x.tolist(), "c", "n") for i, x in enumerate(v)]
    check_whitened(whitening.whiten(spark.createDataFrame(rows, VEC)).collect(), [x[1] for x in rows])
    # a constant dimension and a repeated one: two components less, the rest still white
    tied = np.column_stack([v, np.full(300, 3.0), v[:, 0]])
    got = whitening.whiten(spark.createDataFrame([(i, x.tolist(), "c", "n") for i, x in enumerate(tied)], VEC)).collect()
    assert {x.component for x in got} == {1, 2, 3, 4, 5} and got[0].identity_error < 1e-6
    assert abs(sum({x.component: x.explained for x in got}.values()) - 1) < 1e-9
    few = whitening.whiten(spark.createDataFrame(rows, VEC), wanted=2).collect()
    assert {x.component for x in few} == {1, 2}


def test_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, [1.0, None]), (3, [1.0, nan]), (4, [inf, 1.0]), (5, []), (6, [1.0, 2.0, 3.0])]
    good = [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [0.5, -1.0]), (8, [3e38, 1.0])]
    df = spark.createDataFrame([(i, v, "c", "n") for i, v in bad + good], VEC)
    got = whitening.whiten(df).collect()
    assert Counter(r.vec_id for r in got if r.component == 1) == {7: 2, None: 1, 8: 1} and {r.n for r in got} == {4}
    assert all(r.deviation is None for r in got)                   # beyond a long
    for rows in ([], bad[:5], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.whiten(spark.createDataFrame([(i, v, "c", "n") for i, v in rows], VEC))
        assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_bidiagonalisation_of_hard_matrices():
    r = np.random.default_rng(2)
    low = r.standard_normal((200, 3)) @ r.standard_normal((3, 12))
    twins = np.vstack([np.eye(8), -np.eye(8), np.eye(8)])
    for x in (r.standard_normal((50, 20)), low, twins, np.outer(np.ones(9), np.arange(6.0)) + 1e-3 * r.standard_normal((9, 6))):
        sigma, v = whitening.bidiagonalise(lambda h, x=x: (float((x @ h) @ (x @ h)), x.T @ (x @ h)), x.shape[1], x.shape[1])
        want = np.linalg.svd(x, compute_uv=False)
        want = np.append(want, np.zeros(x.shape[1] - len(want)))
        assert np.allclose(sigma, want, atol=2e-7 * want[0]) and np.allclose(v @ v.T, np.eye(len(v)), atol=1e-12)
        assert np.abs(x.T @ (x @ v.T) - v.T * sigma**2).max() < 1e-11 * want[0] ** 2


# ---- spelling variants

def brute_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def apart_by_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n):
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and x != w and apart_by_one(w, x)] for w in n}
    form = {}
    for w in n:
        top = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = top if top and n[top] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def as_dict(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling_query_by_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    n = brute_words(rows)
    assert as_dict(queries.op13_spelling_variants(spark, SF_SMALL)) == brute_variants(n)


def test_near_words_in_many_rounds(spark):
    """Chains of forms, ties, edits at both ends, equal neighbours, long words; filters dealt over several rounds."""
    pick, n = random.Random(7), {}
    for _ in range(120):
        w = "".join(pick.choice("abÀÿ") for _ in range(pick.randrange(7, 11)))
        n[w] = pick.choice([2, 3, 20, 25, 300, 4000])
    n |= {"aaaaaaaa": 2, "aaaaaaa": 40, "aaaaaaab": 40, "baaaaaaa": 400, "x" * 300: 2, "x" * 301: 50, "x" * 150 + "y" + "x" * 149: 2}
    n |= {"ccccccc": 2, "ccccccd": 20, "cccccdd": 300, "ccccddd": 4000}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    want = brute_variants(n)
    assert any(v[1] not in (w, v[0]) for w, v in want.items())
    assert as_dict(spelling.group_variants(words)) == want
    assert spelling.Layout({7: 100, 8: 100}, 64).rounds > 2
    assert as_dict(spelling.group_variants(words, bound=64)) == want


def test_hard_texts_of_spelling(spark):
    long = "abcdefghij" * 3_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Wording WORDING wordin words"), (None, "wordinG ÀÉÎÕÜßÿ ÀÉÎÕÜßÿ"), (5, long), (5, long),
            (6, long[:-1] + "× " + long), (7, "日本語日本語日本語 1234567")]
    docs = spark.createDataFrame([(i, t, "s", "w") for i, t in rows], DOC)
    assert dict(tuple(r) for r in spelling.vocabulary(docs).collect()) == brute_words(rows)
    assert as_dict(spelling.group_variants(spelling.vocabulary(docs))) == brute_variants(brute_words(rows))
    none = spelling.group_variants(spelling.vocabulary(spark.createDataFrame([], DOC)))
    assert none.collect() == [] and none.columns == ["word", "form", "root", "n", "n_near", "form_n"]
