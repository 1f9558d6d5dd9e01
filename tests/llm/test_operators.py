"""The training-data operators against brute-force versions, round trips and hard rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from usagetally.llm import chat, imatch, language, licenses, mixing, neardup, pieces, quality, queries, rollups, toxicity

DOC = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"
#: Null, empty, blank, tied, repeated and long rows; two columns that clash with results.
HARD = [
    (1, None, None, None, None, "k", "s"),
    (2, "", "en", "a", 0, "k", "s"),
    (3, " \t\n\r\x0b\x0c ", "en", "a", 7, "k", "s"),
    (4, "one two three", "en", "a", 13, "k", "s"),
    (5, "one two three", "en", "b", 13, "k", "s"),
    (5, "one two three", "en", "b", 13, "k", "s"),
    (6, "Word! " * 30_000, "en", None, 180_000, "k", "s"),
    (7, "日本語▁ \n\n😀 <|im_end|>", None, "b", 20, "k", "s"),
    (None, "one two three", "fr", "b", 13, "k", "s"),
    (8, " ".join(f"w{i}" for i in range(200)), "en", "a", 0, "k", "s"),
    (9, " ".join(f"w{i}" for i in range(200)).replace("w199", "zz"), "en", "a", 0, "k", "s"),
]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(HARD, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- near duplicates

def brute_components(rows, words, percent=80):
    sets = {}
    for i, text in rows:
        w = blank_words(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets[i] = set(map(tuple, (w[k : k + words] for k in range(len(w) - words + 1)))) if len(w) >= words else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if both and 100 * both >= percent * union:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check_components(spark, rows, words=4):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in neardup.near_duplicates(df, words=words).collect()}
    want = brute_components(rows, words)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for g in range(12):                       # families whose members differ by a few words: chains and near misses
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([5, 40, 120]))]
        for _ in range(9):
            own = list(base)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(own)))
    check_components(spark, rows)


def test_a_chain_of_edits_is_one_group(spark):
    words = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(14):
        words[k * 10] = f"n{k}"
        rows.append((k, " ".join(words)))
    check_components(spark, rows)


def test_near_duplicates_hard_rows(hard, empty):
    got = [tuple(r) for r in neardup.near_duplicates(hard, words=4).collect()]
    by = {r[0]: r for r in got}
    assert len(got) == len(HARD) and by[2] == (2, 0, 2, True) and by[3] == (3, 0, 3, True) and by[1] == (1, 0, 1, True)
    assert by[5][2] == 4 and by[4] == (4, 1, 4, True) and by[9][2] == 8
    assert by[None][2] is None and by[None][3] is True
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.drop_near_duplicates(hard, words=4)
    assert kept.columns == hard.columns
    assert sorted(x.doc_id or 0 for x in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert neardup.drop_near_duplicates(empty).count() == 0


def test_repeated_rows_of_one_id_stay_once(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "u v w x y z")], "doc_id long, text string")
    assert sorted(r.doc_id for r in neardup.drop_near_duplicates(df).collect()) == [1, 2]


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(1)
    factors, offsets = neardup.salts(neardup.SAMPLES, 5), neardup.salts(neardup.SAMPLES, 6)
    limit = neardup.heaviest(80, neardup.SAMPLES)
    for shared in (1.0, 0.85, 0.1):
        a = rng.integers(0, 2**63, 500).astype(np.uint64)
        keep = int(500 * 2 * shared / (1 + shared))
        b = np.concatenate([a[:keep], rng.integers(0, 2**63, 500 - keep).astype(np.uint64)])
        x, y = (neardup.minima(np.unique(v), factors, offsets) for v in (a, b))
        weight = sum(((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(neardup.odd_sketch(x), neardup.odd_sketch(y), strict=True))
        bits = neardup.BITS_EACH * neardup.SAMPLES
        assert (weight <= limit) == (shared > 0.5) == bool(set(neardup.band_keys(x)) & set(neardup.band_keys(y)))
        if shared > 0.5:
            assert abs(1 + np.log(1 - 2 * weight / bits) * bits / 4 / neardup.SAMPLES - shared) < 0.12


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (101, 102)], "a long, b long")
    got = {r.id: r.label for r in neardup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


# ---- quality

def brute_measures(text):
    text = text or ""
    w = blank_words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if blank_words(x)]
    base = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), base)


def test_quality_measures_match_brute_force(spark, docs, hard):
    for df in (docs.select("doc_id", "text"), hard.select("doc_id", "text")):
        got = sorted(map(str, (tuple(r)[:1] + (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                               for r in quality.quality_report(df).collect())))
        assert got == sorted(str((r.doc_id, *brute_measures(r.text))) for r in df.collect())


def test_quality_order_changes_no_verdict(docs, hard, empty):
    report = {r.doc_id: r.kept for r in quality.quality_report(docs).collect()}
    kept = quality.drop_low_quality(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k in report.items() if k)
    assert {name for name, *_ in quality.rule_order(docs)} == set(quality.RULES)
    assert quality.drop_low_quality(hard).columns == hard.columns
    assert quality.quality_report(empty).count() == 0 and quality.drop_low_quality(empty).count() == 0


# ---- mixing

def test_mixing_counts_match_an_exact_inverse(spark):
    import math

    df = spark.createDataFrame([(i, f"t{i}", "en", "a" if i % 3 else "b", 1, "x") for i in range(600)] + [(None, None, None, None, None, "x")],
                               "doc_id long, text string, lang string, source string, n_chars long, copy string")
    out = mixing.mix_sources(df, {"a": 1.0, "b": 30.0}, budget=3.0)
    assert out.columns == [*df.columns, "copy_"]
    got = Counter((r.doc_id, r.source) for r in out.collect())
    sizes, weights = {"a": 400, "b": 200, None: 1}, {"a": 1.0, "b": 30.0, None: 1.0}
    for i, source in [(r.doc_id, r.source) for r in df.collect()]:
        rate = weights[source] / 32 * 3 * 601 / sizes[source]
        parts = max(1, math.ceil(rate / mixing.STEP))
        n = 0
        for j in range(1, parts + 1):
            u = int(hashlib.md5(f"8:{j}:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 2**52
            m, c, k = rate / parts, 0.0, 0
            while True:
                c += math.exp(-m) * m**k / math.factorial(k)
                if u < c:
                    break
                k += 1
            n += k
        assert got[i, source] == n
    by = Counter(s for (_, s), n in got.items() for _ in range(n))
    assert abs(by["b"] / 601 / 3 - 30 / 32) < 0.06


def test_mixing_hard_rows(hard, empty):
    out = mixing.mix_sources(hard, budget=2.0, numbered=False)
    assert out.columns == hard.columns and out.count() > 0
    assert mixing.mix_sources(empty).count() == 0


def test_mixing_draws_for_each_row_without_an_id(spark):
    rows = [(None, f"t{i}", "en", "a", 1) for i in range(1500)] + [(None, "same", "en", "a", 1)] * 1500 \
        + [(i, f"t{i}", "en", "b", 1) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for budget in (0.5, 2.0, 6.0):                # rates of source a: 0.3, 1.2 and 3.6
        rate = budget / 2 * len(rows) / 3000
        mixed = mixing.mix_sources(df, budget=budget)
        got = Counter(r.text for r in mixed.where("doc_id is null").collect())
        alone, same = Counter(got[f"t{i}"] for i in range(1500)), got["same"]
        for total in (sum(n * k for n, k in alone.items()), same):
            assert abs(total - 1500 * rate) < 5 * (1500 * rate) ** 0.5
        assert len(alone) > 2                                    # not one count for all
        again = mixing.mix_sources(df.repartition(5), budget=budget)
        assert Counter(again.collect()) == Counter(mixed.collect())


# ---- pieces

def test_pieces_round_trip_and_best_score(spark, docs, hard):
    tables = pieces.load_model()
    for df in (docs, hard):
        want = sorted(df.select("doc_id", "text").collect(), key=str)
        tokens = pieces.encode(df, tables)
        assert sorted((tuple(r) for r in tokens.select("doc_id", "decoded").collect()), key=str) == sorted(map(tuple, want), key=str)
        back = pieces.decode(tokens, tables)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, want), key=str)
    assert all(r.n_tokens == (None if r.token_ids is None else len(r.token_ids)) for r in tokens.collect())


def test_viterbi_is_the_best_segmentation():
    rng = random.Random(2)
    vocabulary = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 5))) for _ in range(40)})
    t = pieces.build([(p.encode(), -rng.random() * 9) for p in vocabulary] + [None] * 256,
                     list(range(len(vocabulary), len(vocabulary) + 256)), 0)
    score = dict(zip(vocabulary, t["scores"], strict=False))

    def best(word):
        top = [0.0] + [-1e9] * len(word)
        for i in range(len(word)):
            for j in range(i + 1, len(word) + 1):
                if word[i:j] in score:
                    top[j] = max(top[j], top[i] + score[word[i:j]])
            if word[i] not in score:
                top[i + 1] = max(top[i + 1], top[i] + t["scores"][-1])
        return top[-1]

    words = ["".join(rng.choice("abéc") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    ids, count = pieces.viterbi([w.encode() for w in words], t)
    at = 0
    for w, n in zip(words, count, strict=True):
        own = ids[at : at + n].tolist()
        at += n
        assert b"".join(t["out"][i] for i in own).decode() == w
        lost = sum(ch not in score for ch in w)
        assert sum(t["scores"][i] for i in own if i < len(vocabulary)) + lost * t["scores"][-1] == pytest.approx(best(w))


# ---- toxicity and language

def test_toxicity_learns_words_and_is_defined_for_hard_rows(spark, hard, empty):
    rng = random.Random(5)
    rows = [(i, " ".join([f"w{rng.randrange(300)}" for _ in range(40)] + (["Vile!"] * 2 if i % 5 == 0 else [])), int(i % 5 == 0))
            for i in range(900)]
    d = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(d, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(d, model).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert all(p == y for p, y in held) and len(model["at"]) < 3000
    assert all(0 <= r.score <= 1 for r in toxicity.score_documents(hard, model).collect())
    assert toxicity.drop_toxic(hard, model).columns == hard.columns
    assert toxicity.score_documents(empty, model).count() == 0
    untrained = toxicity.train(d, labels.limit(0))
    assert {r.score for r in toxicity.score_documents(hard, untrained).collect()} == {0.5}


def test_language_held_out_accuracy_and_hard_rows(spark, docs, hard, empty):
    model = language.train(docs)
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in language.identify(docs, model).collect() if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    got = {r.doc_id: r for r in language.identify(hard, model).collect()}
    assert {got[i].lang_pred for i in (1, 2, 3)} == {"und"} and got[3].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language.identify(hard, language.train(empty)).collect()} == {"und"}


def test_what_is_learned_from_is_bounded_in_rows(spark, monkeypatch):
    """A labelled id on a third of the rows, with texts of its own and with equal ones; rows without an id."""
    rng = random.Random(6)
    word = lambda: " ".join(f"w{rng.randrange(300)}" for _ in range(20))
    hot = next(i for i in range(9000, 9100) if zlib.crc32(str(i).encode()) % 3 != 1)
    rows = [(i, word() + (" vile vile" if i % 5 == 0 else "")) for i in range(600)]
    rows += [(hot, f"hotword{k % 200} {word() if k < 200 else ''}") for k in range(600)]
    d = spark.createDataFrame([(*r, "en" if k % 2 else "fr") for k, r in enumerate(rows)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)] + [(hot, 1)], "doc_id long, toxic int")
    unique = spark.createDataFrame([*rows[:600], (hot, "hotword0")], "doc_id long, text string")
    many, once = (toxicity.train(x, labels, l1=0.0)["at"] for x in (d, unique))
    m = toxicity.word_multipliers()
    known = {t for i, t in rows if i == hot}
    coordinate = {int(toxicity.features(f"hotword{k}", toxicity.BITS, m)[0]) for k in range(200)}
    assert len(known) >= 200 and len(coordinate & set(many.tolist())) == 1 and len(once) > 0
    # a hard bound: 50 rows hold at most 50 * 57 features
    assert len(toxicity.train(unique, labels, max_rows=50, l1=0.0)["at"]) <= 50 * 65
    seen = []
    monkeypatch.setattr(language, "fit", lambda texts, langs: seen.append(texts))
    bare = d.selectExpr("cast(null as long) as doc_id", "text", "lang")
    held = zlib.crc32(b"") % 3 == 1
    copies = spark.createDataFrame([(hot, "one and the same text", "en")] * 900, d.schema)
    for table in (d, copies, *([] if held else [bare])):
        language.train(table, max_rows=100)
    assert all(0 < len(x) <= 100 for x in seen) and len(seen[1]) == 1 and (held or len(seen[2]) > 40)


def test_presence_kernel_is_the_normalised_overlap():
    texts = ["abcab", "bcd", "xyz"]
    grams = language.grams_of(texts)
    k = language.kernel(*[language.presence(texts, grams)] * 2)
    sets = [{t[i : i + n] for n in language.ORDERS for i in range(len(t) - n + 1)} for t in texts]
    want = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets]
    assert np.allclose(k, want, atol=1e-5)


# ---- licences

def test_licence_spans(spark, hard, empty):
    text = "Some words first.\nPermission is hereby granted, free of charge to any person getting a copy of this software and " \
           "associated documentation files (the 'Software'), to deal in the Software without restriction, and more. Licensed under CC BY-NC 4.0."
    df = spark.createDataFrame([(1, text), (2, "a licence of no kind"), (3, None), (1, text)], "doc_id long, text string")
    got = licenses.scan(df).collect()
    assert Counter(r.license for r in got) == {"MIT": 2, "CC-BY-NC-4.0-notice": 2} and {r.doc_id for r in got} == {1}
    mit = next(r for r in got if r.license == "MIT")
    assert text[mit.start : mit.end].startswith("Permission is") and text[mit.start : mit.end].endswith("restriction")
    assert 0.8 <= mit.coverage < 1 and mit.matched_words == 28
    assert licenses.scan(hard).count() == 0 and licenses.scan(empty).count() == 0


def brute_match(words, template):
    """Some window holds enough of the template: longest common word sequences from every start."""
    for s in range(len(words)):
        row = [0] * (len(template) + 1)
        for e in range(s, min(len(words), s + len(template) * 100 // licenses.PERCENT)):
            above, row = row, [0]
            for k, w in enumerate(template):
                row.append(above[k] + 1 if w == words[e] else max(row[k], above[k + 1]))
            if 100 * row[-1] >= licenses.PERCENT * licenses.reached(len(template), e - s + 1):
                return True
    return False


def test_licence_search_misses_no_match():
    rng, m = random.Random(4), licenses.word_multipliers()
    short = {k: t for k, t in licenses.TEMPLATES.items() if len(t) < 300}
    index = licenses.build_index(short)
    texts = ["Released under MIT License", "Released under an MIT License", "released the MIT under the License"]
    vocabulary = sorted({w for t in short.values() for w in t.split()})
    for t in short.values():
        for rate in (0.1, 0.2, 0.25, 0.3):
            for _ in range(4):
                words = [rng.choice(vocabulary) for _ in range(6)]
                for w in t.split():
                    r = rng.random()
                    words += [] if r < rate / 2 else [w, rng.choice(vocabulary)] if r < rate else [w]
                texts.append(" ".join(words))
    seen = Counter()
    for text in texts:
        words = licenses.plain_words(text, m)[0]
        ids = np.array([np.flatnonzero(index["vocabulary"] == w)[0] if w in index["vocabulary"] else len(index["vocabulary"])
                        for w in words])
        for number, (name, t) in enumerate(short.items()):
            want = brute_match(words.tolist(), licenses.plain_words(t, m)[0].tolist())
            assert bool(licenses.matches(ids, index, number)) == want, (name, text)
            seen[want] += 1
        assert bool(licenses.scan_text(text, index, m)) == any(
            licenses.matches(ids, index, k) for k in range(len(short)))
    assert seen[True] > 100 and licenses.scan_text(texts[0], index, m)[0][:3] == ("MIT-notice", 0.8, 4)


def test_licences_are_matched_whole_and_told_apart():
    m, index = licenses.word_multipliers(), licenses.build_index(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        got = licenses.scan_text(f"Some words of a page. {text} and the next ones.", index, m)
        assert [(x[0], x[1]) for x in got] == [(name, 1.0)], (name, got)
    mit = licenses.TEMPLATES["MIT-text"]
    (name, coverage, _, start, end), = licenses.scan_text("x " + mit, index, m)
    assert (name, coverage) == ("MIT-text", 1.0) and ("x " + mit)[start:end].endswith("DEALINGS IN THE\nSOFTWARE")
    rest = mit[mit.index("including without"):]
    assert [x[0] for x in licenses.scan_text(rest, index, m)] == ["MIT-text"]
    extra = licenses.scan_text("Released under the good old MIT License", licenses.build_index({"a": "Released under the MIT License"}), m)
    assert extra == []                                           # 5 of 7 words of the span
    one, = licenses.scan_text("Released under the old MIT License", index, m)
    assert one[0] == "MIT-notice" and one[1] == pytest.approx(5 / 6)


# ---- fingerprints

def test_fingerprints_follow_the_next_document(spark, docs, hard, empty):
    for df in (docs.select("doc_id", "text"), hard):
        rows = sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        got = imatch.fingerprints(df, imatch.lexicon(df)).collect()
        want = Counter()
        for k, (i, t) in enumerate(rows):
            edited = imatch.edited_text(t, rows[(k + 1) % len(rows)][1])
            want[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] += 1
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
        prints = defaultdict(set)
        texts = dict(rows)
        for r in got:
            prints[texts[r.doc_id]].add(r.fingerprint)
            assert r.near_edited == imatch.likeness(r.fingerprint, r.edited_fingerprint) and 0 <= r.near_next <= 1
        assert all(len(p) == 1 for p in prints.values())
    assert imatch.fingerprints(empty, imatch.lexicon(empty)).count() == 0


# ---- token counts

def test_rollups_are_idempotent_and_additive(spark, hard, empty):
    from usagetally.session import scratch_path

    root, versions = scratch_path(spark, "rollup-test"), {"words-1": rollups.word_counter}
    add = hard.selectExpr("1 as sign", "source", "lang", "text")
    assert rollups.commit(spark, root, "a", add, versions) and not rollups.commit(spark, root, "a", add, versions)
    want = Counter()
    docs = Counter()
    for _, t, lang, source, *_ in HARD:
        want[source, lang] += len(blank_words(t))
        docs[source, lang] += 1
    got = {(r.source, r.lang): (r.docs, r.tokens) for r in rollups.totals(spark, root).collect()}
    assert got == {k: (docs[k], want[k]) for k in docs}
    revised = spark.createDataFrame([(-1, "a", "en", "one two three"), (1, "a", "en", "one two")],
                                    "sign int, source string, lang string, text string")
    rollups.commit(spark, root, "b", revised, versions)
    rollups.commit(spark, root, "c", empty.selectExpr("1 as sign", "source", "lang", "text"), versions)
    after = {(r.source, r.lang): (r.docs, r.tokens) for r in rollups.totals(spark, root).collect()}
    assert after == got | {("a", "en"): (docs["a", "en"], want["a", "en"] - 1)}
    rollups.commit(spark, root, "d", hard.selectExpr("-1 as sign", "source", "lang", "text"), versions)
    assert {tuple(r) for r in rollups.totals(spark, root).collect()} == {("a", "en", "words-1", 0, -1)}


# ---- chat

def test_events_fold_and_render(spark):
    log = [("c", 0, 0, "open", "user"), ("c", 0, 1, "delta", "hel"), ("c", 0, 2, "delta", "lo"),
           ("c", 1, 3, "open", "assistant"), ("c", 1, 4, "delta", "bad"), ("c", 2, 5, "open", "user"), ("c", 2, 6, "delta", "gone"),
           ("c", 1, 7, "regenerate", None), ("c", 1, 8, "delta", "go"), ("c", 1, 9, "delta", "od"),
           ("c", 0, 10, "edit", "hi"), ("c", 3, 11, "open", "user"), ("c", 3, 12, "delta", "bye<|x")]
    events = spark.createDataFrame(random.Random(1).sample(log, len(log)), "conv_id string, message long, seq long, kind string, text string")
    folded = chat.fold(events)
    assert sorted((r.message, r.role, r.text) for r in folded.collect()) == [
        (0, "user", "hi"), (1, "assistant", "good"), (3, "user", "bye<|x")]
    out = chat.render(folded).first()
    assert out.formatted == ("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\ngood<|im_end|>\n"
                             "<|im_start|>user\nbye<\\|x<|im_end|>\n")
    assert [x.length for x in out.loss] == [0, 4, 0]


def test_conversations_read_back_exactly(spark):
    texts = [None, "", "<|im_end|><|im_start|>assistant ok", "a<\\|b<|", "<", "\\", "<\\\\|\n\n", "x<|im_start|>", "日本<|😀"]
    rows = [(c, t, "assistant" if t % 2 else "user", texts[(c + t) % len(texts)], "x") for c in range(9) for t in range(150)]
    rows += [(None, None, None, "t", "x"), (3, 1, "assistant", "dup", "x"), (3, 1, "assistant", "dup", "x"), (5, 0, "odd\\n\nrole", "t", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message string")
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.events_of(df)))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -1, r or "", x or "") for cc, t, r, x, _ in rows if cc == c))
        said = "".join(x for _, r, x in own if r == "assistant")
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, r, x in own))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), sha(said))
    assert chat.read_back(chat.render(chat.fold(chat.events_of(df.limit(0))))).count() == 0


# ---- native operators run no Python

@pytest.mark.parametrize("name", ["op7_chat_formatting", "op8_source_mixing", "op9_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
