"""Licence scans: fingerprints that no match lacks, the band, many matches, the library in a zip."""

import random
import subprocess
import sys
import time
import zipfile
from pathlib import Path

import numpy as np

import usagetally
from usagetally.llm import licenses as lic
from usagetally.llm.words import word_multipliers


def edited(words, rate, rng, others):
    out = []
    for w in words:
        r = rng.random()
        out += [] if r < rate / 3 else [w, rng.choice(others)] if r < 2 * rate / 3 else [rng.choice(others)] if r < rate else [w]
    return out


def table_common(words, template, below, above):
    """The longest common sequence with each beginning of ``words``, by the full table, matches inside the band only."""
    row, lengths = [0] * (len(template) + 1), []
    for j, w in enumerate(words):
        new = [0]
        for i, t in enumerate(template):
            new.append(max(row[i] + 1 if w == t and j - below <= i <= j + above else 0, new[i], row[i + 1]))
        row = new
        lengths.append(row[-1])
    return lengths


def test_band_holds_every_match():
    rng = random.Random(1)
    for _ in range(600):
        size = rng.randrange(1, 60)
        template = [rng.randrange(12) for _ in range(size)]
        words = edited(template, rng.choice([0, 0.1, 0.2, 0.3]), rng, range(12))[: size * 100 // lic.PERCENT]
        slack = rng.choice([0, size // 10])
        below, above = lic.band(size)
        got = lic.common(words, lic.masks(template), size, slack)
        assert got == table_common(words, template, below + slack, above)
        for j, (mine, whole) in enumerate(zip(got, table_common(words, template, 10**6, 10**6), strict=True)):
            assert mine <= whole and (mine == whole or 100 * whole < lic.PERCENT * max(size, j + 1))


def test_every_match_shares_the_sure_fingerprints():
    """Random pairs of sequences that match by the longest common sequence share as many fingerprints as is sure."""
    rng, matched = random.Random(2), 0
    for _ in range(20_000):
        size = rng.randrange(1, 40)
        template = np.array([rng.randrange(1000) for _ in range(size)], np.uint64)
        words = np.array(edited(template.tolist(), rng.choice([0.1, 0.2, 0.25]), rng, range(1000, 1100)), np.uint64)
        if not len(words) or 100 * table_common(words.tolist(), template.tolist(), 10**6, 10**6)[-1] < lic.PERCENT * max(size, len(words)):
            continue
        matched += 1
        window = 2 if lic.sure_prints(size, 2) else 1
        a, b = (dict(zip(*np.unique(x[lic.prints(x, window)], return_counts=True), strict=True)) for x in (template, words))
        assert sum(min(n, b.get(w, 0)) for w, n in a.items()) >= lic.sure_prints(size, window) >= 1
    assert matched > 2000


def left_to_right(words, template):
    """The rule of ``matches`` by unbanded tables: from the left, each start's best end, then tighter starts."""
    size, reach, found, s = len(template), len(template) * 100 // lic.PERCENT, [], 0
    while s < len(words):
        start, best = s, None
        while words[start] in template:
            lengths = table_common(words[start : start + reach], template, 10**6, 10**6)
            e = max(range(len(lengths)), key=lambda x: (lengths[x] / max(size, x + 1), -x))
            if 100 * lengths[e] < lic.PERCENT * max(size, e + 1):
                break
            back = table_common(words[start : start + e + 1][::-1], template[::-1], 10**6, 10**6)
            later = start + e - back.index(lengths[e])
            best = (lengths[e], later, start + e)
            if later == start:
                break
            start = later
        if best:
            found.append(best)
        s = best[2] + 1 if best else s + 1
    return found


def test_existence_coverage_and_span_by_brute_force():
    """Every template of up to 120 words, 0 to 25 per cent of its words edited, two copies in a text."""
    rng, m, index = random.Random(5), word_multipliers(), lic.build_index(lic.TEMPLATES)
    seen = {True: 0, False: 0}
    for number, size in enumerate(index["size"]):
        if size > 120:
            continue
        template = lic.plain_words(lic.TEMPLATES[index["names"][number]], m)[0]
        own = np.searchsorted(index["vocabulary"], template).tolist()
        for rate in (0, 0.1, 0.2, 0.25):
            noise = [len(index["vocabulary"])] * 3
            words = noise + edited(own, rate, rng, own) + noise + edited(own, rate, rng, own + noise) + noise
            want = left_to_right(words, own)
            h = np.append(index["vocabulary"], np.uint64(7))[words]
            assert lic.matches(np.array(words), index, number, lic.prints(h, int(index["window"][number]))) == want
            seen[bool(want)] += 1
    assert seen[True] > 60 and seen[False] > 5


def test_whole_licences_with_edits():
    """Long templates against the unbanded sequence over their whole length."""
    rng, m, index = random.Random(6), word_multipliers(), lic.build_index(lic.TEMPLATES)
    for name in ("Apache-2.0-text", "MPL-2.0-text", "BSD-3-Clause-text", "CC0-1.0-text"):
        number = index["names"].index(name)
        own = lic.TEMPLATES[name].split()
        for rate in (0.05, 0.15):
            text = "the first words " + " ".join(edited(own, rate, rng, ["zebra", "of", "the"])) + " and the last ones"
            got = [x for x in lic.scan_text(text, index, m) if x[0] == name]
            assert len(got) == 1 and got[0][1] > 1 - 1.5 * rate and index["size"][number] * (1 - 1.5 * rate) < got[0][2]


def test_many_matches_take_linear_time():
    m, index = word_multipliers(), lic.build_index(lic.TEMPLATES)
    took = {}
    for n in (2_000, 8_000):
        text = "é Released under the MIT License. " * n
        start = time.perf_counter()
        got = lic.scan_text(text, index, m)
        took[n] = time.perf_counter() - start
        assert len(got) == n and all(text[x[3] : x[4]] == "Released under the MIT License" for x in got)
    assert took[8_000] < 1


def test_overlaps_are_as_by_pairs():
    rng = random.Random(8)
    for _ in range(300):
        found = set()
        for name in "abc":
            at = 0
            while at < 60 and rng.random() < 0.9:
                at += rng.randrange(6)
                end = at + rng.randrange(1, 15)
                found.add((name, rng.choice([0.8, 0.9, 1.0]), rng.randrange(1, 9), at, end))
                at = end
        want = [x for x in found if not any(y[1] * y[2] > x[1] * x[2] and y[3] < x[4] and x[3] < y[4] for y in found)]
        assert lic.unbeaten(list(found)) == sorted(want, key=lambda x: (x[3], x[0]))


def test_all_templates_are_there_in_a_zip(tmp_path):
    """The library packed as for ``--py-files`` holds the whole licences."""
    top = Path(usagetally.__file__).parent
    packed = tmp_path / "usagetally.zip"
    with zipfile.ZipFile(packed, "w") as z:
        for f in top.rglob("*"):
            if f.is_file() and "__pycache__" not in f.parts:
                z.write(f, f.relative_to(top.parent))
    code = ("import sys; sys.path.insert(0, sys.argv[1]); from usagetally.llm import licenses as l; "
            "print(l.__file__); print(len(l.TEMPLATES), sum(n.endswith('-text') for n in l.TEMPLATES))")
    out = subprocess.run([sys.executable, "-c", code, str(packed)], capture_output=True, text=True, check=True, cwd=tmp_path).stdout.split("\n")
    assert str(packed) in out[0] and out[1] == f"{len(lic.TEMPLATES)} 12"
