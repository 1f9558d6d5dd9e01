"""Licence scans (operator 3): winnowed fingerprints in an inverted index, banded alignment.

Templates and texts are sequences of plain words (lower-cased, punctuation
dropped).  A match holds at least ``PERCENT`` of the words of the template and of its
span, in order.

1. Winnowing: of each ``window`` consecutive grams the one with the least hash is kept,
   by the same rule in templates and texts.  Gram and window follow from the template's
   length: one changed word in five may leave runs of two equal words and no longer one,
   however long the template, so grams are single words and the window is 2 (1 for
   templates whose matches needn't hold a run of two).  ``sure_prints`` is the number of
   fingerprints that any match shares at least.
2. The inverted index (fingerprint -> templates, how often) is bounded by the templates
   and broadcast.  Each text is looked up whole; templates that share fewer
   fingerprints than sure, or of whose words the text holds too few, are no candidates.
3. Windows of candidates with enough shared fingerprints and words are aligned: the
   longest common word sequence in a band.  A match leaves the main diagonal by at most
   20 % of the longer side, so for matches the band is exact.  The band slides over
   bit vectors of its own width.

Steps 1 and 2 leave out only what can't reach ``PERCENT``, so every text with a match
gets one.  A match is reported with its span, unless one with more words times
coverage overlaps it; coverage is the share of the template's words or, if more, of the
span's, so extra words lower it.  Work is linear in the text, however many matches.

Defined results: null, empty and unmatched texts give no rows; a repeated row is
reported again; a template that occurs several times in a text gives a row for each
place; an empty table gives no rows; extra columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.llm.common import ship
from usagetally.llm.words import PLAIN, word_hashes, word_multipliers

ship(__name__)

#: Least share of the words of a template and of the span, in per cent.
PERCENT = 80

#: Short notices and opening passages, also of the variants that differ by a word; headers and
#: the whole licences follow below.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "MIT-notice": "Released under the MIT License",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0-notice": "Licensed under CC BY-NC-ND 4.0",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
           "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "Apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
           "Public License as published by the Free Software Foundation",
    "LGPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
            "General Public License as published by the Free Software Foundation",
    "AGPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
            "General Public License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}


#: The notices that licences ask to put into each file, whole.
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public "
        "License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more "
        "details. You should have received a copy of the GNU {0}General Public License along with this program")
TEMPLATES |= {f"{name}-{v}-header": _GNU.format(word, v[:-2] if v.endswith(".0") else v) for name, word, v in (
    ("GPL", "", "2.0"), ("GPL", "", "3.0"), ("LGPL", "Lesser ", "2.1"), ("LGPL", "Lesser ", "3.0"), ("AGPL", "Affero ", "3.0"))}
TEMPLATES |= {
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                         "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                         "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                         "permissions and limitations under the License",
    "MPL-2.0-header": TEMPLATES["MPL-2.0"] + ". If a copy of the MPL was not distributed with this file, You can obtain one at "
                      "https://mozilla.org/MPL/2.0/",
}


def whole_licenses() -> dict[str, str]:
    """Apache, BSD with two and three clauses, CC0, GPL, ISC, LGPL, MIT, MPL, Unlicense; read on the driver, also from a zip."""
    found = {f"{f.name.removesuffix('.txt')}-text": f.read_text("utf-8")
             for f in sorted(files("usagetally.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}
    if not found:
        raise FileNotFoundError("license_texts holds no licence: the library was packed without its data files")
    return found


TEMPLATES |= whole_licenses()


def plain_words(text: str, multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    data = text.encode("utf-8", "replace")
    return *word_hashes(data.translate(PLAIN), multipliers), data


def masks(words: list[int]) -> dict[int, int]:
    """The places of each word of a sequence, as bits."""
    found: dict[int, int] = {}
    for place, w in enumerate(words):
        found[w] = found.get(w, 0) | 1 << place
    return found


def least(size: int) -> int:
    """The fewest words of a template that a match holds."""
    return -(-PERCENT * size // 100)


def sure_prints(size: int, window: int) -> int:
    """The fewest fingerprints that a match of a template of ``size`` words shares with it.

    n common words in a span fall into at most size + span - 2n + 1 runs (each word that only one side
    has can split one); a run of r words holds at least floor(r / 2) common fingerprints if the
    window is 2, and r if it is 1."""
    fewest = size
    for span in range(least(size), size * 100 // PERCENT + 1):
        n = least(max(size, span))
        if n <= min(size, span):
            runs = size + span - 2 * n + 1
            fewest = min(fewest, n if window == 1 else max(0, -((runs - n) // 2)))
    return fewest


def prints(h: np.ndarray, window: int) -> np.ndarray:
    """True at the places of a word sequence that winnowing keeps (of two equal neighbours the later)."""
    keep = np.ones(len(h), bool)
    if window == 2 and len(h) > 1:
        ahead = h[:-1] < h[1:]
        keep[:-1], keep[-1] = ahead, False
        keep[1:] |= ~ahead
    return keep


def build_index(templates: dict[str, str]) -> dict:
    """Sorted word hashes of the templates; by template, its words and its fingerprints with how often it has them, the
    fewest words and fingerprints of a match, and bits of the places of its words."""
    m = word_multipliers()
    hashes = [plain_words(text, m)[0] for text in templates.values()]
    vocabulary = np.unique(np.concatenate(hashes))
    words = [np.searchsorted(vocabulary, h) for h in hashes]
    windows = [2 if sure_prints(len(h), 2) else 1 for h in hashes]
    own = [np.unique(w, return_counts=True) for w in words]
    kept = [np.unique(w[prints(h, k)], return_counts=True) for w, h, k in zip(words, hashes, windows, strict=True)]
    return {"names": list(templates), "vocabulary": vocabulary, "size": [len(w) for w in words], "window": np.array(windows),
            "word": np.concatenate([u for u, _ in own]), "often": np.concatenate([n for _, n in own]),
            "first": np.cumsum([0] + [len(u) for u, _ in own]), "need": np.array([least(len(w)) for w in words]),
            "print": np.concatenate([u for u, _ in kept]), "print_often": np.concatenate([n for _, n in kept]),
            "print_first": np.cumsum([0] + [len(u) for u, _ in kept]),
            "print_need": np.array([sure_prints(len(w), k) for w, k in zip(words, windows, strict=True)]),
            "ahead": [masks(w.tolist()) for w in words], "back": [masks(w[::-1].tolist()) for w in words]}


def reached(size: int, span: int) -> int:
    """The words that a match is a share of: the template's or, if more, those of its span."""
    return max(size, span)


def match_share(n: int, size: int, span: int) -> float:
    return n / reached(size, span)


def band(size: int) -> tuple[int, int]:
    """How far a match runs below and above the main diagonal (span place minus template place, and the reverse).

    At most a fifth of the span, which is at most size / 0.8 long, lies outside the match, and at most a fifth of the template."""
    return size * (100 - PERCENT) // PERCENT, size - least(size)


def common(words: list[int], places: dict[int, int], size: int, slack: int = 0) -> list[int]:
    """Length of the longest common word sequence, inside the band, of a template with each beginning of ``words``.

    One bit a template place: a 0 is a place where the length grows.  Places below the band can't change any more: their
    zeros are counted and the bits dropped.  Places above it are all ones and are added as the band gets there."""
    below, above = band(size)
    below += slack
    low, high = 0, min(size, above)                              # template places [low, high) are in the vector
    v, done, lengths = (1 << high) - 1, 0, []
    for j, w in enumerate(words):
        if high < size and high <= j + above:
            v |= 1 << (high - low)
            high += 1
        if low < high and low < j - below:
            done += 1 - (v & 1)
            v >>= 1
            low += 1
        full = (1 << (high - low)) - 1
        here = v & (places.get(w, 0) >> low) & full
        if here:
            v = ((v + here) | (v - here)) & full
        lengths.append(done + (high - low) - v.bit_count())
    return lengths


def matches(words: np.ndarray, index: dict, number: int, kept: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Matched words, first and last matched place of each match of a template, from left to right.

    ``words``: places in the index's vocabulary; ``kept``: what winnowing keeps of them.  A match is no longer than the
    template over PERCENT and holds PERCENT of its words.  The band of a start is widened by ``slack``, so from a start whose
    longest sequence lacks k words, the next k - 1 starts within the slack can't have a match either."""
    size, need = index["size"][number], int(index["need"][number])
    reach, slack = size * 100 // PERCENT, size // 10
    at = np.arange(len(words))
    end = np.minimum(at + reach, len(words))

    def inside(key: str, of: np.ndarray | None = None) -> np.ndarray:
        known = np.zeros(len(index["vocabulary"]) + 1, bool)
        known[index[key][index[f"{key}_first" if key == "print" else "first"][number] :
                         index[f"{key}_first" if key == "print" else "first"][number + 1]]] = True
        return known[words] if of is None else known[words] & of

    def in_reach(member: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(member))
        return total[end] - total[at]

    member = inside("word")
    likely = member & (in_reach(member) >= need)
    if kept is not None:
        likely &= in_reach(inside("print", kept)) >= index["print_need"][number]
    starts = np.flatnonzero(likely)
    found, k = [], 0
    while k < len(starts):
        s, best = int(starts[k]), None
        while True:
            lengths = common(words[s : s + reach].tolist(), index["ahead"][number], size, slack)
            e = max(range(len(lengths)), key=lambda x: (match_share(lengths[x], size, x + 1), -x))
            if 100 * lengths[e] < PERCENT * reached(size, e + 1):
                break
            n = lengths[e]
            back = common(words[s : s + e + 1][::-1].tolist(), index["back"][number], size, slack)
            later = s + e - next(x for x, length in enumerate(back) if length >= n)
            best = (n, later, s + e)
            if later == s:
                break
            s = later                                            # a tighter start may have a better end
        if best:
            found.append(best)
            k = int(np.searchsorted(starts, best[2] + 1))
        else:
            k = int(np.searchsorted(starts, s + max(1, min(need - max(lengths), slack + 1))))
    return found


def unbeaten(found: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """The matches that no overlapping one with more words times coverage beats.

    A sweep from left to right; matches of one template don't overlap, so at most one a template is open."""
    ordered, beaten, still = sorted(set(found), key=lambda x: (x[3], x[0])), set(), []
    for x in ordered:
        still = [y for y in still if y[4] > x[3]]
        for y in still:
            a, b = x[1] * x[2], y[1] * y[2]
            if a != b:
                beaten.add(x if a < b else y)
        still.append(x)
    return [x for x in ordered if x not in beaten]


def scan_text(text: str, index: dict, multipliers: np.ndarray) -> list[tuple[str, float, int, int, int]]:
    """(licence, coverage, matched words, start, end) of each match; the span in code points."""
    h, starts, ends, data = plain_words(text, multipliers)
    if not len(h):
        return []
    vocabulary = index["vocabulary"]
    words = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    words = np.where(vocabulary[words] == h, words, len(vocabulary))

    def enough(key: str, sequence: np.ndarray, first: str, often: str, need: str) -> np.ndarray:
        shared = np.minimum(np.bincount(sequence, minlength=len(vocabulary) + 1)[index[key]], index[often])
        return np.add.reduceat(shared, index[first][:-1]) >= index[need]

    kept = {window: prints(h, window) for window in set(index["window"].tolist())}
    likely = np.zeros(len(index["names"]), bool)
    for window, keep in kept.items():
        likely |= (index["window"] == window) & enough("print", words[keep], "print_first", "print_often", "print_need")
    if not likely.any():
        return []
    likely &= enough("word", words, "first", "often", "need")
    found = [(number, *x) for number in np.flatnonzero(likely).tolist()
             for x in matches(words, index, number, kept[int(index["window"][number])])]
    if not found:
        return []
    # code points before each byte
    points = np.append(0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))
    return unbeaten([(index["names"][number], match_share(n, index["size"][number], end - first + 1), n,
                      int(points[starts[first]]), int(points[ends[end]])) for number, n, first, end in found])


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, coverage, matched_words, start, end: a row for each match."""
    sent = docs.sparkSession.sparkContext.broadcast(build_index(templates or TEMPLATES))
    fields = [("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()),
              ("matched_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = word_multipliers()
        for batch in batches:
            rows = [(i.as_py(), *x) for i, t in zip(batch.column(0), batch.column(1), strict=True)
                    for x in scan_text(t.as_py() or "", sent.value, m)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)],
                                             [n for n, _ in fields])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, license string, coverage double, matched_words long, start long, end long")


__all__ = ["scan", "scan_text", "build_index", "matches", "common", "prints", "sure_prints", "TEMPLATES"]
