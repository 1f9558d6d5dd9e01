"""Personal data (operator 11): a semi-Markov conditional random field over whole spans.

1. ``base_spans`` finds plain e-mail addresses, IP addresses, cards and phone numbers
   by fixed patterns, each in one linear pass.
2. Digits and at signs (also written out: ``(at)``, ``at ... dot``) open zones of a text.
   ``segments`` proposes the candidate spans of a zone: runs of digit groups with
   at most ``GROUPS`` groups and ``DIGITS`` digits, and addresses with at most
   ``PIECES`` pieces on each side of the marker.  Bounds on entities keep their
   number linear in the zone.
3. Each candidate is scored as a whole for each type it can have: digit count,
   group lengths, separators, checksum, octets, marker, top-level label, words and
   characters around it.  Labels that follow one another have weights too.
4. Dynamic programming over candidate boundaries picks boundaries and types jointly
   (the best segmentation); text between the segments scores 0.  Zones are apart, so
   taking them one by one gives the best segmentation of the text.

The weights are learned from a bounded sample of texts (``SAMPLE_TEXTS``, then
``EACH`` zones a class): their base spans, the same spans rewritten as people
disguise them (``disguised``), and near misses (``spoiled``: failed checksums, octets
beyond 255, a domain without a name) that are no entity.  Spans that the model
adds never overlap base spans, which all stay.

Defined results: a null or empty text has no spans; spans count code points, the end is
exclusive; spans come by kind (email, ip, card, phone), then start; base spans of
different kinds may overlap; ties between segmentations go to fewer spans, then the
earlier candidate; repeated rows are answered each; a table without rows gives none; if
the sample holds no base span the model adds nothing; extra columns are neither read nor
returned, but ``redact`` keeps them.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagetally.llm.common import free_name, in_sample, ship

ship(__name__)

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
OUTSIDE = 4
#: Bounds of an entity: digit groups, digits, pieces on a side of an address.
GROUPS, DIGITS, PIECES = 8, 19, 4
#: Characters around a trigger that belong to its zone.
AROUND = 48
#: Endings of domains that disguised examples are given (fixed values).
ENDINGS = ("org", "net", "de", "fr", "es", "uk", "io", "edu", "info")
#: Bounds of the learning sample: texts, zones of a text, zones of a class; and passes over it.
SAMPLE_TEXTS, ZONES_EACH, EACH, PASSES = 6_000, 8, 80, 6

# The base patterns (possessive, so that a long run is read once) and their characters.
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    """True for parts of at most 255; long runs of digits aren't turned into numbers."""
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each at sign, so long runs are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at - _LOCAL_END.match(text[done:at][::-1]).end()
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the plain entities, by kind, then start."""
    found = [(EMAIL, s, e) for s, e in emails(text)]
    found += [(IP, *m.span()) for m in _IP.finditer(text) if octets(m.group().split("."))]
    for m in _CARD.finditer(text):
        d = digits_of(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            found.append((CARD, *m.span()))
    if "+" in text:
        found += [(PHONE, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return found


# ---- zones and candidate segments

_TRIGGER = re.compile(r"[0-9@]+")
_WRITTEN = re.compile(r"(?i)[\[({<] ?at ?[\])}>]| at (?=[\w.-]{1,60} dot )")
_DIGITS = re.compile(r"[0-9]+")
#: What may stand between the digit groups of one entity.
_BETWEEN = re.compile(r"(?i) ?(?:[./_\-·‐-―]|[\[(] ?(?:dot|\.) ?[\])]|(?<= )dot(?= )) ?|\) ?[.-]? ?| ?\(|\) ?\(|[  ]{1,2}")
_MARKER = re.compile(r"(?i) ?[\[({<] ?at ?[\])}>] ?| ?@ ?| at ")
_DOT = r"(?:\.|(?i: ?[\[({] ?(?:dot|\.) ?[\])}] ?| dot | \. ?))"
_PIECE_AHEAD = re.compile(rf"({_DOT}?)([A-Za-z0-9-]++)")
_PIECE_BACK = re.compile(rf"([A-Za-z0-9_%+-]++)((?:\.|(?i: ?[\])}}] ?(?:tod|\.) ?[\[({{] ?| tod | ?\. ))?)")
_WORD = re.compile(r"[^\W\d_]+")


def zones(text: str) -> list[tuple[int, int]]:
    """Start and end of the parts of a text where an entity could be."""
    marks = [m.span() for m in _TRIGGER.finditer(text)]
    low = text.lower() if " dot " in text or " DOT " in text or " Dot " in text or re.search(r"[\[({<] ?[aA][tT] ?[\])}>]", text) else ""
    if len(low) == len(text):
        marks = sorted(marks + [m.span() for m in _WRITTEN.finditer(low)])
    found: list[list[int]] = []
    for a, b in marks:
        if found and a - AROUND <= found[-1][1]:
            found[-1][1] = max(found[-1][1], min(len(text), b + AROUND))
        else:
            found.append([max(0, a - AROUND), min(len(text), b + AROUND)])
    return [(a, b) for a, b in found]


def number_segments(text: str, start: int, end: int) -> Iterator[tuple[int, int, tuple[int, ...], list[str], list[str]]]:
    """(start, end, types, groups, separators) of the runs of digit groups of a zone."""
    groups = [m.span() for m in _DIGITS.finditer(text, start, end)]
    joined = [b[0] - a[1] <= 8 and _BETWEEN.fullmatch(text, a[1], b[0]) is not None for a, b in zip(groups, groups[1:], strict=False)]
    for i, (s, _) in enumerate(groups):
        before = text[s - 1] if s else " "
        if before.isalnum() or before == "_":
            continue
        size, j = 0, i
        while j < len(groups) and j - i < GROUPS:
            size += groups[j][1] - groups[j][0]
            if size > DIGITS:
                break
            e = groups[j][1]
            after = text[e] if e < len(text) else " "
            if size >= 4 and not (after.isalnum() or after == "_"):
                at = s
                if before == "(" and ")" in text[s:e]:
                    at -= 1
                if at and text[at - 1] == "+":
                    at -= 1
                seps = [text[groups[k][1] : groups[k + 1][0]] for k in range(i, j)]
                kinds = ((IP,) if j - i == 3 else ()) + ((CARD,) if size >= 12 else ()) + ((PHONE,) if size >= 7 else ())
                if kinds:
                    yield at, e, kinds, [text[a:b] for a, b in groups[i : j + 1]], seps
            if j + 1 < len(groups) and not joined[j]:
                break
            j += 1


def address_segments(text: str, start: int, end: int) -> Iterator[tuple[int, int, str, list[str], list[str]]]:
    """(start, end, marker, labels, separators) of the addresses around the markers of a zone."""
    for m in _MARKER.finditer(text, start, end):
        ahead, at, labels, seps = [], m.end(), [], []
        while len(labels) < PIECES:
            piece = _PIECE_AHEAD.match(text, at, min(len(text), end + AROUND))
            if not piece or bool(piece[1]) != bool(labels):
                break
            labels.append(piece[2])
            seps += [piece[1]] if len(labels) > 1 else []
            at = piece.end()
            if len(labels) > 1:
                ahead.append((at, list(labels), list(seps)))
        if not ahead:
            continue
        back, mirrored, at = [], text[max(0, m.start() - 128) : m.start()][::-1], 0
        while len(back) < PIECES:
            piece = _PIECE_BACK.match(mirrored, at)
            if not piece:
                break
            back.append(m.start() - at - len(piece[1]))
            if not piece[2]:
                break
            at = piece.end()
        for s in back:
            for e, some, between in ahead:
                yield s, e, m.group(), some, between


def shape(sep: str) -> str:
    """A separator with its spaces folded and its word in lower case."""
    return re.sub(r"\s+", " ", sep).lower()


def segments(text: str, start: int, end: int) -> list[tuple[int, int, tuple[int, ...], list[str]]]:
    """(start, end, possible types, features) of the candidates of a zone, in order."""
    found = []

    def around(s: int, e: int) -> list[str]:
        words = _WORD.findall(text[max(0, s - 24) : s])
        before, after = text[s - 1 : s] or " ", text[e : e + 1] or " "
        left = re.sub(r"\s+$", "", text[max(0, s - 4) : s])[-1:]
        right = re.match(r"\s*(.?)", text[e : e + 4])[1]
        return [f"word:{words[-1].lower()[:12] if words else ''}", f"before:{before if not before.isalnum() else 'a'}",
                f"after:{after if not after.isalnum() else 'a'}", f"left:{'0' if left.isdigit() else 'a' if left.isalnum() else left}",
                f"right:{'0' if right.isdigit() else 'a' if right.isalnum() else right}"]

    for s, e, kinds, groups, seps in number_segments(text, start, end):
        size = sum(map(len, groups))
        kinds_of_sep = sorted({shape(x) for x in seps})
        lengths = "-".join(str(len(g)) for g in groups)
        form = "+" if text[s] == "+" else "00" if groups[0].startswith("00") else ""
        feats = ["bias", f"digits:{size}", f"groups:{len(groups)}", f"lengths:{lengths}", f"seps:{'|'.join(kinds_of_sep)}",
                 f"form:{form}", f"formed:{form}:{size}:{len(groups)}", f"each:{max(map(len, groups)) <= 3}:{len(groups)}",
                 f"octets:{len(groups) == 4 and octets(groups)}:{len(kinds_of_sep)}", f"lead:{groups[0][0]}"]
        if size >= 12:
            feats += [f"luhn:{size >= 13 and luhn(''.join(groups))}", f"even:{len({len(g) for g in groups[:-1]}) <= 1}:{size}"]
        found.append((s, e, kinds, feats + around(s, e)))
    for s, e, marker, labels, seps in address_segments(text, start, end):
        dots = "|".join(sorted({shape(x) for x in seps}))
        feats = ["bias", f"marker:{shape(marker)}", f"dots:{dots}", f"both:{shape(marker)}:{dots}", f"labels:{len(labels)}",
                 f"top:{labels[-1].lower() if len(labels[-1]) < 5 else len(labels[-1])}", f"inner:{labels[0].isalpha()}",
                 f"name:{text[s:e].split(marker)[0].isalpha()}", f"namelen:{min(8, len(text[s:e].split(marker)[0]))}"]
        found.append((s, e, (EMAIL,), feats + around(s, e)))
    return sorted(found, key=lambda x: (x[1], x[0], x[2]))


# ---- the field

class Field:
    """Weights by feature (a number for each type) and by pair of neighbouring labels."""

    def __init__(self):
        self.weights: dict[str, np.ndarray] = {}
        self.follow = np.zeros((5, 5))

    def score(self, feats: list[str]) -> np.ndarray:
        total = np.zeros(4)
        for f in feats:
            w = self.weights.get(f)
            if w is not None:
                total += w
        return total

    def lattice(self, found: list) -> tuple[list[int], list[list[tuple[int, int, int, float]]]]:
        """Boundaries in order; for each, the segments that end there: (place of the start, type, candidate, score)."""
        places = sorted({p for s, e, _, _ in found for p in (s, e)})
        at = {p: k for k, p in enumerate(places)}
        ends: list[list] = [[] for _ in places]
        for n, (s, e, kinds, feats) in enumerate(found):
            scores = self.score(feats)
            ends[at[e]] += [(at[s], k, n, float(scores[k])) for k in kinds]
        return places, ends

    def best(self, found: list) -> list[tuple[int, int, int]]:
        """(type, start, end) of the segments of the best segmentation."""
        if not found:
            return []
        places, ends = self.lattice(found)
        value = np.full((len(places), 5), -np.inf)
        value[0, OUTSIDE] = 0.0
        came: dict[tuple[int, int], tuple] = {}
        for p in range(1, len(places)):
            stay = value[p - 1] + self.follow[:, OUTSIDE]
            value[p, OUTSIDE], came[p, OUTSIDE] = stay.max(), (p - 1, int(stay[::-1].argmax() * -1 + 4), None)
            for q, kind, n, score in ends[p]:
                path = value[q] + self.follow[:, kind]
                if path.max() + score > value[p, kind]:
                    value[p, kind], came[p, kind] = path.max() + score, (q, int(path[::-1].argmax() * -1 + 4), n)
        p, label = len(places) - 1, int(value[-1][::-1].argmax() * -1 + 4)
        out = []
        while p > 0:
            q, before, n = came[p, label]
            if n is not None:
                out.append((label, found[n][0], found[n][1]))
            p, label = q, before
        return out[::-1]

    def marginals(self, found: list) -> tuple[dict[tuple[int, int], float], np.ndarray]:
        """Probability of each (candidate, type), and expected count of each pair of labels."""
        places, ends = self.lattice(found)
        ahead = np.full((len(places), 5), -np.inf)
        ahead[0, OUTSIDE] = 0.0
        for p in range(1, len(places)):
            ahead[p, OUTSIDE] = np.logaddexp.reduce(ahead[p - 1] + self.follow[:, OUTSIDE])
            for q, kind, _, score in ends[p]:
                ahead[p, kind] = np.logaddexp(ahead[p, kind], np.logaddexp.reduce(ahead[q] + self.follow[:, kind]) + score)
        total = np.logaddexp.reduce(ahead[-1])
        back = np.full((len(places), 5), -np.inf)
        back[-1] = 0.0
        pairs, chances = np.zeros((5, 5)), {}
        for p in range(len(places) - 1, 0, -1):
            step = self.follow[:, OUTSIDE] + back[p, OUTSIDE]
            pairs[:, OUTSIDE] += np.exp(ahead[p - 1] + step - total)
            back[p - 1] = np.logaddexp(back[p - 1], step)
            for q, kind, n, score in ends[p]:
                step = self.follow[:, kind] + score + back[p, kind]
                each = np.exp(ahead[q] + step - total)
                pairs[:, kind] += each
                chances[n, kind] = float(each.sum())
                back[q] = np.logaddexp(back[q], step)
        return chances, pairs


def label_pairs(found: list, truth: list[tuple[int, int, int]]) -> np.ndarray:
    """Counts of neighbouring labels along a given segmentation, in the steps of the lattice."""
    places = sorted({p for s, e, _, _ in found for p in (s, e)})
    at, pairs, here, label = {p: k for k, p in enumerate(places)}, np.zeros((5, 5)), 0, OUTSIDE
    for kind, s, e in [*truth, (None, places[-1], None)]:
        while here < at[s]:
            pairs[label, OUTSIDE] += 1
            here, label = here + 1, OUTSIDE
        if kind is not None:
            pairs[label, kind] += 1
            here, label = at[e], kind
    return pairs


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], passes: int = PASSES, rate: float = 0.5, shrink: float = 1e-3) -> Field:
    """Conditional likelihood of the true segmentations, by gradient steps with a rate for each weight (AdaGrad).

    ``examples``: zone text and its entities; an example whose entities aren't all candidates is left out."""
    ready = []
    for text, truth in examples:
        found = segments(text, 0, len(text))
        number = {(s, e): n for n, (s, e, _, _) in enumerate(found)}
        truth = sorted(truth, key=lambda x: x[1])
        apart = all(a[2] <= b[1] for a, b in zip(truth, truth[1:], strict=False))
        if found and apart and all((s, e) in number and k in found[number[s, e]][2] for k, s, e in truth):
            ready.append((found, {(number[s, e], k) for k, s, e in truth}, label_pairs(found, truth)))
    field, squares, pair_squares = Field(), {}, np.full((5, 5), 1e-6)
    order = random.Random(11)
    for _ in range(passes):
        order.shuffle(ready)
        for found, truth, pairs in ready:
            chances, expected = field.marginals(found)
            g = pairs - expected - shrink * field.follow
            pair_squares += g * g
            field.follow += rate * g / np.sqrt(pair_squares)
            change: dict[str, np.ndarray] = {}
            for (n, kind), chance in chances.items():
                d = ((n, kind) in truth) - chance
                if abs(d) > 1e-4:
                    for f in found[n][3]:
                        change.setdefault(f, np.zeros(4))[kind] += d
            for f, g in change.items():
                w = field.weights.setdefault(f, np.zeros(4))
                g = g - shrink * w
                total = squares.setdefault(f, np.full(4, 1e-6))
                total += g * g
                w += rate * g / np.sqrt(total)
    return field


# ---- what is learned from: base spans, disguises, near misses

def disguised(kind: int, plain: str, pick: random.Random) -> str:
    """A base entity as people write it to hide it, or in another layout."""
    if kind == EMAIL:
        marker, dot = pick.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" @ ", " . "), ("[at]", "."),
                                   (" (at) ", " (dot) "), (" @ ", "."), ("[at]", "[dot]"), ("(at)", "."), (" AT ", " DOT ")])
        name, domain = plain.split("@")
        if pick.random() < 0.5:                              # other endings and names than the sample's own
            domain = domain.rsplit(".", 1)[0] + "." + pick.choice(ENDINGS)
        if pick.random() < 0.3:
            name = re.sub(r"[^A-Za-z]", "", name) or name
        if pick.random() < 0.3:
            domain = ".".join(domain.split(".")[-2:])
        return name.replace(".", dot if pick.random() < 0.5 else ".") + marker + domain.replace(".", dot)
    if kind == IP:
        return plain.replace(".", pick.choice([" . ", "[.]", " dot ", "(.)", "[dot]", "(dot)", " [.] "]))
    d = digits_of(plain)
    if kind == CARD:
        sep = pick.choice([".", "/", "_", "  ", " - ", "–"])
        return sep.join(d[k : k + 4] for k in range(0, len(d), 4))
    sep = pick.choice([".", " ", "-", "/", "_", " - "])
    lead, rest = d[:-10], d[-10:]
    area, body = rest[:-7], rest[-7:-4] + sep + rest[-4:]
    return pick.choice([f"{lead}{sep}{area}{sep}{body}", f"({area}) {rest[-7:-4]}-{rest[-4:]}", f"00{lead}{sep}{area}{sep}{body}",
                        f"{area}{sep}{body}", f"+{lead}/{area}/{rest[-7:-4]}/{rest[-4:]}"])


def spoiled(kind: int, plain: str, pick: random.Random) -> str:
    """A near miss of a base entity, which is no entity in any layout."""
    if kind == EMAIL:
        return pick.choice(["look at ", "it is at ", "meet at "]) + plain.split("@")[1].replace(".", pick.choice([".", ". "]))
    if kind == IP:
        parts = plain.split(".")
        parts[pick.randrange(4)] = str(pick.randrange(256, 999))
        return pick.choice([".", " . ", "[.]", "-"]).join(parts)
    d = digits_of(plain)
    if kind == CARD:
        k = pick.randrange(len(d))
        wrong = d[:k] + str((int(d[k]) + pick.randrange(1, 10)) % 10) + d[k + 1 :]
        wrong = wrong if not luhn(wrong) else d[:-1] + str((int(d[-1]) + 1) % 10)
        return pick.choice(["", " ", "-", ".", "/"]).join(wrong[k : k + 4] for k in range(0, len(wrong), 4))
    return pick.choice([
        f"{pick.randrange(1900, 2100)}-{pick.randrange(1, 13):02}-{pick.randrange(1, 29):02}", d[:7], d[:8], d[-10:], d,
        f"{pick.randrange(1, 29):02}.{pick.randrange(1, 13):02}.{pick.randrange(1900, 2100)}",
        f"{pick.randrange(1, 999)}.{pick.randrange(1000, 9999999)}", f"{pick.randrange(1900, 2100)}-{pick.randrange(1900, 2100)}",
        f"{pick.randrange(1, 99)} {pick.randrange(1, 999)} {pick.randrange(100, 999)}"])


def examples_of(zone: str, number: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """The zone with its base spans, each of them disguised, and each of them spoiled."""
    pick, base = random.Random(f"{number}:{zone}"), sorted(base_spans(zone), key=lambda x: x[1])
    if any(a[2] > b[1] for a, b in zip(base, base[1:], strict=False)):
        return []

    def rewritten(how, entity: bool) -> tuple[str, list[tuple[int, int, int]]]:
        out, spans, done = "", [], 0
        for kind, s, e in base:
            out += zone[done:s]
            new = how(kind, zone[s:e], pick)
            if entity:
                spans.append((kind, len(out), len(out) + len(new)))
            out, done = out + new, e
        return out + zone[done:], spans

    return [(zone, base)] + ([rewritten(disguised, True), rewritten(disguised, True), rewritten(spoiled, False)] if base else [])


def train(docs: DataFrame, texts: int = SAMPLE_TEXTS, each: int = EACH, passes: int = PASSES) -> Field:
    """Fit on at most ``each`` zones of each class (a kind, or none) from about ``texts`` distinct texts.

    A hash of the text picks, so copies count once and the sample is the same on every run."""
    total = docs.count()
    picked = docs.select("text").where(F.col("text").isNotNull() & in_sample(F.xxhash64("text"), texts / max(total, 1), 11))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(0).to_pylist():
                found = zones(t)
                for a, b in random.Random(len(t)).sample(found, min(ZONES_EACH, len(found))):
                    if b - a <= 16 * AROUND:
                        first = base_spans(t[a:b])
                        rows.append((first[0][0] if first else OUTSIDE, t[a:b]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())],
                                             ["kind", "zone"])

    found = picked.mapInArrow(run, "kind int, zone string").distinct()
    first = Window.partitionBy("kind").orderBy(F.xxhash64("zone"), "zone")
    kept = found.withColumn("at", F.row_number().over(first)).where(F.col("at") <= each).orderBy("kind", "at").collect()  # 5 x each
    return fit([x for r in kept for x in examples_of(r.zone, r.at)], passes)


# ---- whole tables

def all_spans(text: str | None, field: Field) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of the base spans and of those that the field adds, by kind, then start."""
    if not text:
        return []
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    starts, ends = np.array([s for s, _ in taken], np.int64), np.maximum.accumulate(np.array([e for _, e in taken] or [0], np.int64))

    def free(s: int, e: int) -> bool:
        k = int(np.searchsorted(starts, e))
        return not k or int(ends[k - 1]) <= s

    added = []
    for a, b in zones(text):
        added += field.best([c for c in segments(text, a, b) if free(c[0], c[1])])
    return sorted({(k, s, e, True) for k, s, e in base} | {(k, s, e, False) for k, s, e in added})


def find(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, spans (kind, start, end, base: in order) for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in all_spans(t.as_py(), sent.value)]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def masked(text: str, field: Field) -> str:
    """The text with each span, or union of overlapping spans, replaced by its kind in brackets."""
    out, done = "", 0
    for s, e, kind in sorted((s, -e, k) for k, s, e, _ in all_spans(text, field)):
        if s >= done:
            out, done = out + text[done:s] + f"[{KINDS[kind].upper()}]", -e
        else:
            done = max(done, -e)
    return out + text[done:]


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` (all columns) with personal data masked in ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    name = free_name(docs, "__masked")

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(lambda t: None if t is None else masked(t, sent.value))

    return docs.withColumn(name, mask(F.col("text"))).withColumn("text", F.col(name)).drop(name)


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans as text, and how many were added."""
    base = F.filter("spans", lambda s: s["base"])
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"),
                        (F.size("spans") - F.size(base)).cast("long").alias("n_added"))


__all__ = ["train", "find", "redact", "digest_columns", "base_spans", "all_spans", "segments", "zones", "fit", "Field", "KINDS"]
