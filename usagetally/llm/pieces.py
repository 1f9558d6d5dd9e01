"""SentencePiece-style encoding and decoding (operator 6).

Unigram Viterbi over a double-array trie of pieces with log scores: the
segmentation with the greatest sum of scores, a code point without a piece of its
own falling back to its bytes.  Spaces are the marker U+2581 of the pieces; one
marker is put before a text and taken off again by decoding.  A literal U+2581 of
a text goes through its bytes, so decoding gives back every text exactly.

Inside a task the trie walks all positions of all new words of a batch at once,
and the Viterbi recursion advances all words by one offset at a time (numpy); the
segmentations of words seen before come from a table of bounded size.  Cutting at
spaces loses nothing: no piece has a marker after another character (this is
checked; a vocabulary that has one is not cut).

Defined results: null text gives null ids and null text back; the empty text has
no ids; repeated rows are encoded again; an empty table gives no rows; extra
columns are neither read nor returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.llm.common import batches_of, ship
from usagetally.llm.words import span_hashes, word_multipliers

ship(__name__)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
#: Words whose segmentation a task keeps; the table is emptied when it is full.
KEPT_WORDS = 400_000


def double_array(pieces: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a double-array trie: from state s, byte c leads to
    base[s] + c if check[base[s] + c] == s; value is the piece's id or -1."""
    children: list[dict[int, int]] = [{}]
    values = [-1]
    for piece, i in pieces.items():
        node = 0
        for c in piece:
            nxt = children[node].get(c)
            if nxt is None:
                nxt = children[node][c] = len(children)
                children.append({})
                values.append(-1)
            node = nxt
        values[node] = i
    size = 4 * len(children) + 65_536
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    value = np.full(size, -1, np.int32)
    taken = bytearray(size)                  # and the same memory as an array
    free = np.frombuffer(taken, np.uint8)
    head, wide, place = 256, 256, {0: 0}   # so that no base is negative
    taken[:256] = b"\1" * 256
    queue = [0]
    for node in queue:                       # breadth first; few children fill the gaps that many leave
        keys = sorted(children[node])
        if not keys:
            continue
        if len(keys) == 1:
            at = head
            while taken[at]:
                at += 1
            start = at - keys[0]
        else:
            apart, at = np.array(keys) - keys[0], wide
            while True:                      # first slot of a block where every child fits
                spots = at + np.flatnonzero(free[at : at + 512] == 0)
                spots = spots[(free[spots[:, None] + apart] == 0).all(axis=1)]
                if len(spots):
                    start = int(spots[0]) - keys[0]
                    break
                at += 512
            wide = max(wide, at - 4096)
        s = place[node]
        base[s] = start
        for c in keys:
            child = children[node][c]
            t = place[child] = start + c
            check[t], value[t], taken[t] = s, values[child], 1
            queue.append(child)
        while taken[head]:
            head += 1
    used = int(np.flatnonzero(free)[-1]) + 257   # a byte beyond the last state stays inside the arrays
    return base[:used].copy(), check[:used].copy(), value[:used].copy()


def build(pieces: list[tuple[bytes, float] | None], byte_ids: list[int], unknown: int) -> dict:
    """The tables of a vocabulary.  ``pieces[i]``: (UTF-8 with markers, log score) of id i, or
    None if texts can't produce it; ``byte_ids``: the 256 ids of single bytes, or []."""
    plain = {p[0].replace(MARK, b" "): i for i, p in enumerate(pieces) if p and p[0]}
    base, check, value = double_array(plain)
    out = [b""] * len(pieces)
    for p, i in plain.items():
        out[i] = p
    for b, i in enumerate(byte_ids):
        out[i] = bytes([b])
    scores = np.array([p[1] if p else 0.0 for p in pieces])
    unknown_score = min((scores[i] for i in plain.values()), default=0.0) - 10.0
    return {"base": base, "check": check, "value": value, "scores": np.append(scores, unknown_score),
            "bytes": np.array(byte_ids, np.int32), "unknown": unknown, "out": out,
            "cut": not any(re.search(rb"[^ ] ", p) for p in plain), "lines": not any(b"\n" in p for p in plain)}


def load_model(path: str = MODEL) -> dict:
    """Tables of a public SentencePiece model.  Scores of a unigram model are log
    scores; a merge model has ranks 0, -1, -2, .. instead, and the piece of rank r
    gets Zipf's log score -log(r + 2)."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    n = p.get_piece_size()
    normal = [i for i in range(n) if not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i) or p.is_byte(i))]
    score = {i: p.get_score(i) for i in normal}
    if all(s <= 0 and s == int(s) for s in score.values()):
        score = {i: -float(np.log(2.0 - s)) for i, s in score.items()}
    pieces = [(p.id_to_piece(i).encode(), score[i]) if i in score else None for i in range(n)]
    byte_ids = sorted((int(p.id_to_piece(i)[1:-1], 16), i) for i in range(n) if p.is_byte(i))
    return build(pieces, [i for _, i in byte_ids], p.unk_id())


def viterbi(words: list[bytes], t: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best segmentations of ``words`` one after another, and how many each has."""
    size = np.array([len(w) for w in words], np.int64)
    first = np.cumsum(size) - size
    text = np.frombuffer(b"".join(words), np.uint8)
    word = np.repeat(np.arange(len(words), dtype=np.int32), size)
    end = np.repeat((first + size).astype(np.int32), size)
    head = np.flatnonzero((text & 0xC0) != 0x80).astype(np.int32)
    lead = text[head]
    char = np.zeros(len(text), np.int32)
    char[head] = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    single = np.zeros(len(text), bool)
    pos, state, length, found = head, np.zeros(len(head), np.int32), 0, []
    while len(pos):
        inside = pos + length < end[pos]
        pos, state = pos[inside], state[inside]
        step = t["base"][state] + text[pos + length]
        ok = t["check"][step] == state
        pos, state = pos[ok], step[ok]
        length += 1
        ids = t["value"][state]
        hit = ids >= 0
        at = pos[hit]
        found.append((at, np.full(len(at), length, np.int32), ids[hit]))
        if length <= 4:
            single[at[char[at] == length]] = True
    lost = head[~single[head]]
    found.append((lost, char[lost], np.full(len(lost), -1, np.int32)))
    start, span, piece = (np.concatenate(x) for x in zip(*found, strict=True))
    owner = word[start]
    offset = start - first[owner]
    offset = offset.astype(np.uint16 if len(size) and size.max() < 1 << 16 else np.int64)
    order = np.argsort(offset, kind="stable")
    start, span, piece, offset, owner = start[order], span[order], piece[order], offset[order], owner[order]
    score = t["scores"][piece]               # the last one is that of id -1, an unknown code point
    source = start + owner                   # a word of n bytes has n + 1 nodes
    best = np.full(len(text) + len(words), -np.inf)
    best[first + np.arange(len(words))] = 0.0
    back = np.zeros(len(best), np.int64)
    edges = np.flatnonzero(np.diff(offset.astype(np.int64), prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        total = best[source[a:b]] + score[a:b]
        target = source[a:b] + span[a:b]     # no two of one offset meet in a node
        win = total > best[target]
        best[target[win]] = total[win]
        back[target[win]] = np.arange(a, b)[win]
    zero = first + np.arange(len(words))
    at, alive, steps = zero + size, np.flatnonzero(size > 0), []
    while len(alive):
        m = back[at[alive]]
        steps.append((alive, m))
        at[alive] -= span[m]
        alive = alive[at[alive] > zero[alive]]
    if not steps:
        return np.empty(0, np.int32), np.zeros(len(words), np.int64)
    owner = np.concatenate([a for a, _ in steps])
    taken = np.concatenate([m for _, m in steps])
    turn = np.repeat(np.arange(len(steps)), [len(a) for a, _ in steps])
    order = np.lexsort((-turn, owner))
    owner, taken = owner[order], taken[order]
    wide = np.where((piece[taken] < 0) & bool(len(t["bytes"])), span[taken], 1)
    ids = np.repeat(piece[taken], wide)
    if len(t["bytes"]):
        fallen = ids < 0
        here = np.repeat(start[taken], wide) + np.arange(len(ids)) - np.repeat(np.cumsum(wide) - wide, wide)
        ids[fallen] = t["bytes"][text[here[fallen]]]
    else:
        ids[ids < 0] = t["unknown"]
    return ids, np.bincount(owner, weights=wide, minlength=len(words)).astype(np.int64)


class Encoder:
    """Encodes batches of texts; keeps the segmentations of up to KEPT_WORDS words by a 64-bit hash."""

    def __init__(self, tables: dict):
        self.t, self.multipliers = tables, word_multipliers()
        self.clear()

    def clear(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.flat, self.start, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def cuts(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where words begin: at each text, before each run of spaces, around line ends."""
        begin = np.zeros(len(data), bool)
        begin[first] = True
        if self.t["cut"]:
            space = data == 32
            begin[1:] |= space[1:] & ~space[:-1]
            if self.t["lines"]:
                line = data == 10
                begin |= line
                begin[1:] |= line[:-1]
        return np.flatnonzero(begin)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        parts = [b" " + t.encode("utf-8", "replace") if t else b"" for t in texts]
        size = np.array([len(p) for p in parts], np.int64)
        filled = np.flatnonzero(size)
        if not len(filled):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        joined = b"".join(parts)
        data = np.frombuffer(joined, np.uint8)
        first = (np.cumsum(size) - size)[filled]
        begin = self.cuts(data, first)
        end = np.append(begin[1:], len(data))
        if len(self.known) > KEPT_WORDS:
            self.clear()
        h, one, number = np.unique(span_hashes(data, begin, end, self.multipliers), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, h)
        seen = np.zeros(len(h), bool)
        seen[at < len(self.known)] = self.known[at[at < len(self.known)]] == h[at < len(self.known)]
        new = np.flatnonzero(~seen)
        if len(new):
            ids, count = viterbi([joined[i:j] for i, j in zip(begin[one[new]].tolist(), end[one[new]].tolist(), strict=True)], self.t)
            self.start = np.insert(self.start, at[new], len(self.flat) + np.cumsum(count) - count)
            self.count = np.insert(self.count, at[new], count)
            self.known = np.insert(self.known, at[new], h[new])
            self.flat = np.append(self.flat, ids)
            at = np.searchsorted(self.known, h)
        n = self.count[at][number]
        take = np.repeat(self.start[at][number] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        per_text = np.zeros(len(texts), np.int64)
        per_text[filled] = np.add.reduceat(n, np.searchsorted(begin, first))
        return self.flat[take], per_text


def decode_ids(ids, out: list[bytes]) -> str:
    """Text of a sequence of ids: markers become spaces, bytes are joined, the first space goes."""
    text = b"".join([out[i] for i in ids])
    return text[text[:1] == b" " :].decode("utf-8", "replace")


def encode(docs: DataFrame, tables: dict) -> DataFrame:
    """doc_id, n_tokens, token_ids, decoded (the ids' text) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = Encoder(sent.value), sent.value["out"]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in batches_of(texts, rows=2048, chars=1 << 19):
                ids, n = encoder.encode(texts[a:b])
                ends = np.concatenate(([0], np.cumsum(n)))
                back = [None if t is None else decode_ids(ids[i:j].tolist(), out)
                        for t, i, j in zip(texts[a:b], ends[:-1], ends[1:], strict=True)]
                null = pa.array([t is None for t in texts[a:b]], pa.bool_())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=null)
                count = pa.array(n, pa.int64(), mask=np.asarray(null))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), count, lists,
                                                  pa.array(back, pa.string())],
                                                 ["doc_id", "n_tokens", "token_ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, token_ids array<int>, decoded string")


def decode(tokens: DataFrame, tables: dict) -> DataFrame:
    """``tokens`` (doc_id, token_ids) as doc_id, text."""
    sent = tokens.sparkSession.sparkContext.broadcast(tables)

    @F.pandas_udf("string")
    def text_of(lists: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else decode_ids(x.tolist(), sent.value["out"]) for x in lists], dtype=object)

    return tokens.select("doc_id", text_of("token_ids").alias("text"))


__all__ = ["load_model", "build", "encode", "decode", "viterbi", "Encoder", "decode_ids"]
