"""Vectorised 64-bit hashes of words and word sequences (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

from usagetally.llm.common import ship

ship(__name__)

#: For plain words: lower-case A-Z, keep letters, digits and bytes of non-ASCII letters, blank the rest.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift-multiply avalanche); consumes its argument."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def salts(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd pseudo-random multipliers."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * step) | np.uint64(1)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of ``data``."""
    b = np.frombuffer(data, np.uint8)
    inside = (b != 32) & ((b - np.uint8(9)) > 4)
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """A hash for each span of bytes (multilinear in them, then mixed); spans follow one
    another, bytes between them are skipped.  A span longer than ``multipliers`` gets a longer table."""
    size = ends - starts
    if size.max() > len(multipliers):
        multipliers = salts(int(size.max()), 11)
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(first, size)
    value = (data if len(at) == len(data) else data[at + np.repeat(starts, size)]).astype(np.uint64)
    value += np.uint64(1)
    value *= multipliers[at]
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: bytes, multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of ``data``."""
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    return span_hashes(np.frombuffer(data, np.uint8), starts, ends, multipliers), starts, ends


def word_multipliers() -> np.ndarray:
    """The table that the hashes take; the beginning of any longer one."""
    return salts(64, 11)


def sequence_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive words; order matters."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    s = mix(h[:m] + np.uint64(n))
    for j in range(1, n):
        s *= np.uint64(0x9E3779B97F4A7C15)
        s += h[j : j + m]
        s = mix(s)
    return s


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; of the whole sequence if it is shorter."""
    return np.unique(sequence_hashes(h, min(n, len(h)))) if len(h) else h
