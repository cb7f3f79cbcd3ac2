"""Words of texts held as bytes, hashed without a Python object for each.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, lower-cased in
A-Z only, as the contracts of the word operators define it.
"""

from __future__ import annotations

import numpy as np

from .exchange import mix64

BASE = 0x9E3779B97F4A7C15 | 1
CHUNK = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
# letters, digits and all bytes of other scripts make words; everything else parts them
LETTERS_ONLY = np.ones(256, bool)
LETTERS_ONLY[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
# each byte value stands for a fixed odd 64-bit number, so that nearby letters are unrelated
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_FORWARD = _powers(BASE, CHUNK)
_BACK = _powers(pow(BASE, -1, 1 << 64), CHUNK)


def word_spans(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _GAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and for each text the number of its first word (length texts + 1)."""
    gap = gaps[data]
    inside = ~gap
    first = inside.copy()
    if len(data):
        first[1:] &= gap[:-1]
        last = inside.copy()
        last[:-1] &= gap[1:]
        # a text's edge ends a word too
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    else:
        begins = ends = np.zeros(0, np.int64)
    return begins, ends, np.searchsorted(begins, offsets)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each lower-cased word, equal for equal words wherever they stand."""
    out = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        base = begins[at]
        upto = max(at + 1, np.searchsorted(ends, base + CHUNK, side="right"))
        b, e = begins[at:upto] - base, ends[at:upto] - base
        size = int(e[-1])
        forward, back = (_FORWARD, _BACK) if size <= CHUNK else (_powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_LETTER[_LOWER[data[base : base + size]]] * forward[:size], out=sums[1:])
        out[at:upto] = mix64((sums[e] - sums[b]) * back[b] + (e - b).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = upto
    return out


def sequence_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (one fewer than words by size - 1)."""
    count = max(0, len(words) - size + 1)
    out = np.full(count, size, np.uint64)
    for i in range(size):
        out = mix64(out * np.uint64(BASE) + words[i : i + count])
    return out


def shingle_sets(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and the offsets between texts.

    A text with fewer than ``size`` words has its whole sequence as its one
    shingle; a text without words has none.
    """
    texts = len(firsts) - 1
    counts = np.diff(firsts)
    runs = sequence_hashes(words, size)
    starts = np.arange(len(runs))
    owner = np.repeat(np.arange(texts), counts)
    whole = owner[: len(runs)] == owner[size - 1 :] if len(runs) else np.zeros(0, bool)
    values, owners = runs[starts[whole]], owner[: len(runs)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    extra = np.empty(len(short), np.uint64)
    for length in range(1, size):
        own = np.flatnonzero(counts[short] == length)
        h = np.full(len(own), length, np.uint64)
        for i in range(length):
            h = mix64(h * np.uint64(BASE) + words[firsts[short[own]] + i])
        extra[own] = h
    values, owners = np.concatenate([values, extra]), np.concatenate([owners, short])
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[keep], owners[keep]
    return values, np.searchsorted(owners, np.arange(texts + 1))
