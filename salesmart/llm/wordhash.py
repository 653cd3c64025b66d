"""Hashes of all words of many texts at once.

The bytes of the texts, mapped through a table of random numbers (A-Z to those of a-z where
asked), are summed with the powers of an odd base, modulo 2 ** 64. A word's hash is the
difference of two prefix sums, divided by the power at its start and finally mixed. Equal
words have equal hashes wherever they stand; two different ones agree by chance in about one
pair of 2 ** 64.
"""

from __future__ import annotations

import numpy as np

from salesmart.llm.common import mix64

BASE = 0x9E3779B97F4A7C15 | 1
_RANDOM = np.random.default_rng(20240607)
_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
BYTE_HASHES = _VALUES
_LOWERED = _VALUES.copy()
_LOWERED[65:91] = _VALUES[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}
SLICE_BYTES = 1 << 19  # hashed at once; a longer word stands alone


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next call."""
    have = _powers.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _powers[base] = have
    return have[:n]


def hash_words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, counts): every word with its place in the joined texts, and the words per text.

    The texts are joined by one blank each, and hashed in slices of bounded size.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = _BLANK[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]  # the last byte is blank, so every word ends
    inverse, values = pow(BASE, -1, 1 << 64), _LOWERED if lower else _VALUES
    hashes = np.empty(len(starts), np.uint64)
    word = 0
    while word < len(starts):
        # As many words as end within the slice, one at least.
        first = int(starts[word])
        to = max(word + 1, int(np.searchsorted(ends, first + SLICE_BYTES, "right")))
        part = data[first : ends[to - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * powers(BASE, len(part)), out=sums[1:])
        a, z = starts[word:to] - first, ends[word:to] - first
        hashes[word:to] = mix64((sums[z] - sums[a]) * powers(inverse, len(part))[a])
        word = to
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    counts = np.diff(np.searchsorted(starts, bounds))
    return hashes, starts, ends, counts


def runs(hashes: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): every run of ``length`` adjacent words within a text, and the runs per text."""
    of_text = np.maximum(counts - (length - 1), 0)
    firsts = np.cumsum(counts) - counts
    at = np.arange(int(of_text.sum())) + np.repeat(firsts - (np.cumsum(of_text) - of_text), of_text)
    out = hashes[at]
    for i in range(1, length):
        out = out * np.uint64(BASE) + hashes[at + i]
    return mix64(out + np.uint64(length)), of_text
