"""Substring removal by words with a compressed full-text index per shard.

A bin (see ``repeats``) is a shard: its distinct segments, as numbers of words, are indexed
by the Burrows-Wheeler transform in a wavelet matrix, one bit vector with sampled ranks for
each bit of a word's number. The segments are streamed against it: backward search extends a
window's match word by word to the left, two rank queries a step, for all windows at once.
The length reached while others still match is the window's matching statistic; a window
that reaches the threshold has its interval reported, and the least document of the
interval decides.

The transform sorts by the first sixteen words, which is all that searches of up to sixteen
words need.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import quoted
from salesmart.llm.repeats import Block, covered_by_earlier, spans_of
from salesmart.llm.wordhash import hash_words

DEPTH = 16


class BitRank:
    """Bits packed into words, with the ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(-len(bits) % 64 + 64, bool)), bitorder="little")
        self.words = packed.view("<u8").astype(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & below)


class FmIndex:
    """Counts and places of patterns of up to ``DEPTH`` symbols in a text of numbers below ``size``."""

    def __init__(self, text: np.ndarray, size: int):
        n = len(text)
        rank, width = text.astype(np.int64), 1
        while width < DEPTH:
            ahead = np.zeros(n, np.int64)
            ahead[: max(n - width, 0)] = rank[width:] + 1
            rank = np.unique(rank * (max(n, size) + 2) + ahead, return_inverse=True)[1]
            width *= 2
        suffixes = np.argsort(rank, kind="stable")
        column = text[suffixes - 1]  # the symbol before each suffix; that of the first is the last one
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.levels: list[tuple[int, BitRank]] = []
        for level in reversed(range(max(int(size - 1).bit_length(), 1))):
            bits = (column >> level & 1).astype(bool)
            self.levels.append((level, BitRank(bits)))
            column = np.concatenate([column[~bits], column[bits]])
        every = np.arange(size)
        self.base = self._down(every, np.zeros(size, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in self.levels:
            ones = bits.ones(at)
            at = np.where(symbol >> level & 1, bits.zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + pattern from those of the patterns."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        start = self.first[symbol] - self.base[symbol]
        return both[: len(symbol)] + start, both[len(symbol) :] + start


class WordMatcher:
    """Windows of ``window`` words."""

    gram = 6

    def __init__(self, window: int = 13):
        if not self.gram <= window <= DEPTH:
            raise ValueError(f"the index takes windows of {self.gram} to {DEPTH} words")
        self.window = window

    def symbols(self, texts: list[bytes]) -> tuple:
        plain = [b" ".join(t.split()) for t in texts]
        hashes, starts, ends, counts = hash_words(plain, lower=False)
        return b" ".join(plain) + b" ", starts, ends, hashes, counts

    def least(self, segments: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
        number: dict[bytes, int] = {}
        words = [[number.setdefault(w, len(number) + 1) for w in s.split(b" ")] for s in segments]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text = np.fromiter((w for s in words for w in (*s, 0)), np.int64, int(sizes.sum()) + len(words))
        windows = sizes - (self.window - 1)
        firsts = np.cumsum(sizes + 1) - (sizes + 1)
        start = np.arange(int(windows.sum())) + np.repeat(firsts - (np.cumsum(windows) - windows), windows)
        out = np.repeat(docs, windows)
        owner = out.copy()
        index = FmIndex(text, len(number) + 1)
        live = np.arange(len(start))
        low, high = np.zeros(len(start), np.int64), np.full(len(start), len(text), np.int64)
        for step in reversed(range(self.window)):
            low, high = index.extend(text[start[live] + step], low, high)
            several = high - low > 1  # else only the window itself is left, below the threshold
            live, low, high = live[several], low[several], high[several]
        if len(live):
            order = np.argsort(low, kind="stable")
            begins = np.flatnonzero(np.concatenate([[True], low[order][1:] != low[order][:-1]]))
            found = np.minimum.reduceat(owner[live[order]], begins)
            out[live[order]] = np.repeat(found, np.diff(np.append(begins, len(order))))
        return np.split(out, np.cumsum(windows)[:-1])


def remove_repeated_words(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
                          carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, spans, kept_text, kept_sha256.

    Removed is every word covered by a window of ``window`` consecutive words that also starts
    in a document with a smaller id; windows are judged on the input. ``spans`` are the maximal
    removed stretches [begin, end) in words, ``kept_text`` the kept words joined by one space,
    or the text as it was where nothing is removed; the digest is always of the joined words.
    Null texts count as empty. A row without an id is kept whole and removes nothing
    elsewhere; rows with the same id do not affect each other; other columns, whatever their
    names, are not looked at. Ids are whole numbers. With ``carry`` the rows keep their
    columns but the text too, as the struct ``row``.
    """
    row = [F.struct(*(F.col(quoted(c)).alias(c) for c in docs.columns if c != text_col)).alias("row")] if carry else []
    source = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"), *row)

    def finish(block: Block, covered: np.ndarray) -> dict:
        spans = spans_of(covered, block.counts)
        kept, texts = [], []
        for text, cut in zip(block.texts, spans, strict=True):
            words = text.split()
            for a, b in reversed(cut):
                del words[a:b]
            kept.append(b" ".join(words))
            texts.append((kept[-1] if cut else text).decode())
        return {
            "n_words": pa.array(block.counts, pa.int64()),
            "n_removed": pa.array([sum(b - a for a, b in cut) for cut in spans], pa.int64()),
            "spans": pa.array([[{"begin": a, "end": b} for a, b in cut] for cut in spans],
                              pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            "kept_text": pa.array(texts, pa.string()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}

    return covered_by_earlier(
        source, WordMatcher(window), finish, "n_words long, n_removed long, "
        "spans array<struct<begin:long,end:long>>, kept_text string, kept_sha256 string")
