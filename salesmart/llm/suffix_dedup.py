"""Substring removal by bytes with a blockwise suffix array over a difference cover.

Within a bin (see ``repeats``) the suffixes that start a window are sorted bucket by bucket,
so memory holds one bucket's keys and not all of them. A bucket is sorted by the first 32
bytes; longer ties are resolved without reading on: the positions whose remainder modulo 31
is in a difference cover of six numbers are ranked beforehand, any two positions have a
common shift below 31 that brings both into the cover, and their ranks there decide.
Neighbours that agree in 50 bytes form a class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.repeats import Block, covered_by_earlier, spans_of
from salesmart.llm.wordhash import BYTE_HASHES

PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # every difference modulo 31 occurs once among these
BUCKET = 1 << 18


def shifts() -> np.ndarray:
    """For two remainders, the shift that brings both into the cover."""
    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True
    at = np.arange(PERIOD)
    both = inside[(at[:, None, None] + at) % PERIOD] & inside[(at[None, :, None] + at) % PERIOD]
    return both.argmax(2)


SHIFT = shifts()


def regroup(rank: np.ndarray, active: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Splits groups by ``keys`` of their active members; returns these in their new order.

    ``rank`` holds for each suffix the place where its group starts; all members of a group
    are active or none.
    """
    order = np.lexsort((keys, rank[active]))
    active, keys = active[order], keys[order]
    old = rank[active]
    starts = np.concatenate([[True], old[1:] != old[:-1]])
    parts = starts | np.concatenate([[True], keys[1:] != keys[:-1]])
    at = np.arange(len(active))
    rank[active] = old + np.maximum.accumulate(np.where(parts, at, 0)) - np.maximum.accumulate(np.where(starts, at, 0))
    return active


def tied(rank: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)


def rank_by(n: int, words: Iterable[np.ndarray]) -> np.ndarray:
    """Group starts of n suffixes by a sequence of keys; later keys only look at what is tied."""
    rank = np.zeros(n, np.int64)
    for key in words:
        active = tied(rank)
        if not len(active):
            break
        regroup(rank, active, key[active])
    return rank


class ByteMatcher:
    """Windows of ``window`` bytes."""

    gram = 24

    def __init__(self, window: int = 50):
        if window < 40:
            raise ValueError("the index takes windows of at least 40 bytes")
        self.window = window

    def symbols(self, texts: list[bytes]) -> tuple:
        joined = b"".join(texts)
        at = np.arange(len(joined) + 1, dtype=np.int32)
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        return joined, at[:-1], at[1:], BYTE_HASHES[np.frombuffer(joined, np.uint8)], counts

    def least(self, segments: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        windows = sizes - (self.window - 1)
        joined = b"".join(segments) + bytes(self.window + PERIOD + 8)
        word = np.ndarray(len(joined) - 7, ">u8", joined, strides=(1,))
        firsts = np.cumsum(sizes) - sizes
        start = np.arange(int(windows.sum())) + np.repeat(firsts - (np.cumsum(windows) - windows), windows)
        owner = np.repeat(docs, windows)
        out = owner.copy()
        # Words that cover a whole window, the last one reaching back.
        steps = [*range(0, self.window - 7, 8), self.window - 8]
        cover = self._cover_ranks(int(sizes.sum()), word, steps)
        prefix = word[start] >> np.uint64(48)
        order = np.argsort(prefix.astype(np.uint16), kind="stable")
        ends = np.cumsum(np.bincount(prefix.astype(np.int64), minlength=1 << 16))
        lo = 0
        while lo < len(order):
            hi = int(ends[max(np.searchsorted(ends, lo + BUCKET, "right") - 1, 0)])
            if hi <= lo:  # one prefix alone is larger than a bucket
                hi = int(ends[np.searchsorted(ends, lo, "right")])
            bucket = order[lo:hi]
            lo = hi
            self._bucket(bucket, start[bucket], word, cover, steps, owner, out)
        return np.split(out, np.cumsum(windows)[:-1])

    def _cover_ranks(self, n: int, word: np.ndarray, steps: list[int]) -> np.ndarray:
        inside = np.zeros(PERIOD, bool)
        inside[list(COVER)] = True
        places = np.flatnonzero(np.resize(inside, n + PERIOD))
        places = places[places < len(word) - self.window]
        ranks = np.zeros(n + 2 * PERIOD, np.int64)
        ranks[places] = rank_by(len(places), (word[places + s].astype(np.uint64) for s in steps))
        return ranks

    def _bucket(self, which: np.ndarray, start: np.ndarray, word: np.ndarray, cover: np.ndarray, steps: list[int],
                owner: np.ndarray, out: np.ndarray) -> None:
        rank = rank_by(len(start), (word[start + s].astype(np.uint64) for s in (0, 8, 16, 24)))
        open_ = tied(rank)
        if not len(open_):
            return
        every, whole = open_, rank.copy()
        while len(open_):
            groups, pivot = np.unique(rank[open_], return_index=True)
            against = start[open_[pivot]][np.searchsorted(groups, rank[open_])]
            mine = start[open_]
            shift = SHIFT[mine % PERIOD, against % PERIOD]
            sign = np.sign(cover[mine + shift] - cover[against + shift])
            settled = np.zeros(len(start), bool)
            settled[open_] = sign == 0
            open_ = regroup(rank, open_, sign)
            left = ~settled[open_]
            sizes = np.bincount(rank[open_], minlength=len(start))
            open_ = open_[left & (sizes[rank[open_]] > 1)]
        # In suffix order, neighbours with the same window are one class.
        order = every[np.argsort(rank[every], kind="stable")]
        same = whole[order[1:]] == whole[order[:-1]]
        for s in steps:
            if s + 8 > 32:
                key = word[start[order] + s]
                same &= key[1:] == key[:-1]
        begins = np.flatnonzero(np.concatenate([[True], ~same]))
        found = np.minimum.reduceat(owner[which[order]], begins)
        out[which[order]] = np.repeat(found, np.diff(np.append(begins, len(order))))


def remove_repeated_bytes(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, spans, kept_text, kept_sha256.

    Removed is every byte covered by a string of ``window`` bytes that also starts in a
    document with a smaller id; strings are judged on the input. ``spans`` are the maximal
    removed stretches [begin, end) in bytes, ``kept_text`` the remaining bytes (binary, since
    a cut may fall inside a character). Null texts count as empty. A row without an id is
    kept whole and removes nothing elsewhere; rows with the same id do not affect each other;
    other columns, whatever their names, are not looked at. Ids are whole numbers.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def finish(block: Block, covered: np.ndarray) -> dict:
        spans = spans_of(covered, block.counts)
        kept = []
        for text, cut in zip(block.texts, spans, strict=True):
            edges = [0, *(x for span in cut for x in span), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2])))
        return {
            "n_bytes": pa.array(block.counts, pa.int64()),
            "n_removed": pa.array([sum(b - a for a, b in cut) for cut in spans], pa.int64()),
            "n_spans": pa.array([len(cut) for cut in spans], pa.int64()),
            "spans": pa.array([[{"begin": a, "end": b} for a, b in cut] for cut in spans],
                              pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            "kept_text": pa.array(kept, pa.binary()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}

    return covered_by_earlier(
        source, ByteMatcher(window), finish, "n_bytes long, n_removed long, n_spans long, "
        "spans array<struct<begin:long,end:long>>, kept_text binary, kept_sha256 string")
