"""BPE encoding and decoding with a contiguous rank array.

A word is a list of parts with the rank of every adjacent pair held beside it. The lowest
rank is found by scanning, its boundary is deleted and the two neighbouring ranks are looked
up again, until no pair has a rank. Words beyond ``LONG_WORD`` parts, for which rescanning
would be quadratic, take the same merges from a heap over linked parts. Many words are worked
side by side in arrays: each step merges the lowest-ranked pair of every word that has one.

The vocabulary file is read as it stands: byte-level parts, an end-of-word mark on the last
part, canonical composition, lower case per character, special strings matched in the raw
text. Pieces between ASCII white space never influence one another under this scheme, nor do
the words of a piece, so a Python worker remembers the ids of pieces and words it has met; at a task's end it gives all other memory back.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import byte_slices, tidy, utf8

LONG_WORD = 200
REMEMBERED_BYTES = 48 << 20  # of pieces and words with their ids, in a worker at most
SLICE_BYTES = 1 << 20
NEVER = 1 << 60
_LOADED: dict[str, "Bpe"] = {}


# White space of the vocabulary's patterns: the code points with that Unicode property.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


@dataclass(frozen=True)
class Characters:
    """What the library takes for letters and numbers (ranges of a character class), and its lower case where Python's differs."""

    letters: str
    numbers: str
    lower: dict[int, str]


@cache
def characters() -> Characters:
    """Read off the library, whose Unicode tables may be of another version than Python's; once, on the driver."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]

    def ranges(kind: str) -> str:
        runs = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}+"), "removed", invert=True).pre_tokenize_str("".join(every))
        return "".join(f"\\U{ord(run[0]):08x}-\\U{ord(run[-1]):08x}" for run, _ in runs)

    lowered = normalizers.Lowercase().normalize_str("\n".join(every)).split("\n")
    # The line end itself gives two empty pieces in place of one.
    plain = [c for c in every if c != "\n"]
    lowered = [x for x in lowered if x]
    return Characters(ranges("L"), ranges("N"), {ord(c): x for c, x in zip(plain, lowered, strict=True) if x != c.lower()})


def word_pattern(known: Characters) -> re.Pattern:
    """The words of a text: contractions, runs of letters, single numbers, runs of anything else; and line ends."""
    letters, numbers = known.letters, known.numbers
    return re.compile(f"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{SPACES}{letters}{numbers}]+|\n")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: printable Latin-1 stands for itself, the rest move up from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return out


class Memory:
    """The ids of keys met lately, of about ``most`` bytes: half of it new, half from before; what is met again is new."""

    def __init__(self, most: int):
        self.most, self.held = most // 2, 0
        self.new: dict[str | bytes, bytes] = {}
        self.old: dict[str | bytes, bytes] = {}

    def find(self, keys: set) -> tuple[dict, list]:
        """What is known of the keys, and those that are not known."""
        new, old, found, again, fresh = self.new, self.old, {}, {}, []
        for key in keys:
            got = new.get(key)
            if got is None:
                got = old.get(key)
                if got is None:
                    fresh.append(key)
                    continue
                again[key] = got
            found[key] = got
        self.keep(again)
        return found, fresh

    def keep(self, found: dict) -> None:
        # A character takes up to four bytes; 200 is what the objects take.
        size = 4 * sum(map(len, found)) + sum(map(len, found.values())) + 200 * len(found)
        if self.held + size > self.most:
            self.new, self.old, self.held = {}, self.new, 0
        self.new.update(found)
        self.held += size


class Bpe:
    """A vocabulary file's encoder and decoder."""

    def __init__(self, path: str, known: Characters):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for r, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.rank.setdefault((self.ids[a], self.ids[b]), r)
            self.merged.append(self.ids[a + b])
        letters = byte_letters()
        self.inner = [self.ids[letters[b]] for b in range(256)]
        self.last = [self.ids[letters[b] + self.end] for b in range(256)]
        self.cut = word_pattern(known)
        self.lowered = known.lower
        # Besides these, Python looks around a capital sigma; any other character is lowered by itself.
        self.odd = re.compile("[\u03a3" + "".join(map(re.escape, map(chr, known.lower))) + "]")
        pairs = np.array(list(self.rank), np.int64).reshape(-1, 2)
        keys, ranks = pairs[:, 0] << 32 | pairs[:, 1], np.array(list(self.rank.values()), np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = np.append(keys[order], NEVER), np.append(ranks[order], NEVER)
        self.merged_ids = np.array([*self.merged, 0], np.int64)
        specials = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.found = re.compile(f"({specials})") if specials else None
        self.pieces, self.words = Memory(REMEMBERED_BYTES // 2), Memory(REMEMBERED_BYTES // 2)

    def word(self, data: bytes) -> list[int]:
        """The ids of one word's bytes."""
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        if len(parts) > LONG_WORD:
            return self._long(parts)
        rank = self.rank
        ranks = [rank.get(pair, NEVER) for pair in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            at = ranks.index(low)
            parts[at] = self.merged[low]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank.get((parts[at - 1], parts[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank.get((parts[at], parts[at + 1]), NEVER)
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(self.rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            low, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or self.rank.get((parts[i], parts[j])) != low:
                continue
            parts[i], alive[j], after[i] = self.merged[low], False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := self.rank.get((parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := self.rank.get((parts[before[i]], parts[i]))) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [p for p, a in zip(parts, alive, strict=True) if a]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def _side_by_side(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``word`` of each of these words, one after another, and how many ids each has; none is empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes)
        parts = np.array(self.inner, np.int64)[data]
        parts[ends - 1] = np.array(self.last, np.int64)[data[ends - 1]]
        ranks = np.append(self._ranks(parts[:-1], parts[1:]), NEVER)
        ranks[ends - 1] = NEVER
        which, done = np.arange(len(words)), []
        while len(which):
            ends = np.cumsum(sizes)
            low = np.minimum.reduceat(ranks, ends - sizes)
            if (ready := low == NEVER).any():
                of_ready = np.repeat(ready, sizes)
                done.append((np.repeat(which[ready], sizes[ready]), parts[of_ready]))
                parts, ranks = parts[~of_ready], ranks[~of_ready]
                which, sizes, low = which[~ready], sizes[~ready], low[~ready]
                if not len(which):
                    break
            own = np.repeat(np.arange(len(which)), sizes)
            at = np.flatnonzero(ranks == low[own])
            at = at[np.concatenate([[True], own[at[1:]] != own[at[:-1]]])]  # the first of each word
            parts[at] = self.merged_ids[low]
            keep = np.ones(len(parts), bool)
            keep[at + 1] = False
            parts, ranks, own = parts[keep], ranks[keep], own[keep]
            at, sizes = at - np.arange(len(at)), sizes - 1
            ends = np.cumsum(sizes)
            inner = at < ends - 1
            ranks[at[~inner]] = NEVER
            ranks[at[inner]] = self._ranks(parts[at[inner]], parts[at[inner] + 1])
            after = at[at > ends - sizes]
            ranks[after - 1] = self._ranks(parts[after - 1], parts[after])
        own, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        return ids[np.argsort(own, kind="stable")], np.bincount(own, minlength=len(words))

    def _words(self, words: set[str]) -> dict[str, bytes]:
        found, fresh = self.words.find(words)
        if not fresh:
            return found
        keys = [w.encode() for w in fresh]
        done = {w: np.array(self.word(k), "<u4").tobytes() for w, k in zip(fresh, keys) if len(k) > LONG_WORD}
        if len(done) < len(fresh):
            short = [w for w in fresh if w not in done]
            ids, sizes = self._side_by_side([k for k in keys if len(k) <= LONG_WORD])
            data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
            done.update(zip(short, [data[lo:hi] for lo, hi in zip([0, *ends], ends)]))
        self.words.keep(done)
        found.update(done)
        return found

    def _plain(self, parts: list[str]) -> list[bytes]:
        """The ids of strings without white space of the ASCII kind and without special strings."""
        joined = unicodedata.normalize("NFC", "\n".join(parts))  # nothing is composed across a line end
        joined = "".join(map(str.lower, joined.translate(self.lowered))) if self.odd.search(joined) else joined.lower()
        words = self.cut.findall(joined)
        found = self._words({w for w in words if w != "\n"})
        out, lo = [], 0
        for hi in [i for i, w in enumerate(words) if w == "\n"] + [len(words)]:
            out.append(found[words[lo]] if hi == lo + 1 else b"".join([found[w] for w in words[lo:hi]]))
            lo = hi + 1
        return out

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        if not self.found or not self.found.search("\n".join(pieces)):
            return self._plain(pieces)
        parts = [self.found.split(p) for p in pieces]
        plain = iter(self._plain([x for p in parts for x in p if x not in self.special]))
        return [b"".join([self.special[x].to_bytes(4, "little") if x in self.special else next(plain) for x in p]) for p in parts]

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids as little-endian unsigned 32-bit integers, and their decoded text."""
        return self.encode_all([text.encode()])[0]

    def encode_all(self, texts: list[bytes]) -> list[tuple[bytes, str]]:
        """``encode`` of each text, given in UTF-8."""
        cut = [t.split() for t in texts]  # bytes are cut at ASCII white space only
        known, fresh = self.pieces.find(set().union(*cut))
        if fresh:
            more = dict(zip(fresh, self._pieces(b"\n".join(fresh).decode().split("\n")), strict=True))
            self.pieces.keep(more)
            known.update(more)
        found = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        return [(ids, self.decode(np.frombuffer(ids, "<u4").tolist())) for ids in found]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: the file names no decoder, so token strings are joined by spaces."""
        return " ".join(map(self.names.__getitem__, ids))


def load(path: str, known: Characters | None = None) -> Bpe:
    if path not in _LOADED:
        _LOADED[path] = Bpe(path, known or characters())
    return _LOADED[path]


_COLUMNS = {
    "ids": ("array<int>", pa.list_(pa.int32()), lambda b, t: np.frombuffer(b, "<i4")),
    "decoded": ("string", pa.string(), lambda b, t: t),
    "n_tokens": ("long", pa.int64(), lambda b, t: len(b) // 4),
    "ids_sha256": ("string", pa.string(), lambda b, t: hashlib.sha256(b).hexdigest()),
    "decoded_sha256": ("string", pa.string(), lambda b, t: hashlib.sha256(t.encode()).hexdigest()),
}


def encode(docs: DataFrame, path: str, outputs: Sequence[str] = ("ids", "n_tokens"), id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and the asked ``outputs`` of encoding and decoding its text.

    Outputs: ``ids``, ``n_tokens``, ``decoded`` and the digests ``ids_sha256`` (ids as
    little-endian unsigned 32-bit integers) and ``decoded_sha256``. A null or empty text has
    no ids and decodes to the empty text; a null id stays null; repeated rows are encoded
    each; other columns are ignored; an empty table gives no rows.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = ", ".join([f"doc_id {source.schema['doc_id'].dataType.simpleString()}",
                        *(f"{c} {_COLUMNS[c][0]}" for c in outputs)])

    known = characters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, known)
        for batch in batches:
            for lo, hi in byte_slices(batch.column("text"), SLICE_BYTES):
                done = bpe.encode_all(utf8(batch.column("text").slice(lo, hi - lo)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo),
                     *(pa.array([_COLUMNS[c][2](*d) for d in done], _COLUMNS[c][1]) for c in outputs)],
                    ["doc_id", *outputs])

    return source.mapInArrow(tidy(run), schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: doc_id and the text its ids decode to (null ids: the empty text)."""
    source = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, decoded string"

    known = characters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, known)
        for batch in batches:
            texts = [bpe.decode(x or ()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "decoded"])

    return source.mapInArrow(tidy(run), schema)
