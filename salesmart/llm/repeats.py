"""Finding windows of a document that an earlier document holds too, at the size of a corpus.

Common ground of the two substring operators; what differs is the symbol (byte or word) and
the index that compares windows, given as a ``Matcher``. The documents are dealt into blocks
of bounded bytes by a hash; the blocks exchange compact messages with bins:

1. every window has a seed, the least hash among its k-grams. Equal windows have equal
   seeds. A block sends each bin the seeds that belong there; the bin answers which of them
   occur in more than one document, and which were sent by many blocks (two bits a seed).
2. only windows with such a seed can be repeated. At the edges of a passage that many documents
   share, the seed is the passage's but the window holds words of its own document. So the
   windows of seeds of many blocks are asked for once more, in the same way, by a hash of the
   whole window, and those that no other document has are dropped. Adjacent remaining ones with
   the same seed form a segment; a block sends the segments of a bin, each distinct text once, with the documents
   and places it occurs at.
3. the bin builds its index over its distinct segments, finds for every window the least
   document that holds it, and answers with the covered stretches.
4. the block joins the stretches.

The filters drop nothing that is repeated, and the last decision compares the symbols
themselves. A seed's segments are sent once per block however often they occur, so a passage
that a third of all documents share costs its bin one segment a block, and none for an edge
that only one document has.

All steps form one plan over one exchange of the texts, which Spark reuses; nothing passes
through the driver but the total size that fixes the number of blocks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import give_back, mix64, utf8
from salesmart.llm.wordhash import BASE, powers

BLOCK_BYTES = 6 << 20
SLICE_SYMBOLS = 1 << 19
MANY_BLOCKS = 32  # that send a seed: beyond, its windows are looked at one by one


class Matcher(Protocol):
    """Symbols of texts and an index over segments of them."""

    window: int
    gram: int

    def symbols(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(joined, starts, ends, hashes, counts): the symbols' places and hashes, and symbols per text."""

    def least(self, segments: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
        """For every window of every segment, the least of ``docs`` (one a segment) whose segment holds it."""


@dataclass
class Runs:
    """Stretches of adjacent windows with one seed: first window, windows, seed and text of each."""

    start: np.ndarray
    windows: np.ndarray
    seed: np.ndarray
    text: np.ndarray


def _winnow(hashes: np.ndarray, counts: np.ndarray, window: int, gram: int) -> Runs:
    """The runs of some texts' windows; a window is named by its first symbol in ``hashes``."""
    n = len(hashes)
    of_text = np.maximum(counts - (window - 1), 0)
    total = int(of_text.sum())
    if not total:
        return Runs(*(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.int64)))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(BASE, n), out=sums[1:])
    seeds = mix64((sums[gram:] - sums[:-gram]) * powers(pow(BASE, -1, 1 << 64), n + 1 - gram))
    grams, width = window - gram + 1, 1
    while width * 2 <= grams:
        seeds = np.minimum(seeds[:-width], seeds[width:])
        width *= 2
    if grams > width:
        seeds = np.minimum(seeds[: -(grams - width)], seeds[grams - width :])
    firsts = np.cumsum(counts) - counts
    at = np.arange(total) + np.repeat(firsts - (np.cumsum(of_text) - of_text), of_text)
    text = np.repeat(np.arange(len(counts)), of_text)
    seeds = seeds[at]
    new = np.flatnonzero(np.concatenate([[True], (seeds[1:] != seeds[:-1]) | (text[1:] != text[:-1])]))
    return Runs(at[new], np.diff(np.append(new, total)), seeds[new], text[new])


class Block:
    """The texts of one block in a fixed order, their symbols and runs."""

    def __init__(self, rows: pa.Table, matcher: Matcher, bins: int):
        self.matcher, self.bins = matcher, bins
        rows = rows.append_column("size", pc.binary_length(rows.column("text")))
        self.rows = rows.sort_by([("doc_id", "ascending"), ("size", "ascending"), ("text", "ascending")])
        self.texts = utf8(self.rows.column("text"))
        ids = self.rows.column("doc_id")
        self.known = np.array([x is not None for x in ids.to_pylist()], bool)
        self.ids = pc.fill_null(ids, 0).to_numpy()
        self.joined, self.starts, self.ends, self.hashes, self.counts = matcher.symbols(self.texts)

    def runs(self) -> Runs:
        """Runs of the texts that have an id, worked in slices of bounded size."""
        found, first, text = [], 0, 0
        counts = self.counts
        ends = np.cumsum(counts)
        while text < len(counts):
            to = max(text + 1, int(np.searchsorted(ends, first + SLICE_SYMBOLS, "right")))
            part = _winnow(self.hashes[first : ends[to - 1]], counts[text:to], self.matcher.window, self.matcher.gram)
            part.start += first
            part.text += text
            found.append(part)
            first, text = int(ends[to - 1]), to
        if not found:
            found = [_winnow(self.hashes[:0], counts[:0], self.matcher.window, self.matcher.gram)]
        out = Runs(*(np.concatenate([getattr(p, name) for p in found]) for name in ("start", "windows", "seed", "text")))
        keep = self.known[out.text]
        return out if keep.all() else Runs(out.start[keep], out.windows[keep], out.seed[keep], out.text[keep])

    def windows(self, runs: Runs) -> Runs:
        """Every window of ``runs`` by itself, with a hash of all its symbols as its seed."""
        n, size = runs.windows, self.matcher.window
        at = np.arange(int(n.sum())) + np.repeat(runs.start - (np.cumsum(n) - n), n)
        whole = np.empty(len(at), np.uint64)
        for first in range(0, len(self.hashes), SLICE_SYMBOLS):
            lo, hi = np.searchsorted(at, [first, first + SLICE_SYMBOLS])
            if lo < hi:
                part, place = self.hashes[first : first + SLICE_SYMBOLS + size - 1], at[lo:hi] - first
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(part * powers(BASE, len(part)), out=sums[1:])
                whole[lo:hi] = mix64((sums[place + size] - sums[place]) * powers(
                    pow(BASE, -1, 1 << 64), len(part) + 1 - size)[place])
        return Runs(at, np.ones(len(at), np.int64), whole, np.repeat(runs.text, n))

    def marked(self, bins: np.ndarray, answers: pa.Table, column: str) -> np.ndarray:
        """The marks of the distinct seeds, in their order, from the bins' answers."""
        bits = dict(zip(answers.column("bin").to_pylist(), _binary(answers.column(column), "u1"), strict=True))
        return np.concatenate([np.zeros(0, bool), *(
            np.unpackbits(bits[b])[: hi - lo].astype(bool) for b, lo, hi in _by_bin(bins))])

    def repeated(self, answers: pa.Table, asked: bool) -> Runs:
        """The windows of the runs whose seed many blocks have; if those were ``asked`` for, all runs that other
        documents may have."""
        runs = self.runs()
        _, bins, _, place = self.seeds(runs)
        own = answers.filter(pc.invert(answers.column("whole")))
        often = self.marked(bins, own, "bits")[place]
        many = self.marked(bins, own, "many")[place] & often
        pick = lambda where: Runs(runs.start[where], runs.windows[where], runs.seed[where], runs.text[where])
        windows = self.windows(pick(many))
        if not asked:
            return windows
        _, bins, _, place = self.seeds(windows)
        held = self.marked(bins, answers.filter(answers.column("whole")), "bits")[place]
        seed = np.repeat(runs.seed[many], runs.windows[many])[held]
        start, text = windows.start[held], windows.text[held]
        new = np.flatnonzero(np.concatenate([[True], (start[1:] != start[:-1] + 1) | (seed[1:] != seed[:-1])
                                             | (text[1:] != text[:-1])])) if len(start) else np.zeros(0, np.int64)
        few = pick(often & ~many)
        parts = Runs(start[new], np.diff(np.append(new, len(start))), seed[new], text[new])
        return Runs(*(np.concatenate([getattr(few, c), getattr(parts, c)]) for c in ("start", "windows", "seed", "text")))

    def seeds(self, runs: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(seeds, bins, several, place): distinct seeds by bin and value, whether in several texts here, and
        the place of each run's seed among them."""
        bins = (mix64(runs.seed + np.uint64(1)) % np.uint64(self.bins)).astype(np.int64)
        order = np.lexsort((runs.text, runs.seed, bins))
        seed, text = runs.seed[order], runs.text[order]
        new = np.concatenate([[True], seed[1:] != seed[:-1]]) if len(seed) else np.zeros(0, bool)
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(seed)) - 1 if len(seed) else firsts
        place = np.empty(len(seed), np.int64)
        place[order] = np.cumsum(new) - 1
        ids = self.ids[text]
        return seed[firsts], bins[order][firsts], ids[firsts] != ids[lasts], place


def _by_bin(bins: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bin, lo, hi) of equal stretches of a sorted array."""
    edges = np.concatenate([[0], np.flatnonzero(bins[1:] != bins[:-1]) + 1, [len(bins)]]) if len(bins) else [0]
    for lo, hi in zip(edges, edges[1:]):
        yield int(bins[lo]), int(lo), int(hi)


def _six_bytes(seeds: np.ndarray) -> bytes:
    """The low 48 bits of seeds. Two that differ above them may pass for repeated, which only sends more segments."""
    return np.ascontiguousarray(seeds.astype("<u8").view("u1").reshape(-1, 8)[:, :6]).tobytes()


def _from_six_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), "u1")
    out[:, :6] = np.frombuffer(data, "u1").reshape(-1, 6)
    return out.view("<u8").ravel()


def _binary(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _answer_seeds(rows: pa.Table) -> pa.Table:
    """Which of the seeds sent to a bin occur in several documents, and which came from many blocks: a bit
    each in the order sent."""
    seeds, several = [_from_six_bytes(x) for x in rows.column("seeds").to_pylist()], _binary(rows.column("several"), "u1")
    values, place, n = np.unique(np.concatenate(seeds), return_inverse=True, return_counts=True)
    repeated = n > 1
    marks = [np.unpackbits(s)[: len(x)].astype(bool) for x, s in zip(seeds, several, strict=True)]
    repeated[place[np.concatenate(marks)]] = True
    ends = np.cumsum([len(x) for x in seeds])[:-1]
    packed = lambda marks: pa.array([np.packbits(p).tobytes() for p in np.split(marks[place], ends)], pa.binary())
    return pa.table({"block": rows.column("block"), "bin": rows.column("bin"), "bits": packed(repeated),
                     "many": packed(n >= MANY_BLOCKS)})


def _answer_segments(rows: pa.Table, matcher: Matcher) -> pa.Table:
    """The stretches that earlier documents cover, for every block that sent segments to this bin."""
    number: dict[bytes, int] = {}
    sent = []
    for texts, sizes, seg, doc, at, text in zip(
            rows.column("texts").to_pylist(), _binary(rows.column("sizes"), "<u4"), _binary(rows.column("seg"), "<u4"),
            _binary(rows.column("doc"), "<i8"), _binary(rows.column("at"), "<u4"), _binary(rows.column("text"), "<u4"),
            strict=True):
        ends, texts = np.cumsum(sizes, dtype=np.int64), zlib.decompress(texts)
        own = np.array([number.setdefault(texts[lo:hi], len(number)) for lo, hi in zip(ends - sizes, ends)], np.int64)
        sent.append((own[seg], doc, at, text))
    docs = np.full(len(number), np.iinfo(np.int64).max)
    for seg, doc, _, _ in sent:
        np.minimum.at(docs, seg, doc)
    least = matcher.least(list(number), docs)
    sizes = np.fromiter(map(len, least), np.int64, len(least))
    firsts, least = np.cumsum(sizes) - sizes, np.concatenate(least)
    answers = []
    for seg, doc, at, text in sent:
        n = sizes[seg]
        before = np.cumsum(n) - n
        inside = np.arange(int(n.sum())) - np.repeat(before, n)
        covered = least[np.repeat(firsts[seg], n) + inside] < np.repeat(doc, n)
        begins = covered & ~(np.concatenate([[False], covered[:-1]]) & (inside > 0))
        ends = covered & ~(np.concatenate([covered[1:], [False]]) & np.concatenate([inside[1:] > 0, [False]]))
        place = np.repeat(at.astype(np.int64), n) + inside
        which = np.repeat(text, n)[begins]
        answers.append(np.stack([which, place[begins], place[ends] + matcher.window]).astype("<u4").tobytes())
    return pa.table({"block": rows.column("block"), "spans": pa.array(answers, pa.binary())})


def _tidy(work: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """The work on one group, after which the worker's free memory goes back: it meets one group after another."""

    # Spark tells the number of arguments from the signature.
    if work.__code__.co_argcount == 1:
        def tidied(rows: pa.Table) -> pa.Table:
            try:
                return work(rows)
            finally:
                give_back()
    else:
        def tidied(rows: pa.Table, answers: pa.Table) -> pa.Table:
            try:
                return work(rows, answers)
            finally:
                give_back()
    return tidied


def covered_by_earlier(docs: DataFrame, matcher: Matcher, finish: Callable[["Block", np.ndarray], dict],
                       schema: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of (doc_id long, text): doc_id, any further columns, and those of ``schema``.

    ``finish`` gets a block and whether each of its symbols is covered, and returns the
    columns in the order of the block's texts. Rows without an id are neither earlier nor
    later than others: nothing of theirs is covered and they cover nothing. Null texts count
    as empty. Rows with the same id do not cover one another.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    carried = [T.StructField("doc_id", T.LongType()), *(docs.schema[c] for c in more)]
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *more).select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"), "doc_id", "text", *more
    ).repartition(blocks, "block")

    def asking(block: Block, number: int, runs: Runs) -> pa.Table:
        seeds, bins, several, _ = block.seeds(runs)
        parts = list(_by_bin(bins))
        return pa.table({
            "bin": pa.array([b for b, _, _ in parts], pa.int32()),
            "block": pa.array([number] * len(parts), pa.int32()),
            "seeds": pa.array([_six_bytes(seeds[lo:hi]) for _, lo, hi in parts], pa.binary()),
            "several": pa.array([np.packbits(several[lo:hi]).tobytes() for _, lo, hi in parts], pa.binary())})

    def send_seeds(rows: pa.Table) -> pa.Table:
        block = Block(rows, matcher, blocks)
        return asking(block, rows.column("block")[0].as_py(), block.runs())

    def send_windows(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(rows, matcher, blocks)
        number = rows.column("block")[0].as_py() if len(rows) else 0
        return asking(block, number, block.repeated(answers, False))

    def send_segments(rows: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["bin", "block", "doc", "at", "text", "seg", "sizes", "texts"]
        out: dict[str, list] = {n: [] for n in names}
        if len(rows):
            block = Block(rows, matcher, blocks)
            runs = block.repeated(answers, True)
            _, bins, _, place = block.seeds(runs)
            chosen = np.argsort(bins[place], kind="stable")
            firsts = np.cumsum(block.counts) - block.counts
            a = runs.start[chosen]
            z = a + runs.windows[chosen] + matcher.window - 2
            lows, highs = block.starts[a], block.ends[z]
            for b, lo, hi in _by_bin(bins[place[chosen]]):
                number: dict[bytes, int] = {}
                seg = [number.setdefault(block.joined[x:y], len(number)) for x, y in zip(
                    lows[lo:hi].tolist(), highs[lo:hi].tolist())]
                text = runs.text[chosen[lo:hi]]
                values = (b, rows.column("block")[0].as_py(), block.ids[text].astype("<i8").tobytes(),
                          (a[lo:hi] - firsts[text]).astype("<u4").tobytes(), text.astype("<u4").tobytes(),
                          np.array(seg, "<u4").tobytes(), np.fromiter(map(len, number), "<u4", len(number)).tobytes(),
                          zlib.compress(b"".join(number), 1))
                for n, value in zip(names, values, strict=True):
                    out[n].append(value)
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
        return pa.table({n: pa.array(out[n], k) for n, k in zip(names, kinds, strict=True)})

    def conclude(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(rows, matcher, blocks)
        edges = np.zeros(len(block.hashes) + 1, np.int64)
        firsts = np.cumsum(block.counts) - block.counts
        for spans in _binary(answers.column("spans"), "<u4"):
            text, begin, end = spans.astype(np.int64).reshape(3, -1)
            np.add.at(edges, firsts[text] + begin, 1)
            np.add.at(edges, firsts[text] + end, -1)
        return pa.table({**{c: block.rows.column(c) for c in ("doc_id", *more)}, **finish(block, np.cumsum(edges)[:-1] > 0)})

    by_block = texts.groupBy("block")
    seeds = by_block.applyInArrow(_tidy(send_seeds), "bin int, block int, seeds binary, several binary")
    marks = "block int, bin int, bits binary, many binary"
    repeated = seeds.groupBy("bin").applyInArrow(_tidy(_answer_seeds), marks).withColumn("whole", F.lit(False))
    windows = by_block.cogroup(repeated.groupBy("block")).applyInArrow(
        _tidy(send_windows), "bin int, block int, seeds binary, several binary")
    held = windows.groupBy("bin").applyInArrow(_tidy(_answer_seeds), marks).withColumn("whole", F.lit(True))
    segments = by_block.cogroup(repeated.unionByName(held).groupBy("block")).applyInArrow(
        _tidy(send_segments),
        "bin int, block int, doc binary, at binary, text binary, seg binary, sizes binary, texts binary")
    spans = segments.groupBy("bin").applyInArrow(
        _tidy(lambda rows: _answer_segments(rows, matcher)), "block int, spans binary")
    result = T.StructType([*carried, *T.StructType.fromDDL(schema).fields])
    return by_block.cogroup(spans.groupBy("block")).applyInArrow(_tidy(conclude), result)


def spans_of(covered: np.ndarray, counts: Sequence[int]) -> list[list[tuple[int, int]]]:
    """Maximal covered stretches [begin, end) of every text, in symbols from its start."""
    out, first = [], 0
    for n in counts:
        part = np.concatenate([[False], covered[first : first + n], [False]])
        edges = np.flatnonzero(part[1:] != part[:-1]).reshape(-1, 2)
        out.append([(int(a), int(b)) for a, b in edges])
        first += n
    return out
