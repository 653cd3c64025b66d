"""Language identification by prediction by partial matching.

Each language has a variable-order byte context tree whose counts are frozen after training.
A byte's probability comes from the longest context the language has seen; a byte unseen
there pays the escape probability (distinct successors against total, method C) and is
looked up in the next shorter context without the successors already ruled out, down to a
uniform choice among the bytes the language never showed. A text's code length in a language
is the exact sum over all its bytes; the shortest code wins.

With frozen counts a byte's code length depends only on the last ``order`` bytes and itself.
Each task keeps the seen grams of each language as sorted arrays, walks the escapes once for
each distinct gram of its texts and remembers the code lengths in all languages, as many as a
bounded memory holds; at its end the worker gives that memory back. The order is that of the model whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import byte_slices, free_name, quoted, tidy, utf8

SLICE_BYTES = 1 << 19
RANGE_BITS = 16  # hash ranges of a language whose bytes are summed, as a power of two
EVIDENCE = 64  # bytes whose code lengths decide the score of longer texts
MOST_BYTES = 48 << 20  # of code lengths that a worker remembers; while they are merged it needs about three times as many
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Frozen counts: for each language and order, grams (context and byte, big-endian) and counts."""

    name: str
    order: int
    langs: tuple[str, ...]
    grams: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


class Tree:
    """The counts of one language: by order the seen grams, and of their contexts the totals.

    What follows a context also follows the shorter ones, so those ruled out below a context are
    its own successors; ``left`` and ``kinds_left`` are what the next shorter context has without them.
    """

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]]):
        self.grams, self.counts = [g for g, _ in orders], [n for _, n in orders]
        self.contexts, self.totals, self.kinds, self.left, self.kinds_left = [], [], [], [], []
        for k, (grams, n) in enumerate(orders):
            contexts, firsts, kinds = np.unique(grams >> 8, return_index=True, return_counts=True)
            add = lambda x: np.add.reduceat(x, firsts) if len(firsts) else x[:0]  # noqa: B023, E731
            self.contexts.append(contexts)
            self.totals.append(add(n))
            self.kinds.append(kinds)
            if k:
                shorter = self._find(self.grams[k - 1], grams & ((1 << 8 * k) - 1))
                above = self._find(self.contexts[k - 1], contexts & ((1 << 8 * (k - 1)) - 1))
                self.left.append(self.totals[k - 1][above] - add(self.counts[k - 1][shorter]))
                self.kinds_left.append(self.kinds[k - 1][above] - kinds)

    @staticmethod
    def _find(known: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Places of ``codes`` in the sorted ``known``; -1 where missing."""
        if not len(known):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        return np.where(known[at] == codes, at, -1)

    def lengths(self, grams: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram of the highest order; ``known`` bytes of its context exist."""
        out, open_ = np.zeros(len(grams)), np.ones(len(grams), bool)
        longer = np.full(len(grams), -1)
        for k in range(len(self.grams) - 1, -1, -1):
            codes = grams & ((1 << 8 * (k + 1)) - 1)
            context = np.where(known >= k, self._find(self.contexts[k], codes >> 8), -1)
            at = np.flatnonzero(open_ & (context >= 0))
            total, kinds = self.totals[k][context[at]], self.kinds[k][context[at]]
            if k < len(self.grams) - 1:
                below = longer[at]
                some = below >= 0
                total[some], kinds[some] = self.left[k][below[some]], self.kinds_left[k][below[some]]
            gram = self._find(self.grams[k], codes[at])
            hit = gram >= 0
            whole = np.log2(np.maximum(total + kinds, 1))
            out[at[hit]] += whole[hit] - np.log2(self.counts[k][gram[hit]])
            miss = ~hit & (kinds > 0)
            out[at[miss]] += whole[miss] - np.log2(kinds[miss])
            open_[at[hit]] = False
            longer = context
        seen = len(self.grams[0])
        out[open_] += np.log2(max(256 - seen, 1))
        return out


class Table:
    """The context trees of a model, and the code lengths found so far: at most ``most_bytes`` of them."""

    def __init__(self, model: Model, most_bytes: int):
        self.order, self.n_langs = model.order, len(model.langs)
        self.trees = [Tree([model.grams[lang, k] for k in range(model.order + 1)]) for lang in range(self.n_langs)]
        self.most = most_bytes // (8 + 4 * self.n_langs)
        self.codes, self.lengths = np.zeros(0, np.int64), np.zeros((self.n_langs, 0), np.float32)

    def _walk(self, codes: np.ndarray) -> np.ndarray:
        """Code lengths (languages x codes) of distinct grams, nine bits a byte, 256 before the text."""
        grams, known = np.zeros(len(codes), np.int64), np.full(len(codes), self.order)
        for back in range(self.order, -1, -1):
            byte = codes >> 9 * back & 511
            grams = grams << 8 | byte & 255
            known[byte == 256] = back - 1
        out = np.empty((self.n_langs, len(codes)), np.float32)
        for lang, tree in enumerate(self.trees):
            out[lang] = tree.lengths(grams, known)
        return out

    def _lengths(self, codes: np.ndarray) -> np.ndarray:
        """As ``_walk`` for sorted codes, from memory where they are known."""
        at = Tree._find(self.codes, codes)
        new = np.flatnonzero(at < 0)
        out = np.empty((self.n_langs, len(codes)), np.float32)
        out[:, at >= 0] = self.lengths[:, at[at >= 0]]
        out[:, new] = self._walk(codes[new])
        if len(new) and len(self.codes) + len(new) <= self.most:
            merged = np.concatenate([self.codes, codes[new]])
            order = np.argsort(merged, kind="stable")
            self.codes, self.lengths = merged[order], np.concatenate([self.lengths, out[:, new]], axis=1)[:, order]
        elif len(new) and len(codes) <= self.most:  # full: keep what the latest texts need
            self.codes, self.lengths = codes, out
        return out

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        k = self.order
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        # Every text follows k times the mark 256, after which only shorter contexts are known.
        joined = np.full(int(sizes.sum()) + k * len(texts), 256, np.uint16)
        starts = np.cumsum(sizes + k) - sizes
        inside = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        joined[inside] = np.frombuffer(b"".join(texts), np.uint8)
        codes = np.zeros(len(inside), np.int64)
        for back in range(k, -1, -1):
            codes = codes << 9 | joined[inside - back]
        cells, place = np.unique(codes, return_inverse=True)
        lengths = self._lengths(cells)
        out = np.zeros((len(texts), self.n_langs))
        some = np.flatnonzero(sizes)
        if len(some):
            firsts = (np.cumsum(sizes) - sizes)[some]
            for lang in range(self.n_langs):
                out[some, lang] = np.add.reduceat(lengths[lang][place].astype(np.float64), firsts)
        return out


def fit(docs: DataFrame, use: Column, order: int = 3, sample_bytes: int = 1 << 20, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Model:
    """Count the grams of a bounded sample of the labelled rows where ``use`` holds.

    Per language the rows enter in the order of a hash of id and text, whole, until
    ``sample_bytes`` are reached (the last may run over) or all are in; rows without text or language never
    enter. The counts have at most (order + 1) entries a sampled byte, so the model that is
    sent to the workers is bounded whatever the size of the table.
    """
    rows = docs.where(use & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.octet_length(text_col).alias("size"))
    # The hash ranges that reach the sum, one past it at most, then exactly by a running sum over that small part.
    ranges = rows.groupBy("lang", F.shiftright("h", 64 - RANGE_BITS).alias("range")).agg(F.sum("size").alias("size"))
    below = F.coalesce(F.sum("size").over(Window.partitionBy("lang").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    last = ranges.withColumn("below", below).where(F.col("below") < sample_bytes).groupBy("lang").agg(
        F.max("range").alias("last"))
    likely = rows.join(F.broadcast(last), "lang").where(F.shiftright("h", 64 - RANGE_BITS) <= F.col("last"))
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("h", "text").rowsBetween(
        Window.unboundedPreceding, -1))
    sample = likely.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < sample_bytes)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text")), strict=True):
                for lo in range(0, len(text), SLICE_BYTES):
                    for k in range(order + 1):
                        data = np.frombuffer(text, np.uint8)[max(lo - k, 0) : lo + SLICE_BYTES].astype(np.int64)
                        codes = np.zeros(max(len(data) - k, 0), np.int64)
                        for at in range(k + 1):
                            codes = codes << 8 | data[at : len(codes) + at]
                        keys, n = np.unique(codes, return_counts=True)
                        found.append(pd.DataFrame({"lang": lang, "k": k, "gram": keys, "n": n}))
            if found:
                yield pa.RecordBatch.from_pandas(pd.concat(found).astype({"k": "int32"}), preserve_index=False)

    counted = sample.select("lang", "text").mapInArrow(tidy(grams), "lang string, k int, gram long, n long").groupBy(
        "lang", "k", "gram").agg(F.sum("n").alias("n")).orderBy("lang", "k", "gram").toPandas()
    langs = tuple(sorted(counted["lang"].unique()))
    found = {(i, k): (np.zeros(0, np.int64), np.zeros(0, np.int64)) for i in range(len(langs)) for k in range(order + 1)}
    for (lang, k), part in counted.groupby(["lang", "k"]):
        found[langs.index(lang), k] = part["gram"].to_numpy(), part["n"].to_numpy()
    return Model(f"{id(counted)}-{hash(counted['n'].to_numpy().tobytes())}", order, langs, found)


def _judged(known: Model, trees: Table | None, texts: pa.Array) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """(lang_pred, score, bits) of slices of the texts, by a model and its trees."""
    names = np.array([*known.langs, UNKNOWN], object)
    for lo, hi in byte_slices(texts, SLICE_BYTES):
        part = texts.slice(lo, hi - lo)
        strings, data = part.to_pylist(), utf8(part)
        lettered = np.array([bool(known.langs) and any(map(str.isalpha, t or "")) for t in strings], bool)
        bits = trees.bits(data) if trees else np.zeros((len(data), 1))
        best = bits.argmin(1)
        scale = np.minimum(1.0, EVIDENCE / np.maximum([len(d) for d in data], 1))
        share = 1 / np.exp2(-(bits - bits.min(1, keepdims=True)) * scale[:, None]).sum(1)
        yield (pa.array(names[np.where(lettered, best, len(known.langs))], pa.string()),
               pa.array(np.where(lettered, share, 0.0)), pa.array(np.where(lettered, bits.min(1), 0.0)))


def predict(docs: DataFrame, model: Model, most_bytes: int = MOST_BYTES, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (0 to 1), bits (the winning code length).

    ``score`` is the winner's share of the weights 2 ** -(code length), with the lengths of
    texts beyond 64 bytes scaled to that many, so that it stays informative for long ones. A
    text that is null, empty or without a letter is ``und`` with score 0, as is every text
    where the model knows no language. Ties go to the first language by name. Repeated rows
    are judged each; other columns, whatever their names, are not looked at. ``most_bytes``
    bounds what a worker remembers of code lengths, not the order or the result.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {source.schema[0].dataType.simpleString()}, lang_pred string, score double, bits double"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        trees = Table(known, most_bytes) if known.langs else None
        for batch in batches:
            lo = 0
            for columns in _judged(known, trees, batch.column("text")):
                n = len(columns[0])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, n), *columns],
                                                 ["doc_id", "lang_pred", "score", "bits"])
                lo += n

    return source.mapInArrow(tidy(run), schema)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.3, text_col: str = "text",
                    most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows whose language is found with a score of ``least`` or more, with all their columns.

    Texts without a letter, empty and null ones go; repeated rows are judged each; an empty table stays empty.
    Only the text goes to the workers, beside which the row waits with its other columns, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def judge(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        trees = Table(known, most_bytes) if known.langs else None
        for texts in parts:
            found = [pa.StructArray.from_arrays([lang, score], ["lang_pred", "score"])
                     for lang, score, _ in _judged(known, trees, texts)]
            yield pa.concat_arrays(found) if found else pa.array([], pa.struct([("lang_pred", pa.string()), ("score", pa.float64())]))

    @F.arrow_udf(kind)
    def judged(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from tidy(judge)(parts)

    name = free_name(docs.columns, "judged")
    rows = docs.withColumn(name, judged(F.col(quoted(text_col))))
    return rows.where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= least)).drop(name)
