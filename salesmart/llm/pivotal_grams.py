"""Spelling variants: words one edit apart, found through pivotal grams.

Words are runs of letters that occur often enough. Every word has its bigrams in one order, the
rarest among the words first. Its prefix is the three first of them (and what ties with the
third); its pivots are two disjoint bigrams of the prefix, chosen by dynamic programming so that
they are as rare as can be together. One edit harms at most one of two disjoint bigrams, and a
bigram of two words one edit apart moves by at most one place. So of any two such words, the one
whose prefix ends earlier in the order has a pivot that stands unharmed in the other's prefix:
words meet under a bigram that is a pivot of one and in the prefix of the other.

A rare bigram of short words still has very many words. So an entry also names where the edit
may be: the shorter word's places are cut into three parts, and what is outside the part with the
edit is equal in both, counted from the front before it and from the back after it. An entry is
(bigram, length of the shorter word, part, text outside the part), hashed; two words meet where an entry
of one is that of the other, the bigram's places differ by one at most and one word has it as a
pivot. The edit distance is then computed for each pair that met.

A word's form is its near word of largest count, where that is ten times its own or more; the
root is the last word that forms lead to. Counts rise tenfold along forms, so the chains are
short: they are shortened by doubling until no word moves.

Rows with null, empty or letterless text have no words; a null id counts as an empty one in the
checksum. Repeated rows count again. Ties between near words go to the least in code-point order.
Texts are used whole, other columns, whatever their names, not at all. An empty table, or one
without a frequent word, gives no rows. What reaches the driver are the counts of bigrams: the
alphabet has 90 letters, so there are at most 8,100.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import lower_ascii
from salesmart.session import materialize

LEAST_LENGTH, LEAST_COUNT = 7, 2
EVERY, RATIO = 31, 10
PREFIX = 3  # bigrams; three different places always hold two disjoint ones
PARTS = 3


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): the words of all texts that are long enough, with their occurrences.

    A run whose checksum with the document's id is a multiple of ``EVERY`` loses one code point.
    """
    # Runs that are too short can't become long enough; a longer match takes the whole run.
    runs = F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(f"([a-zA-ZÀ-ÿ]{{{least_length},}})"), F.lit(1))
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat_ws(":", "i", "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return found.select(F.when(h % EVERY == 0, cut).otherwise(F.col("run")).alias("word")).where(
        F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def prefix_and_pivots(word: str, counts: dict[str, int]) -> tuple[list[int], list[int]]:
    """(places of the prefix, the two places of the pivots), in the order of the text."""
    grams = [word[i:i + 2] for i in range(len(word) - 1)]
    order = sorted((counts[g], g) for g in grams)
    last = order[min(PREFIX, len(order)) - 1]
    places = [i for i, g in enumerate(grams) if (counts[g], g) <= last]
    # one[k]: the rarest of the places up to the k-th; a second one stands two or more behind it.
    one: list[tuple[int, int]] = []
    best: tuple[int, int, int] | None = None
    k = -1
    for i in places:
        cost = counts[grams[i]]
        one.append(min((cost, i), one[-1]) if one else (cost, i))
        while k + 1 < len(places) and places[k + 1] <= i - 2:
            k += 1
        if k >= 0:
            pair = (cost + one[k][0], one[k][1], i)
            best = pair if best is None else min(best, pair)
    return places, [] if best is None else [best[1], best[2]]


def graded(words: DataFrame, counts: dict[str, int]) -> DataFrame:
    """(word, at, pivot): one row for each place of a word's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, bool]] = []
            for word in batch.column("word").to_pylist():
                places, pivots = prefix_and_pivots(word, counts)
                out += [(word, i, i in pivots) for i in places]
            if out:
                word_, at, pivot = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word_, pa.string()), pa.array(at, pa.int32()), pa.array(pivot, pa.bool_())],
                    ["word", "at", "pivot"])

    return words.mapInArrow(run, "word string, at int, pivot boolean")


def one_edit(a: str, b: str) -> Column:
    """Whether two columns of words differ by exactly one inserted, deleted or replaced code point."""
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a < b: every pair of the words one edit apart, once."""
    grams = words.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))).alias("g"))
    counts = {r["g"]: r["n"] for r in grams.groupBy("g").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    length = F.length("word")
    # As the shorter word (or one of equal length), and as the longer one.
    entry = graded(words, counts).select(
        "word", "at", "pivot", F.explode(F.array(length, length - 1)).alias("shorter"))
    parts = [(F.lit(0), F.floor(F.col("shorter") / 3)), (F.floor(F.col("shorter") / 3), F.floor(F.col("shorter") * 2 / 3)),
             (F.floor(F.col("shorter") * 2 / 3), F.col("shorter"))]
    keys = [F.xxhash64(F.substr("word", F.col("at") + 1, F.lit(2)), "shorter", F.lit(p),
                       F.substr("word", F.lit(1), lo.cast("int")),
                       F.substr("word", (length - F.col("shorter") + hi + 1).cast("int")))
            for p, (lo, hi) in enumerate(parts)]
    entries = entry.select(F.explode(F.array(*keys)).alias("key"), "word", "at", "pivot",
                           (F.col("shorter") < length).alias("longer"))
    a, b = entries.alias("a"), entries.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.word") < F.col("b.word"))
                 & (F.col("a.pivot") | F.col("b.pivot")) & ~(F.col("a.longer") & F.col("b.longer"))
                 & (F.abs(F.col("a.at") - F.col("b.at")) <= 1))
    return met.select(F.col("a.word").alias("a"), F.col("b.word").alias("b")).where(one_edit("a", "b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the rows (word, form): the last word that forms lead to."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moves")), "variant-roots")
        if not moved.where("moves").limit(1).count():
            return now
        now = moved.drop("moves")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = materialize(occurrences(docs, id_col, text_col, least_length).where(F.col("n") >= least_count), "variant-words")
    pairs = materialize(near_pairs(words), "variant-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    found = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                        F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("most"))
    is_form = -F.col("most.rank") >= ratio * F.col("n")
    formed = materialize(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("most.near")).alias("form"), F.when(is_form, -F.col("most.rank")).alias("form_n")), "variant-forms")
    ends = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
