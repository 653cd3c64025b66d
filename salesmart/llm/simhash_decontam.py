"""Benchmark decontamination with SimHash fingerprints of item-sized windows.

A benchmark item of L words is compared with windows of L words of the documents, as
multisets of five-word shingles (shorter items: the whole sequence as one shingle); a
document of fewer words is its own one window. Each window has a 64-bit SimHash. Cut into ``radius`` + 1 blocks, two fingerprints within
``radius`` bits must agree in one block, so joining on (length, block, its bits) finds every
such pair; the pairs are then decided by the exact weighted similarity
sum(min counts) / sum(max counts).

Fingerprints are only taken where a match is possible at all. A window of similarity s holds
at least s times the item's shingles, and those can be located by hash alone: each document
is first tested against a bit table of the benchmark's shingles (two probes, no false
negatives), the hits are joined exactly with the shingles, and the windows around them with
too few are left out. That loses no window the last step would accept.

Everything is DataFrame expressions. Only documents with hits go through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import lower_ascii, quoted, words_of
from salesmart.session import materialize

SHINGLE = 5
SIMILARITY = 0.75
# At similarity 0.75 a bit differs with probability about 0.17: 24 of 64 is over four deviations above the mean.
RADIUS = 24
TABLE_WORDS = 1 << 16  # longs of the bit table at most: 4 million bits
EMPTY = "array<bigint>"


def shingles(hashes: str, length: int) -> Column:
    """Hashes of every run of ``length`` words; none where the text has fewer."""
    runs = F.transform(hashes, lambda x, i: F.xxhash64(x, *(F.get(hashes, i + n) for n in range(1, length))))
    return F.when(F.size(hashes) >= length, F.slice(runs, F.lit(1), F.size(hashes) - (length - 1))).otherwise(
        F.array().cast(EMPTY))


def with_hashes(rows: DataFrame, text_col: str) -> DataFrame:
    return rows.withColumn("h1", F.transform(words_of(lower_ascii(F.col(text_col))), lambda w: F.xxhash64(w)))


def simhash(window: Column) -> Column:
    """The 64 majority bits of an array of hashes; a tie gives 0."""
    half = F.size(window)
    ones = lambda bit: F.aggregate(
        window, F.lit(0), lambda n, h: n + F.call_function("shiftrightunsigned", h, bit).bitwiseAND(F.lit(1)).cast("int"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"),
        lambda acc, bit: acc.bitwiseOR(F.call_function(
            "shiftleft", F.when(2 * ones(bit) > half, F.lit(1)).otherwise(F.lit(0)).cast("long"), bit)))


def _edges(radius: int) -> list[tuple[int, int]]:
    """Lowest bit and mask of the ``radius`` + 1 blocks that 64 bits are cut into."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    return [(lo, (1 << (hi - lo)) - 1) for lo, hi in zip(edges, edges[1:])]


def blocks(fingerprint: Column, radius: int) -> Column:
    """The blocks of a fingerprint, each with its number."""
    return F.array(*(F.struct(F.lit(n).alias("block"), F.shiftrightunsigned(fingerprint, lo).bitwiseAND(
        F.lit(mask)).alias("bits")) for n, (lo, mask) in enumerate(_edges(radius))))


def first_equal(differing: Column, radius: int) -> Column:
    """The first block without a differing bit."""
    return F.coalesce(*(F.when(F.shiftrightunsigned(differing, lo).bitwiseAND(F.lit(mask)) == 0, F.lit(n))
                        for n, (lo, mask) in enumerate(_edges(radius))))


def similarity(a: Column, b: Column) -> Column:
    """Weighted similarity of two arrays of shingle hashes as multisets."""
    counted = F.aggregate(F.array_distinct(a), F.lit(0), lambda n, h: n + F.least(
        F.size(F.filter(a, lambda x: x == h)), F.size(F.filter(b, lambda x: x == h))))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    both = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)
    return F.try_divide(both.cast("double"), F.size(a) + F.size(b) - both)


def _probes(h: Column, bits: int) -> list[tuple[Column, Column]]:
    """Two (word, bit) places of a hash in a table of ``bits`` bits."""
    places = [F.pmod(x, F.lit(bits)) for x in (h, F.shiftrightunsigned(h, 32))]
    return [(F.shiftrightunsigned(p, 6).cast("int"), p.bitwiseAND(F.lit(63)).cast("int")) for p in places]


def _bit_table(known: DataFrame, n: int) -> tuple[Column, int]:
    """The bit table of the distinct hashes ``h`` as one constant, and its size in bits."""
    words = 64
    while words < TABLE_WORDS and words * 64 < 512 * n:
        words *= 2
    places = known.select(F.explode(F.array(*(F.struct(w.alias("word"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), b).alias("bit")) for w, b in _probes(F.col("h"), words * 64)))).alias("p"))
    table = dict(places.groupBy("p.word").agg(F.bit_or("p.bit")).collect())  # at most TABLE_WORDS rows
    return F.split(F.lit(",".join(str(table.get(i, 0)) for i in range(words))), ",").cast(EMPTY), words * 64


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS,
                 broadcast_rows: int = 200_000, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The pairs (doc_id, item_id) where a window of the document is like the item.

    Returns doc_id, item_id, start (first word of the best window, from 0; the first of
    equals), n_words (its length, that of the item or of a document that is shorter) and
    similarity. Words are runs without
    white space, A-Z in lower case. Null or blank texts match nothing; rows with the same id
    are looked at each and give one pair, the best; null ids of documents or items are kept
    as such; empty tables give no pairs; other columns, whatever their names, are not looked at.
    """
    items = with_hashes(benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item_text")),
                        "item_text").where(F.size("h1") > 0)
    k = F.least(F.lit(SHINGLE), F.size("h1"))
    by_length = F.when(F.lit(False), F.array().cast(EMPTY))
    for n in range(1, SHINGLE + 1):
        by_length = by_length.when(k == n, shingles("h1", n))
    items = materialize(
        items.withColumn("item", by_length).select("item_id", F.size("h1").alias("n_words"), k.alias("k"), "item"),
        "benchmark-items")
    known = items.select("k", F.explode("item").alias("h")).distinct()
    per_k = dict(known.groupBy("k").count().collect())  # five rows at most
    # The row number names a row until the hits are written. Being no function of the row, it also keeps
    # Catalyst from moving the test for hits below the shingles, which would hash them anew for each one.
    source = with_hashes(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text").select(
        "doc_id", "h1")
    if not per_k:
        per_k = {SHINGLE: 0}

    hit_docs = None
    for n in sorted(per_k):
        table, bits = _bit_table(known.where(F.col("k") == n).select("h"), per_k[n])
        rows = source.select("doc_id", shingles("h1", n).alias("doc"), F.monotonically_increasing_id().alias("row"))

        def hit(h: Column) -> Column:
            test = F.lit(True)
            for word, bit in _probes(h, bits):
                test = test & (F.call_function("shiftrightunsigned", F.get(table, word), bit).bitwiseAND(F.lit(1)) == 1)
            return test

        found = F.filter(F.transform("doc", lambda h, i: F.struct(h.alias("h"), i.alias("p"), hit(h).alias("hit"))),
                         lambda x: x["hit"])
        rows = rows.select(F.lit(n).alias("k"), "row", "doc_id", "doc", found.alias("found"),
                           F.monotonically_increasing_id().alias("again"))
        rows = rows.where((F.size("found") > 0) & (F.col("again") >= 0)).drop("again")
        hit_docs = rows if hit_docs is None else hit_docs.unionByName(rows)
    hit_docs = materialize(hit_docs, "benchmark-hits")

    # Shingles go to all tasks while they are few; beyond, the join shuffles the hits.
    places = items.select("item_id", "n_words", "k", F.size("item").alias("n_item"), F.explode("item").alias("h"))
    small = sum(per_k.values()) <= broadcast_rows
    hits = hit_docs.select("row", "k", F.explode("found").alias("x")).select(
        "row", "k", F.col("x.h").alias("h"), F.col("x.p").alias("p"))
    lengths = places.groupBy("k", "h", "n_words").agg(F.min("n_item").alias("n_item"))
    near = hits.join(F.broadcast(lengths) if small else lengths, ["k", "h"]).groupBy("row", "k", "n_words").agg(
        F.min("n_item").alias("n_item"), F.array_sort(F.collect_list("p")).alias("ps"))
    # A window starting at s covers shingles s .. s + n - 1; it starts at most n - 1 before its first hit.
    span = F.col("n_words") - F.col("k")
    starts = F.array_distinct(F.flatten(F.transform("ps", lambda p: F.sequence(F.greatest(p - span, F.lit(0)), p))))
    enough = F.filter(starts, lambda s: F.size(F.filter("ps", lambda p: (p >= s) & (p <= s + span)))
                      >= F.ceil(F.lit(least) * F.col("n_item")))
    windows = near.select("row", "k", "n_words", F.explode_outer(enough).alias("start")).where(
        F.col("start").isNotNull())
    # A document shorter than the item is one window; the window ends with the document only there.
    shingles_of = F.least(F.size("doc"), F.col("n_words") - F.col("k") + 1)
    windows = windows.join(hit_docs.select("row", "k", "doc_id", "doc"), ["row", "k"]).where(
        F.col("start") + shingles_of <= F.size("doc")).select(
        "doc_id", "k", "n_words", "start", F.slice("doc", F.col("start") + 1, shingles_of).alias("window"))
    prints = materialize(windows.withColumn("fingerprint", simhash(F.col("window"))), "benchmark-windows")

    item_prints = items.withColumn("item_print", simhash(F.col("item")))
    left = prints.withColumn("b", F.explode(blocks(F.col("fingerprint"), radius)))
    right = item_prints.withColumn("b", F.explode(blocks(F.col("item_print"), radius)))
    differing = F.col("fingerprint").bitwiseXOR(F.col("item_print"))
    # A pair that agrees in several blocks is taken at the first of them.
    pairs = left.join(F.broadcast(right) if small else right, ["k", "n_words", "b"]).where(
        (F.bit_count(differing) <= radius) & (F.col("b.block") == first_equal(differing, radius)))
    checked = pairs.withColumn("similarity", similarity(F.col("window"), F.col("item"))).where(
        F.col("similarity") >= least)
    own_words = F.size("window") + F.col("k") - 1
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), own_words.alias("n_words"))).alias("best")
    return checked.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.s")).alias("start"), F.col("best.n_words").alias("n_words"),
        F.col("best.similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          broadcast_rows: int = 200_000, **options) -> DataFrame:
    """The documents without a contaminated window, with all their columns.

    Rows with a null id stay unless some row with a null id is contaminated.
    """
    bad = materialize(contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **options).select(
        "doc_id").distinct(), "benchmark-bad")
    few = bad.count() <= broadcast_rows  # 8 bytes each; beyond, the texts are shuffled
    return docs.alias("d").join((F.broadcast(bad) if few else bad).alias("b"),
                                F.col(f"d.{quoted(id_col)}").eqNullSafe(F.col("b.doc_id")), "left_anti")
