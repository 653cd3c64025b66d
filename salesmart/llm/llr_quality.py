"""Quality rules: log-likelihood ratio of hashed n-grams between a trusted target and the raw corpus.

Words and pairs of adjacent words (the last word pairs with the end) are hashed into
``buckets`` cells. Two multinomials over the cells are counted, one from trusted documents
and one from every document; a text's score is the mean over its features of the log ratio
of their cells' probabilities. Log ratios are kept as whole millionths, so sums are exact in
any order and the threshold decides every document the same way in every run.

Everything is DataFrame expressions. The counts are summed within each task before the
shuffle, which then carries at most ``buckets`` rows a task; texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.session import materialize

BUCKETS = 1 << 16
TRUSTED = 20_000
LEAST_WORDS = 20
WINDOW = 8
UNIT = 1_000_000
SEPARATORS = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"


def _pairs(hashes: Column | str, apart: int) -> Column:
    """Each hash combined with the one ``apart`` places on; with itself where the array ends."""
    return F.transform(hashes, lambda x, i: x.bitwiseXOR(F.shiftleft(F.coalesce(F.get(hashes, i + apart), x), apart)))


def with_words(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``words``, ``h1`` (their hashes) and ``h2`` (hashes of adjacent pairs)."""
    spaced = F.coalesce(F.col(text_col), F.lit(""))
    for c in SEPARATORS[1:]:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    # A single character is split without a regular expression.
    words = F.array_remove(F.split(spaced, " "), "")
    return docs.withColumn("words", words).withColumn("h1", F.transform("words", lambda w: F.xxhash64(w))).withColumn(
        "h2", _pairs("h1", 1))


def _cell(h: Column, buckets: int) -> Column:
    """The low bits of a hash; ``buckets`` is a power of two."""
    return h.bitwiseAND(F.lit(buckets - 1)).cast("int")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int) -> Column:
    """ln(P target / P raw) of every cell in millionths, as a constant array, both with one added to each cell."""
    marked = docs.join(F.broadcast(trusted), "doc_id", "left")
    # explode_outer, because from an explode Catalyst derives a filter on the size of the cells, which it
    # moves below the hashes, where every word would be hashed anew for each of its neighbours.
    cells = with_words(marked, "text").select(
        F.explode_outer(F.concat("h1", "h2")).alias("h"), "trusted").select(
        _cell(F.col("h"), buckets).alias("cell"), "trusted")
    # At most ``buckets`` rows, written once: the totals and the ratios both read them.
    counts = materialize(cells.groupBy("cell").agg(
        F.count("cell").alias("raw"), F.count("trusted").alias("target")), "quality-cells")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("cell")).join(
        counts, "cell", "left").na.fill(0)
    totals = every.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    raws, targets = totals.select("raws").scalar(), totals.select("targets").scalar()
    ratio = F.when(targets == 0, F.lit(0.0)).otherwise(F.log((F.col("target") + 1) * (raws + buckets) / ((F.col("raw") + 1) * (targets + buckets))))
    # ``buckets`` numbers, whatever the size of the corpus, put into the plan as one constant.
    found = every.select("cell", F.round(ratio * UNIT).cast("int").alias("lr")).orderBy("cell").collect()
    return F.split(F.lit(",".join(str(x["lr"]) for x in found)), ",").cast("array<int>")


def with_repeat_places(rows: DataFrame) -> DataFrame:
    """Adds ``places``: where (from 1) windows of eight words start that occur twice or more, in order.

    Hashes of windows only tell texts without any repeat, which is exact; the others are
    decided on the words themselves, sorted so that equal windows are neighbours.
    """
    at = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    named = F.array_sort(F.transform(at, lambda i: F.struct(
        F.array_join(F.slice("words", i, WINDOW), " ").alias("w"), i.alias("i"))))
    nothing = F.array().cast("array<struct<w:string,i:int>>")
    rows = rows.withColumn("named", F.when(
        F.size("windows") == F.size(F.array_distinct("windows")), nothing).otherwise(named))
    same = F.transform("named", lambda x, k: F.when(
        (x["w"] == F.get("named", k - 1)["w"]) | (x["w"] == F.get("named", k + 1)["w"]), x["i"]))
    return rows.withColumn("places", F.array_sort(F.array_compact(same)))


def score(docs: DataFrame, labels: DataFrame, threshold: float = -0.1, buckets: int = BUCKETS,
          trusted_rows: int = TRUSTED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, counts, ``base_failed``, ``llr`` and ``kept``.

    Trusted are documents labelled of quality 1 and not toxic, at most ``trusted_rows`` of
    them in the order of a hash of the id: a bounded list, so it is sent to all tasks. The raw
    counts cover every document. ``llr`` is the mean log ratio (natural) per feature; a
    document is kept if it passes the base rules and llr >= threshold. A null or blank text
    has no words and fails the base rules with llr 0. Null ids are never trusted; repeated
    rows are counted and judged each; without trusted documents all ratios are 0; other columns,
    whatever their names, are not looked at.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col(
        "doc_id").isNotNull()).select("doc_id").distinct()
    trusted = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_rows).withColumn("trusted", F.lit(True))
    ratios = log_ratios(source, trusted, buckets)

    rows = with_words(source, "text")
    windows = F.when(F.size("words") >= WINDOW, F.slice(_pairs("h4", 4), F.lit(1), F.size(
        "words") - (WINDOW - 1))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("h4", _pairs("h2", 2)).withColumn("windows", windows)
    rows = with_repeat_places(rows)
    covered = F.aggregate(
        F.transform("places", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda total, n: total + n)
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SEPARATORS)) != "")
    n = F.size("words").cast("long")
    zero = F.lit(0).cast("long")
    add = lambda total, h: total + F.get(ratios, _cell(h, buckets))
    rows = rows.select(
        "doc_id", n.alias("n_words"),
        F.aggregate("words", zero, lambda total, w: total + F.length(w)).alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), F.aggregate("h2", F.aggregate("h1", zero, add), add).alias("sum"),
        F.monotonically_increasing_id().alias("row"))
    # The row number keeps a caller's filter above the counts; below, they would be hashed anew for each word.
    rows = rows.where(F.col("row") >= 0)
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    limit = round(threshold * UNIT)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        F.coalesce(F.try_divide(F.col("sum") / UNIT, 2 * F.col("n_words")), F.lit(0.0)).alias("llr"),
        (~base & (F.col("sum") >= limit * 2 * F.col("n_words"))).alias("kept"))
