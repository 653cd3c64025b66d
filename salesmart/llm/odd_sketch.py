"""Near-duplicates: MinHash bands propose pairs, odd sketches estimate them, full sets decide.

A document is its set of five-word shingles (fewer words: the whole sequence). Documents
with the same set are one class, so copies cost one row. A class has ``BANDS * ROWS`` MinHash
samples; the samples are folded into a parity bitmap, the odd sketch, in which a sample
toggles one bit. Samples two classes share cancel in the XOR of their bitmaps, whose
population count d estimates the similarity as 1 + n / (4 k) * ln(1 - 2 d / n).

Links are found in rounds, since only the components of the link graph are asked for:

1. each bucket of a band names one of its members as centre, by a hash of the class; each class
   is checked against the centre that it shares most buckets with;
2. where a bucket still holds classes of different components, its pairs across components are
   looked at, sketch against sketch, within blocks of a bucket of bounded size. These classes
   get sketches of ``SHARP`` samples, so that little but true links is left to check; a pair
   that meets in several bands is looked at in the first. Of all pairs that the estimate does
   not rule out, a spanning forest of the most similar is checked first, which joins what is
   alike with few checks; then every pair that is still between two components.

Every check counts the intersection of the full sets. Pairs within a component need none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.blocks import checked, crossed, in_blocks, runs_of
from salesmart.llm.common import byte_slices, free_name, mix64, quoted, tidy, utf8
from salesmart.llm.wordhash import hash_words, runs
from salesmart.session import materialize

SHINGLE = 5
BANDS, ROWS = 32, 4  # at similarity 0.75 all bands miss with probability 5e-6
SAMPLES = BANDS * ROWS
SHARP = 2048
BITS_PER_SAMPLE = 4
DEVIATIONS = 5  # of the estimate, by which a pair may stay below the threshold
BLOCK = 512
FEW_EDGES = 100_000  # some 5 MB
SLICE_BYTES = 1 << 19
_RANDOM = np.random.default_rng(711)
_FACTORS = _RANDOM.integers(1, 1 << 63, SHARP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, SHARP, dtype=np.uint64)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): the shingles of each text, repeats included, in one array."""
    words, _, _, counts = hash_words(texts, lower=True)
    if not ((counts > 0) & (counts < SHINGLE)).any():
        return runs(words, counts, SHINGLE)
    # Each text is worked at its own shingle length, then all are put back in order.
    length = np.clip(counts, 1, SHINGLE)
    firsts = np.cumsum(counts) - counts
    found: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    for n in range(1, SHINGLE + 1):
        own = np.flatnonzero((length == n) & (counts > 0))
        if not len(own):
            continue
        at = np.concatenate([np.arange(firsts[i], firsts[i] + counts[i]) for i in own])
        hashes, sizes = runs(words[at], counts[own], n)
        for i, part in zip(own, np.split(hashes, np.cumsum(sizes)[:-1]), strict=True):
            found[i] = part
    return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))


def minhash(hashes: np.ndarray, counts: np.ndarray, samples: int) -> np.ndarray:
    """Texts x samples; only texts with shingles."""
    some = counts[counts > 0]
    starts = np.cumsum(some) - some
    out = np.empty((len(some), samples), np.uint64)
    for i in range(samples):
        out[:, i] = np.minimum.reduceat(hashes * _FACTORS[i] + _SHIFTS[i], starts) if len(some) else 0
    return out


def fold(samples: np.ndarray) -> np.ndarray:
    """The odd sketches of rows of MinHash samples, as rows of 64-bit words."""
    size = samples.shape[1] * BITS_PER_SAMPLE
    bits = np.zeros((len(samples), size), bool)
    rows = np.arange(len(samples))
    for i in range(samples.shape[1]):
        bits[rows, (mix64(samples[:, i] + np.uint64(i)) % np.uint64(size)).astype(np.int64)] ^= True
    return np.packbits(bits, axis=1).view("<i8")


def most_different(similarity: float, samples: int) -> int:
    """The population count that a pair of ``similarity`` exceeds by chance of ``DEVIATIONS`` deviations only."""
    low = similarity - DEVIATIONS * 1.1 * (similarity * (1 - similarity) / samples) ** 0.5
    size = samples * BITS_PER_SAMPLE
    return int(size / 2 * (1 - np.exp(4 * samples / size * (low - 1))))


def class_of(shingles: np.ndarray) -> bytes | None:
    """The digest that names a set of shingles (sorted, distinct); none for the empty set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signatures(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, t, text): doc_id, t, n_shingles, class (null without shingles), bands, sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(batch.column("text"), SLICE_BYTES):
                hashes, counts = shingle_sets(utf8(batch.column("text").slice(lo, hi - lo)))
                sizes, classes = [], []
                for part in np.split(hashes, np.cumsum(counts)[:-1]):
                    part = np.unique(part)
                    sizes.append(len(part))
                    classes.append(class_of(part))
                samples = minhash(hashes, counts, SAMPLES)
                sketches = fold(samples)
                bands = np.full((len(samples), BANDS), 0, np.uint64)
                for row in range(ROWS):
                    bands = mix64(bands * np.uint64(31) + samples[:, row::ROWS])
                bands = mix64(bands + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                filled = iter(range(len(samples)))
                at = [next(filled) if n else None for n in counts]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo), batch.column("t").slice(lo, hi - lo),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array([None if i is None else bands[i] for i in at], pa.list_(pa.int64())),
                    pa.array([None if i is None else sketches[i] for i in at], pa.list_(pa.int64()))],
                    ["doc_id", "t", "n_shingles", "class", "bands", "sketch"])

    return docs.mapInArrow(
        tidy(run), f"doc_id {kind}, t long, n_shingles long, class binary, bands array<long>, sketch array<long>")


def of_classes(texts: DataFrame, what: str) -> DataFrame:
    """One row for each class among the rows of (class, text) whose text is of that class.

    ``what`` is ``set``, its distinct shingle hashes, or ``sharp``, its sketch of ``SHARP`` samples. Sets are
    not dealt out for it: a class may have an equal one from each task that meets its text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for lo, hi in byte_slices(batch.column("text"), SLICE_BYTES):
                hashes, counts = shingle_sets(utf8(batch.column("text").slice(lo, hi - lo)))
                wanted = batch.column("class").slice(lo, hi - lo).to_pylist()
                sets = {w: x for w, x in zip(
                    wanted, map(np.unique, np.split(hashes, np.cumsum(counts)[:-1])), strict=True) if w not in seen and class_of(x) == w}
                if len(seen) < 1 << 16:
                    seen.update(sets)
                values = [x.view(np.int64) for x in sets.values()]
                if what == "sharp" and sets:
                    sizes = np.fromiter(map(len, values), np.int64, len(values))
                    values = list(fold(minhash(np.concatenate(list(sets.values())), sizes, SHARP)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sets), pa.binary()), pa.array(values, pa.list_(pa.int64()))], ["class", what])

    found = texts.mapInArrow(tidy(run), f"class binary, {what} array<long>")
    return found if what == "set" else found.dropDuplicates(["class"])


def different(a: str, b: str) -> Column:
    """Population count of the XOR of two sketches."""
    bits = [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SAMPLES * BITS_PER_SAMPLE // 64)]
    return sum(bits[1:], bits[0])


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of the edges (u, v) of one task."""
    root: dict = {}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            root.setdefault(u, u)
            root.setdefault(v, v)
            x, y = find(u), find(v)
            root[max(x, y)] = min(x, y)
    if root:
        nodes = list(root)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([find(x) for x in nodes])], ["node", "root"])


def components(edges: DataFrame, name: str, few: int = FEW_EDGES) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the least node that it reaches.

    Alternates the two star steps: each node hands its larger neighbours, then its smaller
    ones and itself, to its least neighbour, until no edge changes. Grouping is by partial
    minima and joins, so that a node with very many neighbours is no single task. Up to ``few`` edges,
    counted first, are joined up in one task instead; the result is the same.
    """
    spark = edges.sparkSession
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), name)
    if now.count() <= few:
        kind = now.schema["u"].dataType.simpleString()
        return materialize(now.repartition(1).mapInArrow(_joined_up, f"node {kind}, root {kind}"), name)
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where(
            "u <> v").distinct()
        now = materialize(small, name)
        new = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == mark:
            break
        mark = new
    rooted = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()) if mark[
        0] else spark.createDataFrame([], rooted.schema)


def spanning(d: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the edges (x, y) between components make up a forest, the least d first."""
    order = np.lexsort((np.maximum(x, y), np.minimum(x, y), d))
    _, first = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)])[:, order], axis=1, return_index=True)
    root: dict[int, int] = {}

    def find(a: int) -> int:
        while root.get(a, a) != a:
            root[a] = a = root.get(root[a], root[a])
        return a

    kept = []
    for at in order[np.sort(first)].tolist():
        a, b = find(int(x[at])), find(int(y[at]))
        if a != b:
            root[a] = b
            kept.append(at)
    return np.array(kept, np.int64)


def across(members: DataFrame, most: int, forest: bool) -> DataFrame:
    """Pairs (a, b) of one bucket, of different components, whose sketches differ in at most ``most`` bits.

    Members are (h, class, root, bands, sharp). No task holds a bucket (see ``blocks``), and pairs within its largest
    component are not looked at. With ``forest`` a pair of blocks only gives a spanning forest of its pairs.
    """
    dealt = in_blocks(members.withColumn("who", F.col("class")), BLOCK)

    def pairs(rows: pa.Table) -> tuple[list, list]:
        names = rows.column("class").to_pylist()
        _, roots = np.unique(np.array([x.hex() for x in rows.column("root").to_pylist()]), return_inverse=True)
        sides = rows.column("side").to_numpy() if crossed(rows) else np.arange(len(names))
        sketch = pc.list_flatten(rows.column("sharp")).to_numpy().reshape(len(names), -1).view(np.uint64)
        bands = pc.list_flatten(rows.column("bands")).to_numpy().reshape(len(names), -1)
        here = (bands[0] == rows.column("h")[0].as_py()).argmax()
        found = [np.zeros((3, 0), np.int64)]
        for at in range(len(names)):
            rest = np.arange(at + 1, len(names))
            rest = rest[(roots[rest] != roots[at]) & (sides[rest] != sides[at])]
            rest = rest[(bands[rest] == bands[at]).argmax(1) == here]
            d = np.bitwise_count(sketch[rest] ^ sketch[at]).sum(1, dtype=np.int64)
            near = d <= most
            found.append(np.stack([d[near], np.full(int(near.sum()), at), rest[near]]))
        d, x, y = np.concatenate(found, axis=1)
        if forest and len(d):
            kept = spanning(d, roots[x], roots[y])
            x, y = x[kept], y[kept]
        return [names[a] for a in x], [names[b] for b in y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, ["h", "i", "j"]):
            left, right = pairs(rows)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["x", "y"])

    found = dealt.mapInArrow(tidy(run), "x binary, y binary")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text",
                    text_hash: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * intersection >= ``percent`` * union of their shingle sets;
    component_id is the least doc_id that links reach. Only the row or rows of that id are
    kept. Null, empty and blank texts have no shingles, link with nothing and are kept. A
    null id is less than none: its row joins the component of its text, and is kept only
    where every id of it is null. Rows with the same id and text share all results; other
    columns, whatever their names, are not looked at. ``text_hash`` adds ``t``, xxhash64 of the text.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    rows = materialize(signatures(source), "near-signatures")
    classes = materialize(rows.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("doc_id").alias("first"), F.max("n_shingles").alias("size"), F.max("bands").alias("bands"),
        F.max("sketch").alias("sketch")), "near-classes")
    banded = classes.select("class", F.explode("bands").alias("h"))
    centres = banded.groupBy("h").agg(
        F.count(F.lit(1)).alias("m"), F.min(F.struct(F.xxhash64("class").alias("x"), F.col("class"))).alias("c")
    ).where("m > 1").select("h", "m", F.col("c.class").alias("centre"))
    buckets = materialize(banded.join(centres, "h"), "near-buckets")  # only buckets of two and more

    # One centre for each class: that of most of its buckets.
    shared = buckets.where(F.col("class") != F.col("centre")).groupBy("class", "centre").agg(F.count(F.lit(1)).alias("n"))
    nearest = shared.groupBy("class").agg(F.max(F.struct("n", "centre")).alias("x")).select(
        F.col("class").alias("a"), F.col("x.centre").alias("b"))
    for side in ("a", "b"):
        nearest = nearest.join(classes.select(F.col("class").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)
    nearest = nearest.where(different("sketch_a", "sketch_b") <= most_different(percent / 100, SAMPLES)).select("a", "b")
    links = confirmed(nearest, rows, source, percent, "near-links-1")
    most, sharp = most_different(percent / 100, SHARP), None
    for turn, forest in ((2, True), (3, False)):
        labels = components(links, f"near-components-{turn}")
        known = buckets.join(labels.withColumnRenamed("node", "class"), "class", "left").select(
            "h", "class", F.coalesce("root", "class").alias("root"))
        mixed = known.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("h")
        open_ = materialize(known.join(mixed, "h"), "near-open")
        if sharp is None:  # later there are only fewer of them
            sharp = materialize(of_classes(texts_of(
                open_.select("class").distinct(), rows, source, "near-open-rows"), "sharp"), "near-sharp")
        members = open_.join(sharp, "class").join(classes.select("class", "bands"), "class")
        links = links.unionByName(confirmed(across(members, most, forest), rows, source, percent, f"near-links-{turn}"))
    labels = components(links, "near-components")
    firsts = labels.join(classes.select(F.col("class").alias("node"), "first"), "node")
    least = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    named = firsts.join(least, "root").select(F.col("node").alias("class"), "component_id")
    named = classes.select("class", "first").join(named, "class", "left").select(
        "class", F.coalesce("component_id", "first").alias("component_id"))
    placed = rows.select("doc_id", "t", "n_shingles", "class").join(named, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"), *(["t"] if text_hash else []))


def without_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text",
                       broadcast_rows: int = 200_000) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, with all its columns.

    It is a row of the least id. Of rows with the same id and text one stays, that of the least hash of all its columns;
    different texts under the least id stay both. Texts without words are no duplicates of anything, but of rows with the
    same id and text one stays as well. Columns may have any name.
    """
    found = near_duplicates(docs, percent, id_col, text_col, text_hash=True)
    counted = materialize(found.groupBy("doc_id", "t").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where(
        ~F.col("kept") | (F.col("n") > 1)), "near-gone")
    few = counted.count() <= broadcast_rows  # 32 bytes each; beyond, the texts are shuffled
    listed = F.broadcast(counted) if few else counted
    names = [F.col(f"d.{quoted(c)}") for c in docs.columns]
    own_id, own_text = F.col(f"d.{quoted(id_col)}"), F.xxhash64(F.col(f"d.{quoted(text_col)}"))

    def met(kind: str, rows: DataFrame) -> DataFrame:
        return docs.alias("d").join(rows.alias("g"), own_id.eqNullSafe(F.col("g.doc_id")) & (own_text == F.col("g.t")), kind)

    once = met("left_anti", listed)
    repeated = met("inner", listed.where("kept"))
    place = free_name(docs.columns, "place")
    number = F.row_number().over(Window.partitionBy("g.doc_id", "g.t").orderBy(F.xxhash64(*names)))
    one = repeated.select(*names, number.alias(place)).where(F.col(place) == 1).drop(place)
    return once.unionAll(one)


def texts_of(classes: DataFrame, rows: DataFrame, source: DataFrame, name: str,
             broadcast_rows: int = 200_000) -> DataFrame:
    """(class, text) of one row of the documents for each class, found by id and hash of the text."""
    where = materialize(classes.join(rows.select("class", "doc_id", "t"), "class").groupBy("class").agg(
        F.min(F.struct("doc_id", "t")).alias("x")).select("class", "x.doc_id", "x.t"), name)
    few = where.count() <= broadcast_rows  # 40 bytes each; beyond, the texts are shuffled once
    w, d = (F.broadcast(where) if few else where).alias("w"), source.alias("d")
    return d.join(w, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.t") == F.col("w.t"))).select(
        "w.class", "d.text")


def confirmed(pairs: DataFrame, rows: DataFrame, source: DataFrame, percent: int, name: str) -> DataFrame:
    """Of the pairs (a, b) of classes, those whose full sets, taken again from the texts, are alike enough.

    Pairs that others of them connect may be left out (see ``blocks.checked``).
    """
    pairs = materialize(pairs, f"{name}-pairs")
    named = pairs.select(F.col("a").alias("class")).distinct().unionByName(pairs.select(F.col("b").alias("class")).distinct()).distinct()
    sets = materialize(of_classes(texts_of(named, rows, source, f"{name}-rows"), "set"), f"{name}-sets")
    return materialize(checked(pairs, sets, percent), name)
