"""Jaccard join of shingle sets with signature trees.

A document is its set of five-word shingles (fewer words: the whole sequence). Documents with the
same set are one class. Two classes are linked where the intersection is at least ``percent`` of
the union; asked for are the components of the links. Nothing is left to chance: all filters keep
every link.

Which sets meet: with all shingles in one order, a set of n shingles has a prefix of
n - ceil(percent n) + 1, and linked sets share a shingle of their prefixes. The first that they share stands in
the smaller set's first n - ceil(2 percent n / (100 + percent)) + 1, so a shingle that stands so early in no
set brings none together. What two sets can share from a shingle on is at most what either has left there, and under the
first shared one that is all they share: a set stays in a group only where it has enough left for the least set
that stands early there, and a pair is only looked at where both have enough left for a link. Most shingles stand in
one prefix only: a table of bits, made of four bytes a shingle, keeps them from being dealt out. Shingles that bring the
same sets together are one group: what counts is left at the first of them. The order is by hash, but
frequent shingles come last, so that passages that many documents share rarely bring documents
together. Which count as frequent is an estimate (``frequent``, a bounded table): any one order gives
the same links.

What meets under a shingle is compared by trees. A set's signature is a bitmap of its shingles, of
a size that follows the set's. A tree halves the sets of one size class again and again, by their
distance from two of them; a node holds the OR of its bitmaps, the ranges of its set sizes, the
most shingles that share bits, and whether all are of one component. Two trees are walked
together: a pair of nodes is dropped if sizes exclude a link, if both are of one component, or if
the bits that they share, and the shingles that may hide behind shared bits, are fewer than the
overlap that a link of their smallest sets needs. Pairs of sets that stay are counted on the sets.

Since only components are asked for, most links are found cheaply before: each set is compared with
the leader of the group that it shares most shingles with, ``ROUNDS`` times, the leaders of a
round being drawn anew among groups that still hold several components. The trees then only look
for links between components. A group's largest component is never compared with itself; what
is left of a large group is cut into blocks, so that no task holds a group.

Null, empty and blank texts have no shingles, link with nothing and are their own component. A
null id is less than none; its row joins the component of its text. Repeated rows share all
results. Very long texts are one row each, worked alone. An empty table gives no rows; extra columns, whatever
their names, are not looked at. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.blocks import crossed, in_blocks, runs_of
from salesmart.llm.common import byte_slices, mix64, tidy, utf8
from salesmart.llm.odd_sketch import class_of, components, confirmed, shingle_sets
from salesmart.session import materialize

ROUNDS = 2
SLICE_BYTES = 1 << 19
BITS_PER_SHINGLE = 8
LEAST_BITS, MOST_BITS = 256, 4096
LEAF = 24
BLOCK = 2048
#: Shingles that the order puts last: at most so many, of so many documents at least.
FREQUENT_ROWS, FREQUENT_COUNT = 1 << 18, 24
COUNTED_AT_ONCE = 1 << 19
#: The table of shared shingles: entries for each bin and sent at once, bits that name a shingle in its bin, bits of a bin and of all.
BIN_ENTRIES, KEY_BITS = 1 << 20, 30
BIN_BITS, TABLE_BITS = 1 << 21, 1 << 28
#: Groups whose pairs are looked at when they are made, and groups that a task holds then.
FEW, MANY = 64, 1 << 18


# ------------------------------------------------------------------ the order and the prefixes

def frequent(docs: DataFrame) -> np.ndarray:
    """Hashes of frequent shingles, the most frequent last; at most ``FREQUENT_ROWS``.

    Each task counts its documents' shingles and drops the rarest whenever its table is full, so counts
    are estimates from below. They decide on the order of the shingles only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        fresh: list[np.ndarray] = []
        held = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            more, n = np.unique(np.concatenate(fresh) if fresh else np.zeros(0, np.uint64), return_counts=True)
            both, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
            total = np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)
            bar = 1
            while len(both) > COUNTED_AT_ONCE // 4:
                bar += 1
                both, total = both[total >= bar], total[total >= bar]
            return both, total

        for batch in batches:
            for lo, hi in byte_slices(batch.column("text"), SLICE_BYTES):
                hashes, sizes = shingle_sets(utf8(batch.column("text").slice(lo, hi - lo)))
                fresh += [np.unique(x) for x in np.split(hashes, np.cumsum(sizes)[:-1])]
                held += len(hashes)
                if held >= COUNTED_AT_ONCE:
                    keys, counts = merged()
                    fresh, held = [], 0
        keys, counts = merged()
        some = counts >= 3
        yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(counts[some])], ["g", "n"])

    found = materialize(docs.select("text").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).where(
        F.col("n") >= FREQUENT_COUNT), "tree-frequent")
    # The bar that lets at most so many rows pass, by eighths of a power of two.
    step = F.floor(F.log2("n") * 8)
    bar, passed = None, 0
    for r in found.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("s")).toLocalIterator():
        passed += r["k"]
        if passed > FREQUENT_ROWS:
            break
        bar = r["s"]
    if bar is None:
        return np.zeros(0, np.uint64)
    top = found.where(step >= bar).toArrow()
    g, n = top.column("g").to_numpy(), top.column("n").to_numpy()
    return g[np.lexsort((g, n))].view(np.uint64)


class Order:
    """The order of the shingles: rare ones by hash, then the frequent ones as they are given."""

    def __init__(self, hot: np.ndarray):
        at = np.argsort(hot)
        self.keys, self.ranks = hot[at], at

    def sorted(self, shingles: np.ndarray) -> np.ndarray:
        """Distinct shingles (by hash) in the order."""
        if not len(self.keys) or not len(shingles):
            return shingles
        at = np.minimum(np.searchsorted(self.keys, shingles), len(self.keys) - 1)
        hot = self.keys[at] == shingles
        last = shingles[hot]
        return np.concatenate([shingles[~hot], last[np.argsort(self.ranks[at[hot]])]])


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def early_size(n: np.ndarray, percent: int) -> np.ndarray:
    """Places of sets of ``n`` among which the first shingle shared with a linked set, no smaller, stands."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


# ------------------------------------------------------------------ signatures

def size_class(n: int) -> int:
    """Sets of one class differ in size by less than a factor of two."""
    return max(n - 1, 0).bit_length()


def bits_of(k: int) -> int:
    """Bits of the signatures of a size class."""
    return min(max(BITS_PER_SHINGLE << k, LEAST_BITS), MOST_BITS)


def signature(shingles: np.ndarray) -> bytes:
    bits = np.zeros(bits_of(size_class(len(shingles))), bool)
    bits[(mix64(shingles) % np.uint64(len(bits))).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(words: np.ndarray, n_bits: int) -> np.ndarray:
    """Rows of signatures (64-bit words) brought down to fewer bits by OR, as if made with so many."""
    while words.shape[1] * 64 > n_bits:
        half = words.shape[1] // 2
        words = words[:, :half] | words[:, half:]
    return words


def sketched(docs: DataFrame, order: Order, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows, sets): doc_id, t, n_shingles and class of each row; class, n, prefix and signature of each class.

    A class may have several equal rows in ``sets``; a task that sees it again leaves them null.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for lo, hi in byte_slices(batch.column("text"), SLICE_BYTES):
                hashes, counts = shingle_sets(utf8(batch.column("text").slice(lo, hi - lo)))
                sizes, classes, prefixes, signatures = [], [], [], []
                for part in np.split(hashes, np.cumsum(counts)[:-1]):
                    part = np.unique(part)
                    name = class_of(part)
                    sizes.append(len(part))
                    classes.append(name)
                    if name is None or name in seen:
                        prefixes.append(None)
                        signatures.append(None)
                        continue
                    if len(seen) < 1 << 16:
                        seen.add(name)
                    prefixes.append(order.sorted(part)[:prefix_size(len(part), percent)].view(np.int64))
                    signatures.append(signature(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("t").slice(lo, hi - lo), pa.array(sizes, pa.int64()),
                     pa.array(classes, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                    ["doc_id", "t", "n_shingles", "class", "prefix", "bits"])

    all_ = materialize(docs.mapInArrow(
        run, f"doc_id {kind}, t long, n_shingles long, class binary, prefix array<long>, bits binary"), "tree-sets")
    return (all_.select("doc_id", "t", "n_shingles", "class"),
            all_.where(F.col("bits").isNotNull()).select("class", F.col("n_shingles").alias("n"), "prefix", "bits"))


# ------------------------------------------------------------------ the groups

def in_prefixes(batch: pa.RecordBatch, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(h, row, left, early) of all places of the prefixes of a batch of sets (n, prefix)."""
    sizes = pc.list_value_length(batch.column("prefix")).to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    n = batch.column("n").to_numpy()[row]
    return pc.list_flatten(batch.column("prefix")).to_numpy().view(np.uint64), row, n - at, at < early_size(n, percent)


def place_of(shingles: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, key): the part of the table of shared shingles that each belongs to, and ``KEY_BITS`` that name it there."""
    mixed = mix64(shingles)
    return (mixed >> np.uint64(32)) % np.uint64(bins), mixed & np.uint64((1 << KEY_BITS) - 1)


def shared_table(sets: DataFrame, percent: int) -> np.ndarray:
    """Bits (bins x bits) that are set for the shingles that stand in several prefixes, early in one, and for few others.

    A task sends each bin its shingles as numbers of four bytes, each once, marked if several sets there have it and
    if it stands early in one. The table has at most ``TABLE_BITS`` whatever the size of the input; a full one only
    lets more shingles through.
    """
    # Of n shingles a prefix has n - ceil(percent n / 100) + 1.
    total = sets.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
    bins = max(1, math.ceil(total / BIN_ENTRIES))
    size = min(BIN_BITS, 1 << max((TABLE_BITS // bins).bit_length() - 1, 3))

    def packed(codes: np.ndarray) -> pa.RecordBatch:
        """(bin, keys) of the codes: bin, key and whether it stands early."""
        codes = np.sort(codes)
        which = codes >> np.uint64(1)
        lasts = np.flatnonzero(np.append(which[1:] != which[:-1], True))
        several = np.diff(lasts, prepend=-1) > 1
        sent = (which[lasts] << np.uint64(2) | several.astype(np.uint64) << np.uint64(1) | codes[lasts] & np.uint64(1)).astype("<u4")
        bin_ = (which[lasts] >> np.uint64(KEY_BITS)).astype(np.int32)
        edges = np.flatnonzero(bin_[1:] != bin_[:-1]) + 1
        return pa.RecordBatch.from_arrays([pa.array(bin_[np.append(0, edges)]), pa.array(
            [part.tobytes() for part in np.split(sent, edges)], pa.binary())], ["bin", "keys"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            h, _, _, early = in_prefixes(batch, percent)
            bin_, key = place_of(h, bins)
            held.append((bin_ << np.uint64(KEY_BITS) | key) << np.uint64(1) | early.astype(np.uint64))
            if sum(map(len, held)) >= BIN_ENTRIES:
                yield packed(np.concatenate(held))
                held.clear()
        if sum(map(len, held)):
            yield packed(np.concatenate(held))

    def answer(rows: pa.Table) -> pa.Table:
        sent = np.concatenate([np.frombuffer(x, "<u4") for x in rows.column("keys").to_pylist()])
        keys, place, n = np.unique(sent >> 2, return_inverse=True, return_counts=True)
        several, early = n > 1, np.zeros(len(keys), bool)
        several[place[sent & 2 > 0]] = True
        early[place[sent & 1 > 0]] = True
        bits = np.zeros(size, bool)
        bits[keys[several & early] % size] = True
        return pa.table({"bin": rows.column("bin").slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    parts = sets.select("n", "prefix").mapInArrow(tidy(send), "bin int, keys binary").groupBy("bin").applyInArrow(
        answer, "bin int, bits binary").toArrow()
    table = np.zeros((bins, size // 8), np.uint8)
    for bin_, bits in zip(parts.column("bin").to_pylist(), parts.column("bits").to_pylist(), strict=True):
        table[bin_] = np.frombuffer(bits, np.uint8)
    return table


def entries_of(sets: DataFrame, percent: int) -> DataFrame:
    """(id, h, n, left, early) of the shingles of the prefixes that may bring sets (id, n, prefix) together."""
    shared = sets.sparkSession.sparkContext.broadcast(shared_table(sets, percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            h, row, left, early = in_prefixes(batch, percent)
            bin_, key = place_of(h, len(table))
            bit = (key % np.uint64(table.shape[1] * 8)).astype(np.int64)
            some = np.flatnonzero(table[bin_.astype(np.int64), bit >> 3] << (bit & 7).astype(np.uint8) & 128)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row[some])), pa.array(h[some].view(np.int64)),
                 batch.column("n").take(pa.array(row[some])), pa.array(left[some]), pa.array(early[some])],
                ["id", "h", "n", "left", "early"])

    return sets.select("id", "n", "prefix").mapInArrow(tidy(run), "id long, h long, n long, left long, early boolean")


def meeting(rows: np.ndarray, percent: int) -> np.ndarray:
    """Of rows (h, id, n, left, early) of whole groups, sorted by h and id, those that may be linked there, as (id, group, left).

    A member of a group of up to ``FEW`` stays if with another one sizes allow a link, both have enough left for it and the shingle
    stands early in the smaller; of larger groups all stay that have enough left for the least set that stands early. A
    group is named by its members.
    """
    rows = rows[:, np.append(True, (rows[:4, 1:] != rows[:4, :-1]).any(0))[:rows.shape[1]]]

    def runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        firsts = np.flatnonzero(np.append(True, rows[0, 1:] != rows[0, :-1])[:rows.shape[1]])
        return firsts, np.diff(np.append(firsts, rows.shape[1]))

    firsts, m = runs(rows)
    if not len(firsts):
        return np.zeros((3, 0), np.int64)
    none = np.iinfo(np.int64).max
    _, _, n, left, early = rows
    least = np.repeat(np.minimum.reduceat(np.where(early > 0, n, none), firsts), m)
    enough = (100 + percent) * left >= percent * (n + np.maximum(np.where(least < none, least, n), -(-percent * n // 100)))
    rows = rows[:, (least < none) & enough]
    firsts, m = runs(rows)
    of, kept = np.repeat(m, m), np.repeat(m > FEW, m)
    here = np.flatnonzero((of > 1) & ~kept)
    last = np.repeat(firsts + m, m)
    for step in range(1, FEW):
        here = here[here + step < last[here]]
        if not len(here):
            break
        (_, i, n, left, early), (_, j, k, rest, soon) = rows[:, here], rows[:, here + step]
        linked = (i != j) & (100 * np.minimum(n, k) >= percent * np.maximum(n, k))
        linked &= (100 + percent) * np.minimum(left, rest) >= percent * (n + k)
        linked &= ((early > 0) | (n > k)) & ((soon > 0) | (k > n))
        kept[here[linked]] = kept[here[linked] + step] = True
    rows = rows[:, kept]
    firsts, m = runs(rows)
    if not len(firsts):
        return np.zeros((3, 0), np.int64)
    # Equal sums of 64 bits are as rare among different members as equal hashes are.
    names = mix64(np.add.reduceat(mix64(rows[1].view(np.uint64)), firsts) + m.astype(np.uint64))
    return np.stack([rows[1], np.repeat(names, m).view(np.int64), rows[3]])


def groups_of(sets: DataFrame, percent: int) -> DataFrame:
    """(id, h, left, k): the groups that sets (id, n, prefix) meet in, one for all shingles that bring the same sets together.

    ``k`` is how many such shingles there are; ``left`` is taken at the first. A group beyond ``MANY`` is not held: all its rows stay.
    """
    names = ["h", "id", "n", "left", "early"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passing = np.zeros((5, 0), np.int64), None

        def out(found: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["id", "h", "left"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in names])
            rows = np.concatenate([held, rows], axis=1)
            if passing is not None:
                n = int(np.searchsorted(rows[0], passing, "right"))
                yield out(rows[[1, 0, 3], :n])
                rows = rows[:, n:]
                passing = passing if not rows.shape[1] else None
            if not rows.shape[1]:
                held = rows
                continue
            edge = int(np.searchsorted(rows[0], rows[0, -1]))
            yield out(meeting(rows[:, :edge], percent))
            held = rows[:, edge:].copy()
            if held.shape[1] > MANY:
                yield out(held[[1, 0, 3]])
                held, passing = held[:, :0], int(held[0, 0])
        yield out(meeting(held, percent))

    entries = entries_of(sets, percent).withColumn("early", F.col("early").cast("long")).select(*names)
    met = entries.repartition("h").sortWithinPartitions("h", "id").mapInArrow(tidy(run), "id long, h long, left long")
    return materialize(met.groupBy("id", "h").agg(F.max("left").alias("left"), F.count(F.lit(1)).alias("k")), "tree-groups")


# ------------------------------------------------------------------ trees

class Node:
    """A subtree over the members ``own``: places in the arrays of its group."""

    __slots__ = ("children", "hidden", "least", "left", "most", "own", "root", "word")

    def __init__(self, own: np.ndarray, words: np.ndarray, sizes: np.ndarray, hidden: np.ndarray, left: np.ndarray,
                 roots: np.ndarray):
        self.own = own
        self.word = np.bitwise_or.reduce(words[own], axis=0)
        self.least, self.most = int(sizes[own].min()), int(sizes[own].max())
        self.hidden, self.left = int(hidden[own].max()), int(left[own].max())
        self.root = int(roots[own[0]]) if (roots[own] == roots[own[0]]).all() else -1
        self.children: list[Node] = []


def tree(own: np.ndarray, words: np.ndarray, sizes: np.ndarray, hidden: np.ndarray, left: np.ndarray,
         roots: np.ndarray) -> Node:
    """Halves the members by which of two far ones they are nearer to, down to leaves of ``LEAF``."""
    top = Node(own, words, sizes, hidden, left, roots)
    todo = [top]
    while todo:
        node = todo.pop()
        if len(node.own) <= LEAF:
            continue
        inside = words[node.own]
        a = inside[np.bitwise_count(inside ^ inside[0]).sum(1).argmax()]
        from_a = np.bitwise_count(inside ^ a).sum(1, dtype=np.int64)
        b = inside[from_a.argmax()]
        nearer = from_a - np.bitwise_count(inside ^ b).sum(1, dtype=np.int64)
        # Cut at the middle of the order, so that the depth stays a logarithm.
        by = np.lexsort((sizes[node.own], nearer))
        for half in (by[:len(by) // 2], by[len(by) // 2:]):
            node.children.append(Node(node.own[half], words, sizes, hidden, left, roots))
        todo += node.children
    return top


def needed(a: int, b: int, percent: int) -> int:
    """The least intersection of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def met(words: np.ndarray, sizes: np.ndarray, hidden: np.ndarray, left: np.ndarray, roots: np.ndarray, one: Node, other: Node,
        percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of members under the two nodes that sizes, components, signatures and what is ``left`` do not rule out."""
    todo = [(one, other)]
    while todo:
        a, b = todo.pop()
        if a.root >= 0 and a.root == b.root:
            continue
        if 100 * min(a.most, b.most) < percent * max(a.least, b.least):
            continue
        bits = int(np.bitwise_count(a.word & b.word).sum())
        if min(bits + min(a.hidden, b.hidden), a.left, b.left) < needed(a.least, b.least, percent):
            continue
        if a is b and a.children:
            x, y = a.children
            todo += [(x, x), (x, y), (y, y)]
        elif a.children and (len(a.own) >= len(b.own) or not b.children):
            todo += [(x, b) for x in a.children]
        elif b.children:
            todo += [(a, y) for y in b.children]
        else:
            n = np.add.outer(sizes[a.own], sizes[b.own])
            both = np.bitwise_count(words[a.own][:, None, :] & words[b.own][None, :, :]).sum(2, dtype=np.int64)
            most = np.minimum(both + np.minimum.outer(hidden[a.own], hidden[b.own]), np.minimum.outer(left[a.own], left[b.own]))
            fits = (100 + percent) * most >= percent * n
            fits &= roots[a.own][:, None] != roots[b.own][None, :]
            for i, j in np.argwhere(fits):
                if a is not b or i < j:
                    yield int(a.own[i]), int(b.own[j])


def close(sizes: np.ndarray, signatures: list[bytes], roots: np.ndarray, percent: int,
          sides: np.ndarray | None = None, left: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Pairs of members of different components that may be linked, by trees of each size class.

    With ``sides`` (0 or 1) only pairs of one member of either side; with ``left``, the most that each shares with any other,
    only pairs that need no more.
    """
    left = sizes if left is None else left
    classes = np.array([size_class(int(n)) for n in sizes])
    by_class = {int(k): np.flatnonzero(classes == k) for k in np.unique(classes)}
    for k, own in by_class.items():
        for other in (k, k + 1):
            if other not in by_class:
                continue
            bits = bits_of(k)
            words = np.zeros((len(sizes), bits // 64), np.uint64)
            for kind in {k, other}:
                at = by_class[kind]
                words[at] = folded(np.frombuffer(b"".join(signatures[i] for i in at), np.uint64).reshape(len(at), -1), bits)
            hidden = sizes - np.bitwise_count(words).sum(1, dtype=np.int64)
            arrays = (words, sizes, hidden, left, roots)
            if sides is None:
                parts = [(own, own)] if other == k else [(own, by_class[other])]
            else:
                wide = by_class[other]
                parts = [(own[sides[own] == s], wide[sides[wide] == 1 - s]) for s in ((0,) if other == k else (0, 1))]
            for x, y in parts:
                if len(x) and len(y):
                    one = tree(x, *arrays)
                    yield from met(*arrays, one, one if x is y else tree(y, *arrays), percent)


# ------------------------------------------------------------------ the join

def candidates(members: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ids of one group and different components that the trees do not rule out.

    Members are (h, id, left, root), signatures (id, n, bits). No task holds a large group, and its largest component is not compared
    with itself (see ``blocks``).
    """
    dealt = in_blocks(members.withColumnRenamed("id", "who"), BLOCK, signatures.withColumnRenamed("id", "who")).withColumnRenamed("who", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, ["h", "i", "j"]):
            _, roots = np.unique(rows.column("root").to_numpy(), return_inverse=True)
            sides = rows.column("side").to_numpy() if crossed(rows) else None
            ids = rows.column("id").to_numpy()
            found = np.array(list(close(rows.column("n").to_numpy(), rows.column("bits").to_pylist(), roots, percent, sides,
                                        rows.column("left").to_numpy())), np.int64).reshape(-1, 2)
            if len(found):
                x, y = ids[found[:, 0]], ids[found[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def possible(pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, n_a, n_b, bits_a, bits_b) that sizes and signatures do not rule out, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b")), strict=True):
                size = min(len(x), len(y)) * 8
                u, v = (folded(np.frombuffer(w, np.uint64)[None, :], size)[0] for w in (x, y))
                hidden = min(n - int(np.bitwise_count(u).sum()), m - int(np.bitwise_count(v).sum()))
                keep.append(min(int(np.bitwise_count(u & v).sum()) + hidden, n, m) >= needed(n, m, percent))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def linked(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    if not 50 < percent <= 100:
        raise ValueError("linked sets must differ in size by less than a factor of two")
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    order = Order(frequent(source))
    rows, sets = sketched(source, order, percent)
    # Within the groups a class is known by 8 bytes of its digest; a chance agreement only adds candidates.
    id_ = F.xxhash64("class").alias("id")
    groups = groups_of(sets.select(id_, "n", "prefix"), percent)
    signatures = materialize(sets.select(id_, "class", "n", "bits").join(
        groups.select("id").distinct(), "id", "left_semi").dropDuplicates(["class"]), "tree-signatures")

    def classes(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            named = signatures.select(F.col("id").alias(side), F.col("class").alias(f"class_{side}"))
            pairs = pairs.join(named, side)
        return pairs.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))

    def labelled(links: DataFrame, name: str) -> DataFrame:
        """The groups that hold several components: h, id, left, k, root."""
        roots = components(links, name).select(F.xxhash64("node").alias("id"), F.xxhash64("root").alias("root"))
        known = groups.join(roots, "id", "left").select("h", "id", "left", "k", F.coalesce("root", "id").alias("root"))
        mixed = known.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("h")
        return materialize(known.join(mixed, "h"), f"{name}-open")

    links: DataFrame | None = None
    for turn in range(ROUNDS):
        open_ = groups.withColumn("root", F.col("id")) if links is None else labelled(links, f"tree-components-{turn}")
        drawn = F.xxhash64("id", F.lit(turn))
        leaders = open_.groupBy("h").agg(F.min(F.struct(drawn.alias("x"), F.col("id"), F.col("root"))).alias("l")).select(
            "h", F.col("l.id").alias("leader"), F.col("l.root").alias("led"))
        shared = open_.join(leaders, "h").where(F.col("root") != F.col("led")).groupBy("id", "leader").agg(F.sum("k").alias("k"))
        nearest = shared.groupBy("id").agg(F.max(F.struct("k", "leader")).alias("x")).select(
            F.col("id").alias("a"), F.col("x.leader").alias("b"))
        for side in ("a", "b"):
            nearest = nearest.join(signatures.select(
                F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
        sure = confirmed(classes(possible(nearest, percent)), rows, source, percent, f"tree-links-{turn}")
        links = sure if links is None else links.unionByName(sure)
    open_ = labelled(links, "tree-components-last")
    found = candidates(open_.select("h", "id", "left", "root"), signatures.select("id", "n", "bits"), percent)
    links = links.unionByName(confirmed(classes(found), rows, source, percent, "tree-links-last"))
    named = components(links, "tree-components").withColumnRenamed("node", "class")
    own = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("first"))
    placed = own.join(named, "class", "left").select("class", "first", F.coalesce("root", "class").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = placed.join(least, "root").select("class", "component_id")
    return rows.join(of_class, "class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
