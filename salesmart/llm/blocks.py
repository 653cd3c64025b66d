"""Pairs within groups of any size, dealt out so that no task holds a group; and pairs checked on full sets.

Only pairs between components are of interest. A group's largest component is not compared with
itself: what is left of the group (its minors) is cut into blocks, and the blocks of minors meet
each other and the blocks of the largest component. A small group is one block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import tidy
from salesmart.session import materialize

BLOCK_BYTES = 16 << 20  # of the sets of one block
BLOCK_PAIRS = 20_000
FEW_PAIRS = 100_000  # whose blocks are sent to all tasks, some 8 MB


def in_blocks(members: DataFrame, block: int, more: DataFrame | None = None) -> DataFrame:
    """The rows (h, root, who, ...) once for each pair of blocks (i, j) of their group h that they belong to, sorted by these.

    ``side`` is 0 or 1 where only pairs of one row of either side are asked for (i differs from j), which
    ``crossed`` tells. Groups of one component are left out. Ties for the largest component go to the greatest root. Columns
    of ``more``, by ``who``, come in last, so that they are dealt out once.
    """
    of_root = members.groupBy("h", "root").agg(F.count(F.lit(1)).alias("k"))
    groups = of_root.groupBy("h").agg(F.sum("k").alias("m"), F.max(F.struct("k", "root")).alias("x")).where(F.col("m") > F.col("x.k"))
    a, b = members.alias("a"), groups.select(F.col("h").alias("g"), "m", F.col("x.root").alias("largest"),
                                             (F.col("m") - F.col("x.k")).alias("minors")).alias("b")
    joined = a.join(b, F.col("a.h") == F.col("b.g")).select("a.*", "m", "minors", (F.col("root") != F.col("largest")).alias("minor"))
    cuts, rest = F.ceil(F.col("minors") / block).cast("int"), F.ceil((F.col("m") - F.col("minors")) / block).cast("int")
    own = F.pmod(F.xxhash64("who"), F.when(F.col("minor"), cuts).otherwise(rest)).cast("int")

    def place(i: Column, j: Column, side: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    # (i, j): blocks of minors, i <= j; (i, -1 - j): block i of minors and block j of the largest component.
    with_minors = F.transform(F.sequence(F.lit(0), cuts - 1), lambda o: place(
        F.least("own", o), F.greatest("own", o), F.col("own") > o))
    with_rest = F.transform(F.sequence(F.lit(0), rest - 1), lambda o: place(F.col("own"), -1 - o, F.lit(0)))
    from_rest = F.transform(F.sequence(F.lit(0), cuts - 1), lambda o: place(o, -1 - F.col("own"), F.lit(1)))
    whole = F.array(place(F.lit(-1), F.lit(-1), F.lit(0)))
    blocks = F.when(F.col("m") <= 2 * block, whole).when(F.col("minor"), F.concat(with_minors, with_rest)).otherwise(from_rest)
    names = [c for c in members.columns if c != "h"]
    dealt = joined.withColumn("own", own).select("h", F.explode(blocks).alias("x"), *names).select("h", "x.i", "x.j", "x.side", *names)
    return (dealt if more is None else dealt.join(more, "who")).repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")


def crossed(rows: pa.Table) -> bool:
    """Whether only pairs across the two sides of these rows (one pair of blocks) count."""
    return rows.column("i")[0].as_py() != rows.column("j")[0].as_py()


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal integer keys in sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        codes = np.stack([table.column(k).to_numpy() for k in keys])
        edges = [0, *(np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(0)) + 1).tolist()]
        for lo, hi in zip(edges, edges[1:]):
            yield table.slice(lo, hi - lo)
        held = table.slice(edges[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def near_blocks(pairs: DataFrame, sets: DataFrame, k: int, few: bool) -> DataFrame:
    """(class, block): classes that the pairs (a, b) join stand in one of ``k`` blocks where they fit in, so that few are sent twice.

    A class goes with the least hash among its neighbours and theirs; what would go together beyond a block is cut by hash.
    """
    both = pairs.select(F.col("a").alias("class"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("class"), F.col("a").alias("other")))
    own = F.xxhash64("class")
    first = both.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.least(own, F.min(F.xxhash64("other"))).alias("near"))
    near = first.select(F.col("class").alias("other"), F.col("near").alias("next"))
    second = both.join(F.broadcast(near) if few else near, "other").groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.min("next").alias("key"))
    sizes = sets.select("class", (F.size("set").cast("long") * 8).alias("size")).groupBy("class").agg(F.max("size").alias("size"))
    placed = materialize(second.join(sizes, "class"), "blocks-near")
    cuts = placed.groupBy("key").agg(F.greatest(
        F.ceil(F.sum("size") / BLOCK_BYTES), F.ceil(F.sqrt(F.sum("n") / (2 * BLOCK_PAIRS)))).alias("cuts"))
    return placed.join(cuts, "key").select("class", F.pmod(
        F.xxhash64("key", F.pmod(F.xxhash64("class", F.lit(k)), "cuts")), F.lit(k)).cast("int").alias("block"))


def checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of classes, links that join what all linked pairs would join.

    ``sets`` are (class, set); a class may have several equal rows. Classes are dealt to blocks whose sets fit in memory
    together, and the pairs of two blocks are checked in one task, which is sent each set that it needs once, however many
    pairs it is in. A pair whose classes are connected by links found in the same task is not counted.
    """
    size, n = sets.agg(F.sum(F.size("set").cast("long") * 8)).first()[0] or 0, pairs.count()
    k = max(1, math.ceil(size / BLOCK_BYTES), math.ceil(n / BLOCK_PAIRS))
    few = n <= FEW_PAIRS
    if k == 1:
        dealt = pairs.select("a", "b", F.lit(0).alias("i"), F.lit(0).alias("j"))
    else:
        place = materialize(near_blocks(pairs, sets, k, few), "blocks-place")
        dealt = pairs
        for c, block in (("a", "i"), ("b", "j")):
            named = place.select(F.col("class").alias(c), F.col("block").alias(block))
            dealt = dealt.join(F.broadcast(named) if few else named, c)
        dealt = dealt.select("a", "b", "i", "j")
    needed = dealt.select("i", "j", F.col("a").alias("class")).distinct().unionByName(
        dealt.select("i", "j", F.col("b").alias("class")).distinct()).distinct()
    needed = F.broadcast(needed) if few else needed
    with_sets = needed.join(sets, "class").select("i", "j", F.col("class").alias("a"), F.lit(None).cast("binary").alias("b"), "set")
    both = with_sets.unionByName(dealt.withColumn("set", F.lit(None).cast("array<long>")))
    rows = both.repartition("i", "j").sortWithinPartitions("i", "j", F.col("b").isNotNull()).select("i", "j", "a", "b", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, root = None, {}, {}

        def find(x: bytes) -> bytes:
            while root.get(x, x) != x:
                root[x] = x = root.get(root[x], root[x])
            return x

        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            lists = batch.column("set")
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for row, (i, j, a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("i", "j", "a", "b")), strict=True)):
                if (i, j) != at:
                    at, held, root = (i, j), {}, {}
                if b is None:
                    held[a] = flat[ends[row]:ends[row + 1]].view(np.uint64).copy()
                    continue
                x, y = find(a), find(b)
                if x == y:
                    continue
                both = len(np.intersect1d(held[a], held[b], assume_unique=True))
                if 100 * both >= percent * (len(held[a]) + len(held[b]) - both):
                    root[x] = y
                    found.append((a, b))
            if found:
                left, right = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    return rows.mapInArrow(tidy(run), "a binary, b binary")
