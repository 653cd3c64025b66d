"""Conversation repair: the cheapest edits that give a well-formed sequence of roles.

The rows of a conversation, by turn, are edited so that the initials of their roles match
``(s?(ua)+)?``. Four states read it: nothing yet, after the system message, after a user, after an
assistant. A row is kept, given the role user or assistant, or deleted (blank and repeated rows
must be); messages may be inserted before it. So a row is a 4 x 4 matrix of costs from state to
state, and of the least strings of edits that reach them.

Hirschberg's method finds the path: the forward vector of four costs over the first half of the
rows and the backward vector over the second half meet in the middle, the crossing is chosen, and
either half is solved alone between its two states. Only vectors are held, never a table of all
rows. Where several crossings are cheapest the one whose edits so far are least is chosen: beside
the costs the forward vector ranks the states by their least strings of edits. Two of these
differ before either ends, for both end with the edit of the same row; so later edits never turn
the order around.

The same method runs on two levels, so that no conversation is one task. Rows are range-sorted by
conversation, turn, role and hash of the text; each stretch of at most ``SEGMENT`` rows of one conversation is
summed up as one matrix of costs and ranks. The matrices of a conversation (one for thousands of
rows) are solved first, which gives each stretch its two states; the stretches are then solved
independently. Only the digest of a whole conversation (``digests``) streams its texts through
one task, since a hash is taken in order; nothing is held there but one text.

Equal rows (conversation, turn, role, text) are one row with a count. Rows of one turn are taken by
role, in code-point order, and then by the MD5 of the text; null turns come first. A null role or text counts as one
space, a null conversation as a conversation, and in the damage's checksum as one space. A role is
told by its first character: an empty or unknown one can't be kept. A conversation none of whose
rows survive the damage has no faults, no edits and the digest of the empty string. Extra columns,
whatever their names, are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.session import materialize

SEGMENT = 4096
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
NEVER = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)
# Which state a role's initial leads to from each state.
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What an inserted or re-roled message must be: the state that follows each state.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Messages to insert at the end so that the conversation may stop.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
INITIALS = "sua"
N_KINDS = 9

Step = tuple[np.ndarray, np.ndarray]  # costs and ranks, from state (row) to state (column)


def kind_of(initial: Column, deleted: Column, truncated: Column) -> Column:
    """A row's kind: 0 where it must be deleted, else 1 + 2 * (initial among s, u, a, others) + truncated."""
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.when(deleted, 0).otherwise(1 + 2 * place + truncated.cast("int")).cast("int")


def _edits(kind: int) -> list[list[tuple[int, str]]]:
    """For one row: from state to state, the least cost and the least string of edits of that cost."""
    best = [[(NEVER, "")] * 4 for _ in range(4)]

    def offer(a: int, b: int, cost: int, edits: str) -> None:
        best[a][b] = min(best[a][b], (cost, edits))

    for a in range(4):
        here, before = a, ""
        for _ in range(3):  # a third insertion only leads back to a state that one reaches
            paid = INSERT * len(before)
            offer(a, here, paid + DELETE, before + "D")
            if kind:
                initial, cut = (INITIALS + "?")[(kind - 1) // 2], CUT * ((kind - 1) % 2)
                to = STEPS.get(initial, {}).get(here)
                if to is not None:
                    offer(a, to, paid + cut, before + "K")
                offer(a, NEXT[here], paid + cut + REROLE, before + "R")
            here, before = NEXT[here], before + "I"
    return best


EDITS = [_edits(kind) for kind in range(N_KINDS)]


def _step(edits: list[list[tuple[int, str]]]) -> Step:
    costs = np.array([[c for c, _ in row] for row in edits], np.int64)
    ranks = np.array([[sorted(s for _, s in row).index(s) for _, s in row] for row in edits], np.int64)
    return costs, ranks


STEP = [_step(e) for e in EDITS]


def forward(costs: list[int], ranks: list[int], step: Step) -> tuple[list[int], list[int]]:
    """The least costs of the four states after a step, and the order of their least strings of edits."""
    more, after = step
    reached = []
    for b in range(4):
        # Different states never have the same string; from one state, the step's own order decides.
        reached.append(min((min(costs[a] + int(more[a, b]), NEVER), ranks[a], int(after[a, b])) for a in range(4)))
    order = sorted({r[1:] for r in reached})
    return [r[0] for r in reached], [order.index(r[1:]) for r in reached]


def backward(step: Step, costs: list[int]) -> list[int]:
    """The least costs from the four states before a step to the end, given those after it."""
    return [min(min(int(step[0][a, b]) + costs[b], NEVER) for b in range(4)) for a in range(4)]


def _only(state: int) -> list[int]:
    return [0 if s == state else NEVER for s in range(4)]


def crossings(steps: list[Step], start: int, ends: list[int]) -> list[tuple[int, int]]:
    """The states before and after each step on the path of least cost, then least edits, from ``start``.

    ``ends`` are the costs of stopping in each state.
    """
    if len(steps) == 1:
        costs, ranks = forward(_only(start), [0, 1, 2, 3], steps[0])
        return [(start, min(range(4), key=lambda s: (costs[s] + ends[s], ranks[s])))]
    half = len(steps) // 2
    costs, ranks = _only(start), [0, 1, 2, 3]
    for step in steps[:half]:
        costs, ranks = forward(costs, ranks, step)
    rest = ends
    for step in reversed(steps[half:]):
        rest = backward(step, rest)
    middle = min(range(4), key=lambda s: (costs[s] + rest[s], ranks[s]))
    return crossings(steps[:half], start, _only(middle)) + crossings(steps[half:], middle, ends)


def product(steps: list[Step]) -> Step:
    """One step for many: costs between states, and for each first state the order of the strings."""
    rows = []
    for a in range(4):
        costs, ranks = _only(a), [0, 1, 2, 3]
        for step in steps:
            costs, ranks = forward(costs, ranks, step)
        rows.append((costs, ranks))
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


# Conversations are mostly short and alike, so what a sequence of kinds gives is remembered.
@lru_cache(maxsize=1 << 12)
def _product_of(kinds: bytes) -> Step:
    return product([STEP[k] for k in kinds])


@lru_cache(maxsize=1 << 12)
def _edits_of(kinds: bytes, start: int, end: int) -> list[str]:
    return [EDITS[k][a][b][1] for k, (a, b) in zip(kinds, crossings([STEP[k] for k in kinds], start, _only(end)), strict=True)]


def product_of(kinds: bytes) -> Step:
    return _product_of(kinds) if len(kinds) <= 64 else product([STEP[k] for k in kinds])


def edits_of(kinds: bytes, start: int, end: int) -> list[str]:
    """The edits of each row (insertions before it, then its own) from state to state."""
    return _edits_of(kinds, start, end) if len(kinds) <= 64 else _edits_of.__wrapped__(kinds, start, end)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in sorted batches. A run is held whole: for keys with few rows only."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        codes = [table.column(k).dictionary_encode(null_encoding="encode").combine_chunks().indices.to_numpy(zero_copy_only=False)
                 for k in keys]
        edges = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1).tolist()]
        for lo, hi in zip(edges, edges[1:]):
            yield table.slice(lo, hi - lo)
        held = table.slice(edges[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def prepared(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): nulls of role and text as one space, equal rows as one with their number."""
    space = F.lit(" ")
    return rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                       F.coalesce("text", space).alias("text")).groupBy("conv_id", "turn", "role", "text").agg(
        F.count(F.lit(1)).alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """Of prepared rows: conv_id, turn, role, h (hash of the text), copies, blank, truncated, seen (in an earlier turn)."""
    last = F.substr(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(-1), F.lit(1))
    keyed = rows.select("conv_id", "turn", "role", F.md5("text").alias("h"), "copies",
                        (last == "").alias("blank"), (~last.isin("", ".", "!", "?")).alias("truncated"))
    # A null turn is the first one.
    firsts = keyed.groupBy("conv_id", "role", "h").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("later"), "turn")).alias("first"))
    a, b = keyed.alias("a"), firsts.alias("b")
    return a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role"))
                  & (F.col("a.h") == F.col("b.h"))).select(
        "a.*", (~F.col("a.turn").eqNullSafe(F.col("b.first.turn"))).alias("seen"))


def stretches(rows: DataFrame) -> DataFrame:
    """Rows of ``faults`` in order, cut into stretches: seg rises along a conversation, pos within a stretch.

    A row of many copies becomes several, so that a stretch has at most ``SEGMENT`` rows, copies counted.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("h").asc()]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kind = rows.schema["conv_id"].dataType.simpleString()
    turn = rows.schema["turn"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, taken, before = -1, 0, object()
        for batch in batches:
            at, seg_, pos, copies, seen = [], [], [], [], []
            parts = batch.column("part").to_pylist()
            for i, (conv, n, was) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "copies", "seen")),
                                                   strict=True)):
                if conv != before:
                    seg, taken, before = seg + 1, 0, conv
                while n:
                    if taken == SEGMENT:
                        seg, taken = seg + 1, 0
                    some = min(n, SEGMENT - taken)
                    at.append(i)
                    seg_.append((parts[i] << 32) + seg)
                    pos.append(taken)
                    copies.append(some)
                    seen.append(was)
                    n, taken, was = n - some, taken + some, True
            picked = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(picked.column(c) for c in ("conv_id", "turn", "role", "h", "blank", "truncated")), pa.array(copies, pa.int64()),
                 pa.array(seen, pa.bool_()), pa.array(seg_, pa.int64()), pa.array(pos, pa.int32())],
                ["conv_id", "turn", "role", "h", "blank", "truncated", "copies", "seen", "seg", "pos"])

    return sorted_.mapInArrow(run, f"conv_id {kind}, turn {turn}, role string, h string, blank boolean, truncated boolean, "
                                   "copies long, seen boolean, seg long, pos int").withColumn(
        "initial", F.substr("role", F.lit(1), F.lit(1)))


def _kinds(table: pa.Table) -> tuple[bytes, list[int]]:
    """The kinds of all rows of a stretch, copies spelt out, and the number of copies of each."""
    firsts, copies = table.column("kind").to_pylist(), table.column("copies").to_pylist()
    return b"".join(bytes([k]) + bytes(n - 1) for k, n in zip(firsts, copies, strict=True)), copies


def _legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def sums(rows: DataFrame) -> DataFrame:
    """One row per stretch: its matrix, first and last initial, and the illegal neighbours within it."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["conv_id", "seg"]):
            kinds, copies = _kinds(table)
            costs, ranks = product_of(kinds)
            initials = table.column("initial").to_pylist()
            illegal = sum(not _legal(a, b) for a, b in zip(initials, initials[1:]))
            illegal += sum((n - 1) * (not _legal(a, a)) for a, n in zip(initials, copies, strict=True))
            yield pa.RecordBatch.from_arrays(
                [table.column("conv_id").slice(0, 1).combine_chunks(), table.column("seg").slice(0, 1).combine_chunks(),
                 pa.array([costs.ravel().tolist()], pa.list_(pa.int64())), pa.array([ranks.ravel().tolist()], pa.list_(pa.int64())),
                 pa.array([initials[0]]), pa.array([initials[-1]]), pa.array([illegal], pa.int64())],
                ["conv_id", "seg", "costs", "ranks", "first", "last", "illegal"])

    return by_stretch(rows).mapInArrow(
        batched(run), f"conv_id {kind}, seg long, costs array<long>, ranks array<long>, first string, last string, illegal long")


def by_stretch(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "pos")


def batched(run: Callable, rows: int = 2000) -> Callable:
    """The function with its small batches joined to larger ones."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def paths(summed: DataFrame) -> DataFrame:
    """Per stretch its states (start, end) and, on the last one, the messages to add; cost and illegal of the conversation."""
    kind = summed.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["conv_id"]):
            steps = [(np.array(c, np.int64).reshape(4, 4), np.array(r, np.int64).reshape(4, 4)) for c, r in zip(
                table.column("costs").to_pylist(), table.column("ranks").to_pylist(), strict=True)]
            states = crossings(steps, START, [INSERT * CLOSING[s] for s in range(4)])
            n, closing = len(states), CLOSING[states[-1][1]]
            cost = sum(int(step[0][a, b]) for step, (a, b) in zip(steps, states, strict=True)) + INSERT * closing
            firsts, lasts = table.column("first").to_pylist(), table.column("last").to_pylist()
            illegal = sum(table.column("illegal").to_pylist()) + sum(not _legal(a, b) for a, b in zip(lasts, firsts[1:]))
            yield pa.RecordBatch.from_arrays(
                [table.column("conv_id").combine_chunks(), table.column("seg").combine_chunks(),
                 pa.array([a for a, _ in states], pa.int32()), pa.array([b for _, b in states], pa.int32()),
                 pa.array([0] * (n - 1) + [closing], pa.int32()), pa.array([0] * (n - 1) + [cost], pa.int64()),
                 pa.array([0] * (n - 1) + [illegal], pa.int64())],
                ["conv_id", "seg", "start", "end", "closing", "cost", "illegal"])

    dealt = summed.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    return dealt.mapInArrow(batched(run), f"conv_id {kind}, seg long, start int, end int, closing int, cost long, illegal long")


def edited(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``stretches`` with their edits and the state before them; insertions stand before the row's own edit."""
    kind, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    a, b = rows.alias("a"), found.alias("b")
    joined = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.seg") == F.col("b.seg"))).select(
        "a.*", "b.start", "b.end", "b.closing")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["conv_id", "seg"]):
            kinds, copies = _kinds(table)
            state = table.column("start")[0].as_py()
            edits = edits_of(kinds, state, table.column("end")[0].as_py())
            texts, states, i = [], [], 0
            for n in copies:
                states.append(state)
                texts.append("".join(edits[i:i + n]))
                for k, e in zip(kinds[i:i + n], edits[i:i + n], strict=True):
                    state = after(state, e, k)
                i += n
            texts[-1] += "I" * table.column("closing")[0].as_py()
            table = table.combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [*(table.column(c).combine_chunks() for c in ("conv_id", "turn", "role", "h", "seg", "pos")),
                 pa.array(texts, pa.string()), pa.array(states, pa.int32())],
                ["conv_id", "turn", "role", "h", "seg", "pos", "edits", "state"])

    return by_stretch(joined).mapInArrow(
        batched(run), f"conv_id {kind}, turn {turn}, role string, h string, seg long, pos int, edits string, state int")


def after(state: int, edits: str, kind: int) -> int:
    """The state behind a row's edits."""
    for e in edits:
        if e == "K":
            state = STEPS[INITIALS[(kind - 1) // 2]][state]
        elif e in "IR":
            state = NEXT[state]
    return state


def repair(damaged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(texts, rows, edits, totals) of the rows (conv_id, turn, role, text).

    ``texts`` are the prepared rows; ``rows`` those in order with their faults; ``edits`` the rows with
    their edits; ``totals`` have cost and illegal neighbours per conversation.
    """
    texts = materialize(prepared(damaged), "repair-texts")
    deleted = F.col("blank") | F.col("seen")
    rows = materialize(stretches(faults(texts)).withColumn(
        "kind", kind_of(F.col("initial"), deleted, F.col("truncated"))), "repair-rows")
    found = materialize(paths(sums(rows)), "repair-paths")
    totals = found.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    return texts, rows, edited(rows, found), totals


def digests(texts: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) per conversation.

    Texts and edits of a conversation pass through one task in order; a text is held at a time.
    """
    kind = texts.schema["conv_id"].dataType.simpleString()
    words = texts.select("conv_id", "turn", "role", F.md5("text").alias("h"), F.lit(0).cast("long").alias("seg"),
                         F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("edits"), F.lit(0).alias("state"), "text")
    both = words.unionByName(edits.withColumn("text", F.lit(None).cast("string")))
    # A text stands before its edits: of all rows of its turn, role and hash it has no edits.
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h"),
             F.col("edits").isNotNull(), F.col("seg"), F.col("pos")]
    dealt = both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "edits", "state", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, open_, text = None, False, ""
        audit: list[str] = []
        digest, some = hashlib.sha256(), False

        def message(role: str, words: str) -> None:
            nonlocal some
            digest.update(f"{'\n' if some else ''}{role}:{words}".encode())
            some = True

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], schema_type), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])],
                ["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            schema_type = batch.schema.field("conv_id").type
            for c, role, edits, state, words_ in zip(*(batch.column(x).to_pylist() for x in (
                    "conv_id", "role", "edits", "state", "text")), strict=True):
                if not open_ or c != conv:
                    if open_:
                        yield ended()
                    conv, open_, audit, digest, some = c, True, [], hashlib.sha256(), False
                if edits is None:
                    text = words_
                    continue
                audit.append(edits)
                for e in edits:
                    if e == "I":
                        state = NEXT[state]
                        message(ROLE[state], "")
                    elif e == "R":
                        state = NEXT[state]
                        message(ROLE[state], text)
                    elif e == "K":
                        state = STEPS[role[0]][state]
                        message(role, text)
        if open_:
            yield ended()

    return dealt.mapInArrow(batched(run), f"conv_id {kind}, audit string, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after a fixed damage, chosen by a checksum of conversation and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    h = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.select("conv_id", "turn", h.alias("h"), role.alias("role"), text.alias("text")).where("h <> 0").select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def summary(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row for each conversation of ``conversations``, from its rows in ``damaged``: faults, cost, audit and digest."""
    texts, rows, edits, totals = repair(damaged)
    gone = F.col("blank")
    again = ~gone & F.col("seen")
    more = F.col("copies") - 1  # the copies after a row's first
    counts = rows.groupBy("conv_id").agg(
        F.sum(F.when(gone, F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(again, F.col("copies")).when(~gone, more).otherwise(0)).alias("duplicate"),
        F.sum(F.when(~gone & ~again & F.col("truncated"), 1).otherwise(0)).alias("truncated"))
    turns = rows.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    out = conversations.select("conv_id").distinct()
    for part in (counts, turns, totals, digests(texts, edits)):
        a, b = out.alias("a"), part.alias("b")
        out = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")), "left").select(
            "a.*", *(F.col(f"b.{c}") for c in part.columns if c != "conv_id"))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
