"""Spelling variants, conversation repair and the Jaccard join against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import conversation_repair as cr
from salesmart.llm import pivotal_grams as pg
from salesmart.llm import signature_trees as st

LOWER = {c: c + 32 for c in range(65, 91)}
BLANKS = " \t\n\x0b\x0c\r"


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ spelling variants

def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_definition(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    out, forms = [], {}
    for w in n:
        others = [v for v in n if near(v, w)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 10 * n[w] else None
        forms[w] = form
        out.append([w, n[w], len(others), form, None if form is None else n[form]])
    for row in out:
        w = row[0]
        while forms[w] is not None:
            w = forms[w]
        row.append(w)
    return sorted(map(tuple, out), key=repr)


COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def test_variants_by_definition(spark, both):
    rows = [(r["doc_id"], r["text"]) for r in both.select("doc_id", "text").limit(60).collect()]
    chain = "wonderful " * 1000 + "wonderfull " * 100 + "wonderfulll " * 5 + "wanderful " * 100 + "Çédille çédille Çedille ÇEDILLE "
    rows += [(900 + i, text) for i, text in enumerate([chain, "wonderful wonderfu", "x" * 4000 + " " + "y" * 4000, chain[:200]])]
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    found = rows_of(pg.variants(docs), *COLUMNS)
    assert found == variants_by_definition(rows)
    assert any(r[5] == "wonderful" and r[3] == "wonderfull" for r in found)  # a chain of forms


def test_variants_of_random_words(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abç") for _ in range(rng.randint(7, 9))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(40)]
    found = rows_of(pg.variants(spark.createDataFrame(rows, "doc_id long, text string")), *COLUMNS)
    expected = variants_by_definition(rows)
    assert found == expected and sum(r[2] for r in expected) > 100


def test_variants_of_nothing(spark, empty):
    assert pg.variants(empty).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "1234567 7654321"), (None, "short words only")], "doc_id long, text string")
    assert pg.variants(blank).collect() == []


def test_pivots_are_disjoint_and_rarest():
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(4, 12)))
        counts = {a + b: rng.randint(1, 9) for a in "abcd" for b in "abcd"}
        places, pivots = pg.prefix_and_pivots(word, counts)
        cost = lambda *at, w=word, c=counts: sum(c[w[i:i + 2]] for i in at)
        best = min(cost(i, j) for i, j in itertools.combinations(places, 2) if j - i >= 2)
        assert set(pivots) <= set(places) and pivots[1] - pivots[0] >= 2 and cost(*pivots) == best


# ------------------------------------------------------------------ conversation repair

def repaired_by_search(rows):
    """(cost, audit, text) of all edits of a few rows (role, text, must be deleted, truncated), by dynamic programming on whole strings."""
    best = {"": (0, "", "")}  # by the initials so far, of which only the last and the length matter: keep a state

    def state(initials):
        return "0" if not initials else initials[-1]

    def put(into, initials, value):
        if re.fullmatch("(s?(ua)*u?)?", initials) and (state(initials) not in into or value < into[state(initials)][0]):
            into[state(initials)] = (value, initials)

    now = {"0": (best[""], "")}

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for value, initials in list(out.values()):
                for role in ("user", "assistant"):
                    put(out, initials + role[0], (value[0] + 3, value[1] + "I", f"{value[2]}\n{role}:"))
        return out

    for role, text, gone, cut in rows:
        then = {}
        for value, initials in inserted(now).values():
            put(then, initials, (value[0] + 4, value[1] + "D", value[2]))
            if not gone:
                if role:
                    put(then, initials + role[0], (value[0] + 3 * cut, value[1] + "K", f"{value[2]}\n{role}:{text}"))
                for new in ("user", "assistant"):
                    put(then, initials + new[0], (value[0] + 3 + 3 * cut, value[1] + "R", f"{value[2]}\n{new}:{text}"))
        now = then
    return min(value for value, initials in inserted(now).values() if re.fullmatch("(s?(ua)+)?", initials))


def repair_by_definition(rows):
    kept = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(conv, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        turns = {r[1] for r in own} - {None}
        seen, graded, count = set(), [], Counter()
        for _, _, role, text in own:
            bare = text.rstrip(BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            count[fault] += 1
            graded.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(graded, graded[1:]))
        cost, audit, text = repaired_by_search(graded)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"],
                    count["truncated"], illegal, cost, audit, hashlib.sha256(text[1:].encode()).hexdigest()))
    return sorted(out, key=repr)


REPAIRED = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def odd_conversations():
    rng = random.Random(11)
    rows = []
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"]
    texts = ["Yes.", "No!", "cut", " \t\n", "", None, "Why?\n", "ü é.", "Yes."]
    for conv in [*range(150), None]:
        for turn in range(rng.randint(0, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 5, None]), rng.choice(roles), rng.choice(texts)))
    rows += [(500, t, rng.choice(roles), rng.choice(texts) or "x") for t in range(90)]
    rows += [(501, 3, "user", "same.")] * 30 + [(501, None, None, None)] * 5
    return rows


@pytest.mark.parametrize("segment", [4096, 3])
def test_repair_by_definition(spark, monkeypatch, segment):
    rows = odd_conversations()
    conversations = spark.createDataFrame([(*r, 1, "k") for r in rows],
                                          "conv_id long, turn long, role string, text string, seg int, kind string").repartition(3)
    if segment != cr.SEGMENT:
        monkeypatch.setattr(cr, "SEGMENT", segment)
        conversations = conversations.coalesce(1)
    found = rows_of(cr.summary(conversations, cr.damage(conversations)), *REPAIRED)
    expected = repair_by_definition(rows)
    assert found == expected
    assert any("I" in r[7] for r in expected) and any("R" in r[7] for r in expected)


def test_crossings_are_the_least_edits():
    rng = random.Random(2)
    for _ in range(400):
        kinds = bytes(rng.randrange(cr.N_KINDS) for _ in range(rng.randint(1, 6)))
        best = None
        for states in itertools.product(range(4), repeat=len(kinds)):
            path = [cr.START, *states]
            cells = [cr.EDITS[k][a][b] for k, a, b in zip(kinds, path, path[1:])]
            here = (sum(c for c, _ in cells) + 3 * cr.CLOSING[path[-1]], "".join(e for _, e in cells) + "I" * cr.CLOSING[path[-1]])
            best = here if best is None else min(best, here)
        found = cr.crossings([cr.STEP[k] for k in kinds], cr.START, [3 * cr.CLOSING[s] for s in range(4)])
        assert "".join(cr.EDITS[k][a][b][1] for k, (a, b) in zip(kinds, found, strict=True)) + "I" * cr.CLOSING[found[-1][1]] == best[1]
        # A stretch summed up is the stretch.
        whole = cr.product([cr.STEP[k] for k in kinds])
        cost = min(int(whole[0][cr.START, s]) + 3 * cr.CLOSING[s] for s in range(4))
        assert cost == best[0]


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.summary(empty, cr.damage(empty)).collect() == []
    # A conversation that the damage drops whole stays, with nothing.
    turn = next(t for t in range(200) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(7, turn, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert rows_of(cr.summary(one, cr.damage(one)), *REPAIRED) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ------------------------------------------------------------------ Jaccard join

def sets_of(rows):
    out = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append((doc_id, frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()))
    return out


def components_by_definition(rows, percent):
    sets = sets_of(rows)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, s) in enumerate(sets):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(sets)), key=repr)


def test_jaccard_join_by_definition(spark, both):
    rows = [(r["doc_id"], r["text"]) for r in both.select("doc_id", "text").collect()]
    found = rows_of(st.linked(both.withColumn("h", F.lit(1)).withColumn("bits", F.lit("b"))), "doc_id", "n_shingles", "component_id")
    assert found == components_by_definition(rows, 80)


@pytest.mark.parametrize("block", [2048, 8])
def test_join_of_near_copies_at_the_threshold(spark, monkeypatch, block):
    """One group of near copies whose similarities lie around the threshold, some of one component, some alone."""
    rng = random.Random(block)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 8])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10)}"
        rows.append((i, " ".join(words[:rng.choice([120, 118, 100])])))
    rows += [(200 + i, " ".join([*base[:60], *(f"z{i}.{j}" for j in range(60))])) for i in range(40)]
    monkeypatch.setattr(st, "BLOCK", block)
    monkeypatch.setattr(st, "LEAF", 4)
    monkeypatch.setattr(st, "ROUNDS", 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = components_by_definition(rows, 80)
    assert rows_of(st.linked(docs), "doc_id", "n_shingles", "component_id") == expected
    assert 3 < len({r[2] for r in expected}) < 120


def test_trees_lose_no_pair():
    rng = np.random.default_rng(4)
    universe = rng.integers(1, 1 << 62, 4000, dtype=np.uint64)
    sets = []
    for _ in range(40):
        base = rng.choice(universe, rng.integers(1, 200), replace=False)
        for _ in range(4):
            sets.append(np.unique(np.concatenate([base[rng.random(len(base)) > 0.07], rng.choice(universe, rng.integers(0, 6))])))
    sets = [s for s in sets if len(s)]
    sizes = np.array([len(s) for s in sets])
    roots = np.arange(len(sets))
    found = {tuple(sorted(p)) for p in st.close(sizes, [st.signature(s) for s in sets], roots, 80)}
    true = set()
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 100 * both >= 80 * (sizes[i] + sizes[j] - both):
            true.add((i, j))
    assert true and true <= found and len(found) < 4 * len(true) + 100


def test_linked_pairs_are_found_under_the_first_shared_shingle():
    """What is left of two linked sets there lets them through; where too little is left no pair is looked at."""
    rng = np.random.default_rng(9)
    roots, looked_at, meetings = np.arange(2), 0, 0
    for n in [5, 20, 90, 300] * 5:
        base = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        some = np.unique(np.concatenate([base[rng.random(len(base)) < 0.93], rng.integers(0, 1 << 62, max(n // 20, 1), dtype=np.uint64)]))
        sizes, bits = np.array([len(base), len(some)]), [st.signature(base), st.signature(some)]
        both = np.intersect1d(base, some)
        linked = 100 * len(both) >= 80 * (len(base) + len(some) - len(both))
        prefixes = [x[:st.prefix_size(len(x), 80)] for x in (base, some)]
        for turn, shingle in enumerate(np.intersect1d(*prefixes)):
            left = np.array([(x >= shingle).sum() for x in (base, some)])
            found = list(st.close(sizes, bits, roots, 80, left=left))
            assert not turn and linked <= len(found) or turn and len(found) <= (left.min() >= st.needed(*map(int, sizes), 80))
            looked_at, meetings = looked_at + len(found), meetings + 1
    assert 0 < looked_at < 0.7 * meetings


def test_join_of_nothing(spark, empty):
    assert st.linked(empty).collect() == []
    blank = spark.createDataFrame([(1, None), (2, " "), (2, " "), (None, "")], "doc_id long, text string")
    assert rows_of(st.linked(blank), "doc_id", "n_shingles", "component_id") == [(1, 0, 1), (2, 0, 2), (2, 0, 2), (None, 0, None)]


def test_shingles_of_one_set_are_not_dealt_out_and_equal_groups_are_one(spark):
    """Near copies meet in one group whatever they share; shingles of one prefix only go nowhere; every linked pair meets."""
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(30)]
    near = [t.replace(f"w{i}x200 ", "changed ") for i, t in enumerate(texts[:10])]
    docs = spark.createDataFrame(list(enumerate([*texts, *near, texts[0]])), "doc_id long, text string")
    source = docs.withColumn("t", F.xxhash64("text")).repartition(3)
    _, sets = st.sketched(source, st.Order(np.zeros(0, np.uint64)), 80)
    sets = sets.select(F.xxhash64("class").alias("id"), "n", "prefix")
    total = sets.agg(F.sum(F.size("prefix"))).first()[0]
    # Two thirds of the sets share nothing.
    assert st.entries_of(sets, 80).count() < 0.6 * total
    found = st.groups_of(sets, 80).collect()
    assert len(found) == 20 and len({r.h for r in found}) == 10 and all(r.k > 1 for r in found)
    assert sorted(rows_of(st.linked(docs), "doc_id", "component_id")) == sorted(
        [(i, i) for i in range(30)] + [(30 + i, i) for i in range(10)] + [(40, 0)])


def test_members_that_may_be_linked_stay_in_groups_of_any_size(monkeypatch):
    """Held against all pairs; of a group too large to look at its pairs none goes that has a partner."""
    rng = np.random.default_rng(5)
    for few in (64, 4):
        monkeypatch.setattr(st, "FEW", few)
        n = rng.integers(20, 60, 300)
        rows = np.stack([rng.integers(-9, 9, 300), rng.integers(-50, 50, 300), n, n - rng.integers(0, 8, 300), rng.integers(0, 2, 300)])
        rows = rows[:, np.lexsort((rows[1], rows[0]))]
        kept = set(st.meeting(rows, 80)[0].tolist())
        want = {int(i) for h, i, a, left, early in rows.T for g, j, b, rest, soon in rows.T
                if h == g and i != j and 100 * min(a, b) >= 80 * max(a, b) and min(left, rest) >= st.needed(int(a), int(b), 80)
                and (early or a > b) and (soon or b > a)}
        assert kept >= want and (few < 64 or kept == want)


def test_near_classes_are_checked_together(spark, monkeypatch):
    """Pairs of a cluster stand in one block, a cluster beyond a block is cut, and no link is lost."""
    from salesmart.llm import blocks

    sets = [(bytes([c, i]), [c * 1000 + x for x in range(i, i + 90)]) for c in range(8) for i in range(6)]
    pairs = [(bytes([c, i]), bytes([c, j])) for c in range(8) for i in range(6) for j in range(i + 1, 6)]
    frames = (spark.createDataFrame(pairs, "a binary, b binary"),
              spark.createDataFrame(sets + sets[:5], "class binary, set array<long>"))
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 6 * 90 * 8)
    place = {bytes(r["class"])[0]: r.block for r in blocks.near_blocks(*frames, 9, True).collect()}
    assert blocks.near_blocks(*frames, 9, False).where("block is null").count() == 0
    spread = blocks.near_blocks(*frames, 9, True).distinct().count()
    assert spread == 48 and len({(bytes(r["class"])[0], r.block) for r in blocks.near_blocks(*frames, 9, True).collect()}) == len(place)
    for most in (6 * 90 * 8, 90 * 8):
        monkeypatch.setattr(blocks, "BLOCK_BYTES", most)
        root = {name: name for name, _ in sets}
        for r in blocks.checked(*frames, 80).collect():
            a, b = bytes(r.a), bytes(r.b)
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
        assert len(set(root.values())) == 8
