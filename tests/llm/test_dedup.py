import hashlib
import random

import numpy as np
import pytest

from salesmart.llm import fm_dedup, odd_sketch, repeats, suffix_dedup, wordhash
from salesmart.llm.fm_dedup import BitRank, FmIndex, WordMatcher
from salesmart.llm.suffix_dedup import COVER, PERIOD, SHIFT, ByteMatcher

from .conftest import passage


def least_by_definition(segments, docs, window, cut):
    parts = [s.split(b" ") if cut else s for s in segments]
    at = lambda s, i: tuple(s[i : i + window])
    best = {}
    for s, d in zip(parts, docs):
        for i in range(len(s) - window + 1):
            best[at(s, i)] = min(best.get(at(s, i), 1 << 60), d)
    return [[best[at(s, i)] for i in range(len(s) - window + 1)] for s in parts]


@pytest.mark.parametrize("lower", [True, False])
def test_words_are_hashed_in_slices(monkeypatch, lower):
    """A block of many texts takes no more memory for powers than a slice, and a word has one hash wherever it stands."""
    texts = [passage(s, 90).encode() for s in range(400)] + [b"", b" ", b"One " + b"x" * 3000 + b" one"]
    whole = wordhash.hash_words(texts, lower)
    monkeypatch.setattr(wordhash, "_powers", {})
    monkeypatch.setattr(wordhash, "SLICE_BYTES", 1000)
    for a, b in zip(whole, wordhash.hash_words(texts, lower), strict=True):
        assert np.array_equal(a, b)
    assert max(map(len, wordhash._powers.values())) <= 4096
    words = b" ".join(texts).lower().split() if lower else b" ".join(texts).split()
    assert len(set(zip(words, whole[0].tolist()))) == len(set(words)) == len(set(whole[0].tolist()))


def test_cover_has_a_shift_for_every_pair():
    for a in range(PERIOD):
        for b in range(PERIOD):
            assert {(a + SHIFT[a, b]) % PERIOD, (b + SHIFT[a, b]) % PERIOD} <= set(COVER)


@pytest.mark.parametrize("seed", range(8))
def test_matchers(seed, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", 100)
    rng = random.Random(seed)
    base = bytes(rng.choices(b"ab" if seed % 2 else b"abcdefgh ", k=400))
    cuts = [(a, rng.randint(50, 200)) for a in rng.choices(range(200), k=60)]
    segments = [*{base[a : a + n] for a, n in cuts}, b"a" * 300, bytes(range(60))]
    docs = np.array([rng.randint(0, 50) for _ in segments])
    got = ByteMatcher().least(segments, docs)
    assert [list(map(int, g)) for g in got] == least_by_definition(segments, docs, 50, False)
    words = [b"x%d" % rng.randint(0, 3 if seed % 2 else 40) for _ in range(300)]
    segments = [*{b" ".join(words[a : a + n // 5 + 13]) for a, n in cuts}, b" ".join([b"q"] * 50)]
    docs = np.array([rng.randint(0, 50) for _ in segments])
    got = WordMatcher().least(segments, docs)
    assert [list(map(int, g)) for g in got] == least_by_definition(segments, docs, 13, True)


def test_fm_index_counts():
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(1, 5, 500), 0)
    index = FmIndex(text, 5)
    for n in (1, 3, 8):
        for at in (0, 50, 400):
            pattern = text[at : at + n]
            low, high = np.array([0]), np.array([len(text)])
            for symbol in pattern[::-1]:
                low, high = index.extend(np.array([symbol]), low, high)
            want = sum((text[i : i + n] == pattern).all() for i in range(len(text) - n + 1))
            assert high[0] - low[0] == want
    bits = rng.integers(0, 2, 1000).astype(bool)
    assert (BitRank(bits).ones(np.arange(1001)) == np.append(0, np.cumsum(bits))).all()


def removed(rows, window, cut):
    """(id, removed, spans, digest) by the definition: windows of smaller ids, rows without an id apart."""
    parts = sorted(((r.doc_id, (r.text or "").encode()) for r in rows if r.doc_id is not None), key=lambda x: x[0])
    first, out = {}, []
    split = lambda t: t.split() if cut else t
    for i, t in parts:
        u = split(t)
        for j in range(len(u) - window + 1):
            first.setdefault(tuple(u[j : j + window]), i)
    for i, t in [*parts, *((None, (r.text or "").encode()) for r in rows if r.doc_id is None)]:
        u, gone = split(t), set()
        for j in range(len(u) - window + 1):
            if i is not None and first[tuple(u[j : j + window])] < i:
                gone.update(range(j, j + window))
        kept = [x for j, x in enumerate(u) if j not in gone]
        kept = b" ".join(kept) if cut else bytes(kept)
        spans = sum(j - 1 not in gone for j in gone)
        out.append((str(i), len(u), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_substring_queries(both, empty, monkeypatch):
    rows = both.collect()
    for size in (1 << 14, 1 << 22):  # many blocks and one
        monkeypatch.setattr(repeats.covered_by_earlier, "__defaults__", (size,))
        got = suffix_dedup.remove_repeated_bytes(both).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == removed(
            rows, 50, False)
        got = fm_dedup.remove_repeated_words(both).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, len(r.spans), r.kept_sha256) for r in got) == removed(
            rows, 13, True)
    carried = fm_dedup.remove_repeated_words(both, carry=True).collect()
    assert sorted(str(r.row.doc_id) + r.row.kept if r.row.kept else str(r.row.doc_id) for r in carried) == sorted(
        str(r.doc_id) + r.kept if r.kept else str(r.doc_id) for r in rows)
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0 == fm_dedup.remove_repeated_words(empty).count()


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset([tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words))


def near_by_definition(rows):
    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for a, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(a)] = min(least.get(find(a), r.doc_id), r.doc_id)
    out = []
    for a, r in enumerate(rows):
        component = least.get(find(a)) if sets[a] else r.doc_id
        out.append((str(r.doc_id), len(sets[a]), str(component), r.doc_id == component))
    return sorted(out)


def test_near_duplicates(both, empty):
    rows = both.collect()
    got = odd_sketch.near_duplicates(both).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == near_by_definition(rows)
    kept = odd_sketch.without_duplicates(both)
    assert kept.columns == both.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert odd_sketch.near_duplicates(empty).count() == 0


def test_chains_and_blocks_of_a_bucket(spark, monkeypatch):
    """A chain whose ends are unlike is one component, also when a bucket is cut into many blocks."""
    monkeypatch.setattr(odd_sketch, "BLOCK", 3)
    rng = random.Random(4)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    rows = []
    for i in range(30):
        words = words[6:] + [f"w{rng.randint(0, 10**6)}" for _ in range(6)]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in odd_sketch.near_duplicates(docs).collect()}
    assert set(got.values()) == {0}


@pytest.mark.parametrize("k", [odd_sketch.SAMPLES, odd_sketch.SHARP])
def test_odd_sketch_estimates(k):
    rng = np.random.default_rng(1)
    base = rng.integers(1, 1 << 62, (200, k)).astype(np.uint64)
    other = base.copy()
    changed = rng.random(base.shape) < 0.25
    other[changed] = rng.integers(1, 1 << 62, int(changed.sum())).astype(np.uint64)
    folded = [odd_sketch.fold(x).view(np.uint64) for x in (base, other)]
    d = np.bitwise_count(folded[0] ^ folded[1]).sum(1, dtype=np.int64)
    n = k * odd_sketch.BITS_PER_SAMPLE
    estimate = 1 + n / (4 * k) * np.log(1 - 2 * d / n)
    assert abs(estimate.mean() - 0.75) < 0.02
    assert (d <= odd_sketch.most_different(0.75, k)).all()


@pytest.mark.parametrize("few", [0, 1000])
def test_components(spark, few):
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(0, 60) if i % 20 != 19] + [("n005", "n005")]
    pairs = spark.createDataFrame(edges, "a string, b string")
    got = {r.node: r.root for r in odd_sketch.components(pairs, "test-components", few).collect()}
    assert got == {f"n{i:03}": f"n{i // 20 * 20:03}" for i in range(60)}
    assert odd_sketch.components(pairs.limit(0), "test-none", few).count() == 0


def test_spanning_forest_takes_the_most_similar():
    d = np.array([5, 1, 3, 2, 9, 1])
    x, y = np.array([0, 1, 0, 3, 2, 1]), np.array([1, 2, 2, 4, 3, 2])
    kept = odd_sketch.spanning(d, x, y)
    assert sorted(zip(d[kept], x[kept], y[kept])) == [(1, 1, 2), (2, 3, 4), (3, 0, 2), (9, 2, 3)]


@pytest.mark.parametrize("cut", [False, True])
def test_passage_in_every_document_sends_no_edges(spark, monkeypatch, cut):
    shared = passage(1, 60)
    rows = [(i, " ".join([*(f"w{i}x{j}" for j in range(30)), shared, *(f"v{i}x{j}" for j in range(30))]))
            for i in range(150)]
    rows += [(200, None), (None, shared), (201, passage(2, 20)), (202, passage(2, 20)), (203, shared[3:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    module, kind = (fm_dedup, "WordMatcher") if cut else (suffix_dedup, "ByteMatcher")

    class Few(getattr(module, kind)):
        def least(self, segments, owners):
            assert len(segments) < 100, len(segments)
            return super().least(segments, owners)

    monkeypatch.setattr(module, kind, Few)
    monkeypatch.setattr(repeats.covered_by_earlier, "__defaults__", (1 << 10,))
    if cut:
        got = fm_dedup.remove_repeated_words(docs).collect()
        found = [(str(r.doc_id), r.n_words, r.n_removed, len(r.spans), r.kept_sha256) for r in got]
    else:
        got = suffix_dedup.remove_repeated_bytes(docs).collect()
        found = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(found) == removed(docs.collect(), 13 if cut else 50, cut)
