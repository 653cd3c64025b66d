import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import brown_lm, ppm_langid
from salesmart.llm.common import crc_mod


def ppm_bits(trees, order, text):
    """Code length by the definition: escapes with exclusion from the longest seen context down."""
    bits = 0.0
    for i, byte in enumerate(text):
        done, found = set(), False
        for k in range(min(order, i), -1, -1):
            counts = {s: n for s, n in trees.get(text[i - k : i], {}).items() if s not in done}
            total, kinds = sum(counts.values()), len(counts)
            if byte in counts:
                bits += math.log2((total + kinds) / counts[byte])
                found = True
                break
            if kinds:
                bits += math.log2((total + kinds) / kinds)
            done |= set(counts)
        if not found:
            bits += math.log2(max(256 - len(done), 1))
    return bits


@pytest.mark.parametrize("order", [1, 3])
def test_ppm_code_lengths(spark, both, order):
    docs = both.where(F.length("text") < 3000)
    model = ppm_langid.fit(docs, F.lit(True), order=order, sample_bytes=1 << 30)
    trees = {}
    for row in docs.where("text is not null and lang is not null").select("text", "lang").collect():
        data = row.text.encode()
        for i, byte in enumerate(data):
            for k in range(min(order, i) + 1):
                trees.setdefault(row.lang, {}).setdefault(data[i - k : i], Counter())[byte] += 1
    table = ppm_langid.Table(model, 1 << 28)
    texts = [(r.text or "").encode()[:200] for r in docs.limit(30).collect()] + [bytes(range(256)), b"", b"q"]
    got = table.bits(texts)
    want = [[ppm_bits(trees[lang], order, t) for lang in model.langs] for t in texts]
    assert np.allclose(got, want, rtol=1e-5, atol=1e-4)


def test_ppm_held_out_and_odd_rows(spark, both, empty):
    held = crc_mod(F.col("doc_id"), 3) == 1
    model = ppm_langid.fit(both, ~held, sample_bytes=100_000)
    got = ppm_langid.predict(both, model).withColumn("held", crc_mod(F.col("doc_id"), 3) == 1)
    rows = got.collect()
    assert len(rows) == both.count()
    truth = {r.doc_id: r.lang for r in both.where("doc_id >= 100").collect()}
    judged = [r.lang_pred == truth[r.doc_id] for r in rows if r.doc_id in truth and r.held]
    assert sum(judged) >= 0.95 * len(judged)
    by_id = {r.doc_id: r for r in rows}
    for i in (0, 1, 2, 14):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in rows)
    assert ppm_langid.predict(empty, model).count() == 0
    nothing = ppm_langid.fit(empty, F.lit(True))
    assert {r.lang_pred for r in ppm_langid.predict(both, nothing).collect()} == {"und"}
    kept = ppm_langid.keep_identified(both, model)
    assert kept.columns == both.columns and {0, 1, 2, 14}.isdisjoint(r.doc_id for r in kept.collect())


def test_sample_is_bounded(both):
    model = ppm_langid.fit(both, F.lit(True), order=0, sample_bytes=2000)
    longest = both.agg(F.max(F.octet_length("text"))).first()[0]
    assert all(model.grams[i, 0][1].sum() <= 2000 + longest for i in range(len(model.langs)))


def test_class_model(both, empty):
    held = crc_mod(F.col("doc_id"), 7) == 2
    model = brown_lm.fit(both, ~held, classes=8, rounds=6)
    rows = brown_lm.score(both, model).collect()
    texts = [((r.text or "").encode().lower().split(), r.doc_id) for r in both.collect()]
    seen = Counter()
    for words, i in texts:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            seen.update(words)
            seen["end"] += 1
    n, v = sum(seen.values()), len(seen)
    want = sorted((str(i), len(w) + 1, sum(seen[x] > 0 for x in [*w, "end"]),
                   round(sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in [*w, "end"]), 5)) for w, i in texts)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {n} and model.types == v
    # The class model is a distribution and beats the base on held-out text.
    assert np.allclose((10.0 ** model.transition).sum(1), 1)
    assert brown_lm.score(empty, model).count() == 0
    out = [r for r in rows if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 == 2]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    blank = brown_lm.fit(empty, F.lit(True), classes=4, rounds=1)
    assert {r.n_known for r in brown_lm.score(both, blank).collect()} == {0}


def test_class_model_by_definition(spark):
    texts = ["a b a b c", "b a", "c c a", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = brown_lm.fit(docs, F.lit(True), classes=2, rounds=4)
    counts = Counter(w for t in texts for w in (t or "").split())
    units = model.units
    unit_of = {w: int(units.of(*[x[:1] for x in brown_lm.words([w.encode()])[:2]])[0]) for w in "abc"}
    cls = {w: int(model.classes[u]) for w, u in unit_of.items()}
    for row in brown_lm.score(docs, model).collect():
        before, want = 2, 0.0
        for w in (texts[row.doc_id] or "").split():
            want += model.transition[before, cls[w]] + math.log10(counts[w] + 1) - model.emission[cls[w]]
            before = cls[w]
        want += model.transition[before, 2] + math.log10(4 + 1) - model.emission[2]
        assert row.score == pytest.approx(want)
    for c in (0, 1):
        members = [w for w in "abc" if cls[w] == c]
        assert 10 ** model.emission[c] == pytest.approx(sum(counts[w] for w in members) + len(members) + 1)


def test_class_model_has_one_rule_for_every_size(spark):
    """A corpus and its repetitions have the same units and the same classes."""
    texts = ["a b a b c once", "b a", "c c a twice twice", ""]
    one = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    models = [brown_lm.fit(spark.createDataFrame(list(enumerate(texts * n)), one.schema), F.lit(True), classes=3, rounds=4)
              for n in (1, 5)]
    assert len(models[0].units.hashes) == 5
    assert np.array_equal(models[0].units.hashes, models[1].units.hashes)
    assert np.array_equal(models[0].classes, models[1].classes)


def test_exchange_gain_is_exact_without_self_pairs():
    rng = np.random.default_rng(5)
    pairs = rng.integers(1, 50, (4, 4)).astype(float)
    after = np.array([[0, 3.0, 2, 1]])
    before = np.array([[0, 2.0, 3, 1]])
    pairs[0] += after[0]
    pairs[:, 0] += before[0]
    best = brown_lm.best_classes(after, before, np.array([0]), pairs)[0]
    found = []
    for to in range(3):
        moved = pairs.copy()
        moved[0] -= after[0]
        moved[:, 0] -= before[0]
        moved[to] += after[0]
        moved[:, to] += before[0]
        found.append(brown_lm.likelihood(moved))
    assert found[best] >= found[0] and abs(max(found) - found[best]) < 3


def test_ppm_order_holds_whatever_the_memory(spark, both):
    docs = both.where(F.length("text") < 3000)
    model = ppm_langid.fit(docs, F.lit(True), sample_bytes=1 << 30)
    texts = [(r.text or "").encode()[:200] for r in docs.limit(30).collect()] + [bytes(range(256)), b"", b"q"]
    want = ppm_langid.Table(model, 1 << 28).bits(texts)
    for most in (0, 1 << 10, 1 << 16):
        table = ppm_langid.Table(model, most)
        assert np.array_equal(table.bits(texts), want) and np.array_equal(table.bits(texts[::-1]), want[::-1])
        assert table.order == 3 and table.lengths.nbytes <= most


def test_sample_holds_languages_of_few_long_documents(spark, monkeypatch):
    rows = [(i, text, lang) for lang in "abcdefgh" for i, text in enumerate([lang * 300_000 + lang.upper()] + [lang * 20] * 4)]
    rows += [(i, "z" * 10 + str(i), "many") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).cache()
    sizes = Counter()
    for _, text, lang in rows:
        sizes[lang] += len(text)
    models = []
    for slice_bytes in (1 << 20, 1000):  # a long text is counted in pieces
        monkeypatch.setattr(ppm_langid, "SLICE_BYTES", slice_bytes)
        models.append(ppm_langid.fit(docs, F.lit(True), order=1, sample_bytes=10_000))
    first, second = models
    assert first.langs == (*"abcdefgh", "many")
    got = [first.grams[i, 0][1].sum() for i in range(9)]
    assert all(n >= min(10_000, sizes[lang]) for n, lang in zip(got, first.langs)) and got[8] < 10_020
    assert all(np.array_equal(x, y) for key in first.grams for x, y in zip(first.grams[key], second.grams[key]))
