"""The corpus pipeline: every stage on its own input against brute force, odd rows and odd column names."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from salesmart.llm import fm_dedup, odd_sketch, ppm_langid, simhash_decontam

from .conftest import passage
from .test_variants import components_by_definition

SF = "/root/testdata/sf0.001"
VOCABULARY = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's name, input and output, as ``run`` chains them; sf0.001 with every tenth row twice."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 10 = 0")).cache()
    out = []
    for name, stage in cp.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((name, docs, after))
        docs = after
    return out


def _as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_in_order(stages):
    assert [n for n, _, _ in stages] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "encoding"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.schema.simpleString() == before.schema.simpleString()


def test_language_stage(stages):
    _, before, after = stages[0]
    model = ppm_langid.fit(before, F.lit(True))
    judged = ppm_langid.predict(before, model).where("lang_pred <> 'und' and score >= 0.3")
    assert sorted(r.doc_id for r in judged.collect()) == sorted(r.doc_id for r in after.collect())
    assert set(map(tuple, after.collect())) <= set(map(tuple, before.collect())) and 150 < after.count()


def test_near_duplicate_stage(stages):
    _, before, after = stages[1]
    rows = sorted({(r.doc_id, r.text) for r in before.collect()})
    kept = [d for d, n, c in components_by_definition(rows, 75) if d == c or not n]
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)  # also one of the rows that are there twice
    assert after.count() < len(rows) < before.count()


def test_substring_stage(stages):
    _, before, after = stages[2]
    texts = {r.doc_id: re.split(r"[\x20\x09-\x0D]+", r.text.strip(" \t\n\x0b\x0c\r")) for r in before.collect()}
    first = {}
    for d in sorted(texts):
        for i in range(len(texts[d]) - 12):
            first.setdefault(tuple(texts[d][i:i + 13]), d)
    cut = 0
    for r in after.collect():
        words = texts[r.doc_id]
        gone = {j for i in range(len(words) - 12) if first[tuple(words[i:i + 13])] < r.doc_id for j in range(i, i + 13)}
        cut += bool(gone)
        if gone:
            assert r.text == " ".join(w for j, w in enumerate(words) if j not in gone)
        assert r.n_chars == len(r.text)
    assert cut and after.count() == before.count()


def test_decontamination_stage(spark, stages):
    _, before, after = stages[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return words, [tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 0))]

    bad = set()
    known = [(len(w), set(s), s) for w, s in map(shingles, (t for _, t in items)) if len(w) >= 5]
    for r in before.collect():
        words, own = shingles(r.text)
        for n, item, _ in known:
            if not item & set(own):
                continue
            for start in range(max(len(words) - n, 0) + 1):
                window = set(own[start:start + n - 4])
                if window and 100 * len(window & item) >= 75 * len(window | item):
                    bad.add(r.doc_id)
    kept = {r.doc_id for r in after.collect()}
    assert {r.doc_id for r in before.collect()} - kept == bad and bad


def test_encoding_stage(stages):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    tok.no_truncation()
    tok.no_padding()
    _, before, after = stages[4]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert after.count() == before.count()


def test_run_is_the_chain_of_stages(spark, stages, tmp_path):
    stages[0][1].write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert _as_rows(cp.run(spark, str(tmp_path))) == _as_rows(stages[-1][2])


ODD = ["__bad", "__id", "__t", "my col", "a-b", "judged", "row", "place", "block", "class", "d.x", "q`t", "kept_text"]


def test_odd_columns_and_rows(spark, tmp_path):
    """Columns of clashing and odd names, nulls everywhere, rows three times over, a very long text."""
    long = " ".join(passage(s, 90) for s in range(1, 200))
    rows = [(1, passage(1, 60), "en"), (2, passage(1, 60), "en"), (3, passage(2, 60), "en"), (3, passage(2, 60), "en"),
            (3, passage(2, 60), "en"), (4, None, None), (5, "", "en"), (6, "...", None), (None, passage(3, 40), "en"),
            (None, passage(3, 40), "en"), (7, long, "en"), (8, long + " tail", "en"), (9, passage(2, 30) + " other " + passage(5, 30), "en")]
    docs = spark.createDataFrame([(i, t, lang, "web", len(t or "")) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *(F.lit(n).alias(c) for n, c in enumerate(ODD)))
    docs = docs.withColumn("nested", F.struct(F.lit(1).alias("a-b"), F.lit("x").alias("my col")))
    spark.createDataFrame([(1, passage(777, 30)), (None, None), (2, "")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    counts = []
    for _, stage in cp.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        docs = after.cache()
        counts.append(sorted((r.doc_id for r in docs.collect()), key=repr))
    assert counts[0] == [1, 2, 3, 3, 3, 7, 8, 9, None, None]
    assert counts[1] == counts[2] == counts[3] == [1, 3, 7, 9, None]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert texts[3] == passage(2, 60) and texts[9] == "other " + passage(5, 30)
    assert cp.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 5


def test_cut_of_passages_by_definition(spark, tmp_path):
    """Words in 13-word windows that a document with a smaller id has too go; judged by brute force on the rows of the test above."""
    long = " ".join(passage(s, 90) for s in range(1, 200))
    rows = [(1, passage(1, 60)), (3, passage(2, 60)), (7, long), (9, passage(2, 30) + " other " + passage(5, 30))]
    seen, want = set(), {}
    for doc_id, text in rows:
        words = text.split()
        windows = [tuple(words[i : i + 13]) for i in range(len(words) - 12)]
        gone = {k for i, w in enumerate(windows) if w in seen for k in range(i, i + 13)}
        want[doc_id] = " ".join(w for k, w in enumerate(words) if k not in gone)
        seen |= set(windows)
    docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in cp.substring_dedup(spark, docs, str(tmp_path)).collect()}
    assert got == want and got[9] == "other"


def test_empty_table(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_queries_without_sql_are_tested_by_brute_force():
    """What has no SQL is named here, with the tests that hold it against its definition."""
    from salesmart.llm.queries import ORACLE, QUERIES
    assert set(QUERIES) - set(ORACLE) == {"op1_brown_lm", "op2_language_id", "op3_token_counts", "op4_main_text",
                                          "op7_quality_rules", "op9_decontamination", "op10_bpe"}


def test_general_interfaces_take_odd_columns(spark):
    docs = spark.createDataFrame([(1, passage(1, 30), 1), (1, passage(1, 30), 2), (2, passage(1, 30), 3)], "id long, `the text` string, `a-b` int")
    assert odd_sketch.without_duplicates(docs, id_col="id", text_col="the text").count() == 1
    assert simhash_decontam.clean(docs, spark.createDataFrame([(1, passage(7, 20))], "item_id long, text string"),
                                  id_col="id", text_col="the text").count() == 3
    cut = fm_dedup.remove_repeated_words(docs, id_col="id", text_col="the text", carry=True)
    assert sorted(r.row["a-b"] for r in cut.collect()) == [1, 2, 3]
