import hashlib
import random
import struct

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesmart.llm import bpe, common, ppm_langid, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["'s", "'re", " ", "\n", "a", "b", "é", "é", "<|endoftext|>", "<|startoftext|>", "Σ", "İ", "ß", "1", "23",
          "!", "?!", "\xa0", "\x85", "the", "日本", "x" * 300, "<|endof", "\x1c"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def mixed(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 12))) for _ in range(n)]


def test_bpe_equals_library(library):
    own = bpe.load(PATH)
    for text in mixed(3000, 1):
        want = library.encode(text, add_special_tokens=False).ids
        ids, decoded = own.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, text
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_code_points_are_read_as_the_library_reads_them(library):
    """Every fifth code point, and all whose lower case Python's tables lack."""
    own = bpe.load(PATH)
    wanted = {c for c in range(1, 0x110000, 5) if not 0xD800 <= c < 0xE000} | set(own.lowered)
    texts = [f"a{chr(c)}b" for c in sorted(wanted)]
    differ = [t for t, e in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True)
              if own.encode(t)[0] != struct.pack(f"<{len(e.ids)}I", *e.ids)]
    assert differ == []


def test_long_words_merge_alike(library):
    own = bpe.load(PATH)
    for seed in range(20):
        word = "".join(random.Random(seed).choices("etaoinshrd", k=bpe.LONG_WORD * 2))
        assert own.word(word.encode()) == library.encode(word, add_special_tokens=False).ids
    assert len(own.word(b"ab" * 50_000)) > 1


def test_words_merge_side_by_side_as_alone():
    own, rng = bpe.load(PATH), random.Random(3)
    words = ["".join(rng.choices("etaoinshrdé日", k=rng.randint(1, 40))).encode() for _ in range(2000)] + [b"a", b"aaaaaaa"]
    ids, sizes = own._side_by_side(words)
    assert ids.tolist() == [i for w in words for i in own.word(w)]
    assert sizes.tolist() == [len(own.word(w)) for w in words]


def test_words_are_remembered_within_their_bound(library):
    own = bpe.Bpe(PATH, bpe.characters())
    own.encode("alpha, alpha. (alpha)")
    assert "alpha" in own.words.new
    own.pieces, own.words = bpe.Memory(20_000), bpe.Memory(20_000)
    for text in mixed(500, 4):
        for word in ("always", text):
            ids, decoded = own.encode(word)
            want = library.encode(word, add_special_tokens=False).ids
            assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, word
            assert decoded == library.decode(want, skip_special_tokens=False)
        for memory in (own.pieces, own.words):
            assert 200 * (len(memory.new) + len(memory.old)) <= 20_000
        assert b"always" in own.pieces.new or b"always" in own.pieces.old


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_at_cut_texts(name):
    path = public_tokenizers.path(name)
    tok = Tokenizer.from_file(path)
    texts = mixed(2000, 2)
    assert token_counts.counter(path)(texts) == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_sentencepiece():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = mixed(100, 3)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert token_counts.counter(path)(texts) == [len(model.encode(t)) for t in texts]


def test_queries_on_odd_rows(both, empty, library):
    rows = both.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()), ids := library.encode(
        r.text or "", add_special_tokens=False).ids, library.decode(ids, skip_special_tokens=False)) for r in rows)
    counted = token_counts.token_counts(both, PATH, limit=100).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in counted) == sorted(
        (i, n, len(ids), len(ids) > 100) for i, n, ids, _ in want)
    done = bpe.encode(both, PATH, ("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"))
    got = sorted(((str(r.doc_id), r.ids, r.n_tokens, r.ids_sha256, r.decoded, r.decoded_sha256) for r in done.collect()))
    assert got == sorted((i, ids, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), text,
                          hashlib.sha256(text.encode()).hexdigest()) for i, _, ids, text in want)
    again = bpe.decode(done.select("doc_id", "ids"), PATH).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in again) == sorted((i, text) for i, _, _, text in want)
    assert token_counts.token_counts(empty, PATH).count() == 0 == bpe.encode(empty, PATH).count()


def test_a_task_gives_memory_back_at_its_end(spark, monkeypatch):
    """Workers outlive the tasks that encode, decode or count grams; the next stage of the pipeline needs their memory."""
    given, tasks = [], []
    docs = spark.createDataFrame([(1, "one two", "en", [1])], "doc_id long, text string, lang string, ids array<int>")
    held = type(docs).mapInArrow
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: tasks.append(run) or held(self, run, schema))
    path = public_tokenizers.path("word_bpe_49k.json")
    bpe.encode(docs, path)
    bpe.decode(docs, path)
    ppm_langid.fit(docs, F.lit(True))
    assert len(tasks) == 3
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": "one two", "lang": "en", "ids": [1]}])
    for n, run in enumerate(tasks):
        running = run(iter([batch]))
        next(running)
        assert len(given) == n
        assert not list(running) and len(given) == n + 1
