"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut into pieces at boundaries no token crosses; each Arrow batch is worked in
slices of about equal bytes, and a piece met before in the same Python worker keeps its
length. The boundary depends on the tokenizer: where it drops white space, any run of ASCII
white space ends a piece; otherwise a piece ends before a single space between two ASCII
letters, which the usual byte-level patterns attach to the following word.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import byte_slices

SLICE_BYTES = 4 << 20
REMEMBERED_BYTES = 48 << 20  # of pieces that a worker remembers before it starts afresh
_BEFORE_SPACE = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
_COUNTERS: dict[str, Callable[[list[str]], list[int]]] = {}


def _json_counter(path: str) -> Callable[[list[str]], list[int]]:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    drops_space = not tok.encode(" \t\n ", add_special_tokens=False).ids
    known: dict[str, int] = {}
    held = 0

    def count(texts: list[str]) -> list[int]:
        nonlocal held
        if held > REMEMBERED_BYTES:  # by what the slice before has added
            known.clear()
            held = 0
        cut = [re.split(r"[\x20\x09-\x0D]+", t) if drops_space else _BEFORE_SPACE.split(t) for t in texts]
        new = list({p for ps in cut for p in ps if p not in known})
        held += sum(4 * len(p) + 150 for p in new)
        for piece, enc in zip(new, tok.encode_batch_fast(new, add_special_tokens=False), strict=True):
            known[piece] = len(enc.ids)
        return [sum(map(known.__getitem__, ps)) for ps in cut]

    return count


def _model_counter(path: str) -> Callable[[list[str]], list[int]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """The counting function of a tokenizer file, loaded once per Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = (_json_counter if path.endswith(".json") else _model_counter)(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``path`` names a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file every executor
    can read. A null or empty text has no bytes and no tokens; a null id stays null; repeated
    rows are counted each; other columns are ignored, whatever their names; an empty table
    gives no rows. A text without a safe boundary is encoded whole.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in byte_slices(texts, SLICE_BYTES):
                part = texts.slice(lo, hi - lo)
                size = pc.fill_null(pc.binary_length(part), 0)
                n = count([t or "" for t in part.to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), size.cast(pa.int64()), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    return source.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
