"""Helpers that several of the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Word separators of every contract: space, tab, line feed, vertical tab, form feed, return.
# bytes.split() without an argument cuts at exactly these six.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(taken: list[str], name: str) -> str:
    """``name``, with as many underscores before it as no column has it (names differ by more than case)."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    """A column name as part of a column expression, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def byte_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of about ``most`` bytes each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo, held = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and held + size > most:
            yield lo, i
            lo, held = i, 0
        held += int(size)
    if len(sizes) > lo:
        yield lo, len(sizes)


def give_back() -> None:
    """Gives the worker's free memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do so themselves
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """The generator, which at its end gives free memory back: workers outlive their tasks, and the next stage needs it."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def utf8(texts: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in texts.cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift), for arrays of unsigned integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
