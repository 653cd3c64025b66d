import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, t long, block int, h1 string, kept string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def passage(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * (seed % 5 + 1) + i * seed) % len(WORDS)] + str(i * seed % 11) for i in range(n))


def odd_rows() -> list[tuple]:
    """Nulls everywhere, empty and blank texts, ties, repeated rows, a very long text and a text without blanks."""
    long = " ".join(passage(s, 90) for s in range(1, 40))
    rows = [
        (0, None, "en"), (1, "", "en"), (2, " \t\n\x0b\x0c\r ", None), (3, "One", "en"), (4, "one", None),
        (5, passage(1, 60), "en"), (6, passage(1, 60).upper(), "en"), (7, passage(1, 60), "en"), (7, passage(1, 60), "en"),
        (8, passage(1, 58) + " changed ending", "de"), (9, passage(2, 80), "de"), (10, "x" * 30_000, "de"),
        (11, long, "en"), (12, long + " and a tail", "en"), (None, passage(1, 60), "en"), (None, None, None),
        (13, "é ü 日本 ﬁ İΣ 12 3 <|endoftext|> \x85\xa0end", "fr"), (14, "...", "fr"), (15, "a b c d e", "fr"),
        (16, "a b c d e", None), (17, "line\nline\nother\n\nline", "fr"), (18, passage(3, 20) + "\n" + passage(1, 30), "en"),
        (19, " ".join(["same"] * 500), "en"), (20, passage(4, 13), "de"), (21, passage(5, 9) + " " + passage(4, 13), "de")]
    return [(i, text, lang, None, None, 1, 2, "h", "k") for i, text, lang in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def both(odd, small):
    """The odd rows with ordinary documents."""
    more = small.select((F.col("doc_id") + 100).alias("doc_id"), "text", "lang", "source", "n_chars",
                        F.lit(1).cast("long").alias("t"), F.lit(2).alias("block"), F.lit("h").alias("h1"),
                        F.lit("k").alias("kept"))
    return odd.unionByName(more).cache()
