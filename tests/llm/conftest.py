import pytest

from conftest import SF_MID, SF_SMALL  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * (3 + seed % 5) + i * i) % len(WORDS)] for i in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long_text = " ".join(sentence(i, 40) for i in range(1500))
    rows = [(i, sentence(i, 30 + i), ("en", "de", None)[i % 3], ("a", "b", None)[i % 3], None) for i in range(24)]
    rows += [(100, None, None, None, None), (101, "", "en", "a", 0), (102, " \t\n", "en", "a", 3), (103, "One", "de", "", 3),
             (104, long_text, "en", "a", len(long_text)), (105, long_text, "en", "b", len(long_text)),
             (106, "Ünïcödé ſtraße 你好   x", "de", "b", None), (107, "12 34 !!", None, "b", 8),
             (None, "no id here at all", "en", "a", 17), (None, "no id here at all", "en", "a", 17),
             (3, sentence(3, 33), "en", "a", None), (3, sentence(3, 33), "en", "a", None)]
    return [(i, t, lang, s, len(t) if t is not None and n is None else n) for i, t, lang, s, n in rows]


#: Extra columns with names that the operators use themselves.
CLASHES = ("size", "kept", "fp", "recipe", "fingerprint", "score", "ids", "bucket", "block", "body", "base", "text_sha256")


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(spark, awkward):
    from pyspark.sql import functions as F
    return awkward.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def key(row: tuple) -> tuple:
    return tuple((x is None, str(x)) for x in row)


def rows_of(df, *cols) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)
