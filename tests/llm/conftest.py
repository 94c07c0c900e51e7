import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use themselves.
    "component_id string, kept string, digest string, size string, target string, ids string, "
    "hash string, node string, count string"
)
EXTRA = ("x",) * 9


def make_docs(spark, rows):
    """Documents of (doc_id, text, lang, source), with extra columns whose names clash."""
    data = [(*row, None if row[1] is None else len(row[1]), *EXTRA) for row in rows]
    return spark.createDataFrame(data, SCHEMA)


def words(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 6))) for _ in range(n))


def changed(text, seed, places):
    """The text with single words replaced, far apart."""
    parts = text.split(" ")
    for k in range(places):
        parts[(2 * k + 1) * len(parts) // (2 * places)] = f"new{seed}x{k}"
    return " ".join(parts)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    base = words(1, 300)
    long = words(2, 60_000)
    return [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, changed(base, 3, 2), "en", "b"),
        (4, None, "en", "b"),
        (5, "", None, None),
        (6, "   \n\t ", "de", "c"),
        (7, "One two three", "de", "c"),
        (8, "one TWO  three", "fr", None),
        (9, long, "fr", "a"),
        (10, long + " end", "fr", "a"),
        (11, words(3, 500), None, "b"),
        (11, words(3, 500), None, "b"),
        (12, "wörd x  ﬁ é́ <|endoftext|> Ünï", "es", "ü"),
        (None, base, "es", "ü"),
        (None, None, None, None),
        (13, "1234 5678 %%%", "es", "c"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return make_docs(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
