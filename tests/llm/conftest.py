import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that the operators use themselves
    "_row long, _id string, _text string, size int, block string, kept string, score string, piece string"
)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def changed(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def frame(spark, rows):
    """Documents from (doc_id, text, lang, source), with columns of clashing names."""
    return spark.createDataFrame(
        [(i, t, lang, s, None, 7, "x", None, 3, "b", None, "y", "z") for i, t, lang, s in rows], SCHEMA
    )


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls, blanks, ties, repeated rows, copies, near copies, one very long text and one very long word."""
    rng = random.Random(5)
    base, long = prose(rng, 120), prose(rng, 6000, 5000)
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\x0b\n ", "en", None), (4, "one", None, "a"),
        (5, "one two", "de", "b"), (6, "One  TWO", "de", "b"), (7, "one\ntwo ", "de", "b"), (None, "one two", "en", "b"),
        (8, base, "en", "c"), (9, base, "en", "c"), (9, base, "en", "c"), (10, base.upper(), "en", "c"),
        (11, long, "fr", "d"), (12, changed(rng, long, 30), "fr", "d"), (13, "z" * 30000, None, "d"),
        (14, "Straße ÄÖ ναι 中文 text é", "de", "\U0001f600"), (15, "straße ÄÖ ναι 中文 text é", "de", "￿"),
        (16, "a a a a " * 60, "en", "c"), (17, prose(rng, 34), None, "c"), (18, prose(rng, 35), "en", "c"),
    ]
    rows += [(100 + i, changed(rng, base, i % 14), "en", "hot") for i in range(60)]
    rows += [(300 + i, prose(rng, rng.randrange(1, 200)), rng.choice(["en", "de", None]), rng.choice("abc")) for i in range(40)]
    return rows


@pytest.fixture
def messy(spark, messy_rows):
    return frame(spark, messy_rows)


@pytest.fixture
def none(spark):
    return frame(spark, [])
