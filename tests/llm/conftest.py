import random

import pytest

#: Column names that operators use inside, and names they put out.
CLASHING = "doc_id long, text string, source string, n_words long, __text string, __row string, shard string, size long, __hash long"


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text, source) rows with further columns whose names clash."""

    def make(rows, parts=3):
        full = [(i, t, s, 7, "x", None, "own", 3, 1) for i, t, s in rows]
        df = spark.createDataFrame(full, CLASHING)
        return df.repartition(parts) if rows else df

    return make


@pytest.fixture
def prose():
    """Texts of made-up words, the same every time."""

    def make(n, words, seed=1, vocabulary=400):
        draw = random.Random(seed)
        known = ["".join(draw.choice("abcdefghiéö") for _ in range(draw.randint(1, 9))) for _ in range(vocabulary)]
        return [" ".join(draw.choice(known) for _ in range(draw.randint(1, words))) for _ in range(n)]

    return make


@pytest.fixture
def odd():
    """Null, empty and blank texts, a repeated row, a null id, a null source, a long text and control characters."""
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    return [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n\x0b\x0c\r ", None),
        (4, "one two\x00three\x1ffour", "a"),
        (4, "one two\x00three\x1ffour", "a"),
        (None, "no id at all", "b"),
        (5, long, "b"),
        (6, "ÀÉ日本 words\nwords\nwords", "b"),
    ]
