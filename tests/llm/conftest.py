"""Small documents for the operators of training data."""

from __future__ import annotations

import random

import pytest

WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) rows: copies, near copies, shared passages, repeated lines, null, empty and long texts."""
    rng = random.Random(7)

    def prose(n: int) -> list[str]:
        return [rng.choice(WORDS) for _ in range(n)]

    passage, rows = prose(40), []
    for i in range(60):
        words = prose(rng.choice([3, 12, 13, 14, 60, 200]))
        if i % 5 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        breaks = [rng.choice([" ", "  ", "\n", "\t"]) for _ in words]
        rows.append((i, "".join(w + b for w, b in zip(words, breaks))))
    long = prose(150_000)
    rows += [(60, rows[3][1]), (61, rows[3][1].replace(" ", "  ")), (62, rows[5][1] + " w1 w2"), (63, None), (64, ""), (65, " \n ")]
    rows += [(66, " ".join(long)), (67, " ".join(long[:-1])), (68, rows[7][1]), (69, "é Ünï ÀÉ straße Σίγμα <|endoftext|> don't 12.5%"), (70, rows[62][1])]
    rows += [(71, rows[5][1]), (71, rows[5][1])]  # a repeated row
    return rows


@pytest.fixture
def docs(spark, corpus):
    """The corpus with columns whose names the operators use themselves."""
    rows = [(i, t, "x", 1, None) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, n int, digest string").repartition(5)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")
