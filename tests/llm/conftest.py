"""Small invented tables for the corpus operators."""

from __future__ import annotations

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """docs(text, ...) -> a documents table; a text may come as (doc_id, text)."""

    def make(*texts):
        rows = []
        for i, t in enumerate(texts):
            i, t = t if isinstance(t, tuple) else (i, t)
            rows.append((i, t, "en", "s", None if t is None else len(t)))
        return spark.createDataFrame(rows, DOC)

    return make


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n) -> n invented words."""

    def make(seed, n, alphabet="abcdefghijklmnopqrst"):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(3, 9))) for _ in range(n))

    return make
