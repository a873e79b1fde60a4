"""Small tables for the operators on text."""

from __future__ import annotations

import random

import pytest

WORDS = [a + b + c for a in ("ka", "lo", "mi", "su") for b in ("ren", "tol", "vas", "dip") for c in ("", "er", "um", "ik")]


@pytest.fixture(scope="session")
def prose():
    """Random words, the same for the same seed."""

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with the given texts; ``keep_id``, ``n_rows`` and others clash with internal names."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "x", 5, "row", b"k") for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, id string, keep_id int, row string, text_key binary"
        )

    return make
