"""Fixtures of the corpus tests: awkward documents, and brute-force versions of the operators."""

from __future__ import annotations

import random

import pytest


def make_docs(seed: int = 3) -> list[tuple]:
    """(doc_id, text): shared passages, copies, near copies, repeats, ties, nulls, blanks, a long text."""
    rng = random.Random(seed)
    vocabulary = ["w" + "".join(rng.choices("abcdeé", k=rng.randint(1, 5))) for _ in range(400)]

    def words(n):
        return rng.choices(vocabulary, k=n)

    passage, line = words(45), words(12)
    rows = []
    for i in range(30):
        w = words(rng.randint(5, 120))
        if i % 3 == 0:
            at = rng.randrange(len(w))
            w[at:at] = passage[: rng.randint(15, 45)]
        if i % 4 == 0:
            for _ in range(3):
                at = rng.randrange(len(w))
                w[at:at] = line
        rows.append(" ".join(w))
    base = words(160)
    for _ in range(25):  # near copies
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append(" ".join(w))
    rows += [rows[0]] * 4 + [rows[33]] * 3
    rows += [None, "", "  \n\t ", "one", "one two", "One two", "a b c", "x " * 300, "ab" * 400, "\n".join([" ".join(line)] * 9)]
    rows += [" ".join(words(4000)), " ".join(words(600) + passage + passage + words(30)), "é" * 90, "ü" + "é" * 90]
    rows.append("tab\tand  two spaces " + " \n ".join(passage) + " end")
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)]


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with clashing further columns."""
    rows = [(i, t, "en", i % 3, float(i), "x") for i, t in make_docs()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source int, kept double, row string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
