"""Fixtures shared by the operators' tests: awkward rows, and texts with planted structure."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, shard string, spans string"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary):x}q" for _ in range(n)]


def corpus(seed: int = 5, n: int = 60) -> list[tuple[int, str]]:
    """Clean texts, exact copies, near copies, a shared passage, and short texts."""
    rng, rows = random.Random(seed), []
    shared = " ".join(words(rng, 60, 5000))
    for i in range(n):
        w = words(rng, rng.randrange(60, 200), 5000)
        if i % 6 == 1:
            w = rows[-1][1].split(" ")
        elif i % 6 == 2:
            w = rows[-1][1].split(" ")
            w[rng.randrange(len(w))] = "changed"
        elif i % 6 == 4:
            w[10:10] = shared.split(" ")
        rows.append((i, " ".join(w)))
    return rows


def awkward(spark, rows=()):
    """Rows with nulls in every column, empty and repeated rows, a very long text, and columns whose
    names clash with results."""
    long = " ".join(f"long{i % 977}" for i in range(30_000))
    base = [(9001, None), (9002, ""), (9002, ""), (None, None), (None, "one two three four five six seven"), (9003, " \n\t "),
            (9004, "é ü ß 漢字 😀 end"), (9005, long), (9005, long), (9006, "a b c")]
    out = [(i, t, None if i is None else "en", None if i in (None, 9004) else "s", None, "x", None, "y", "z") for i, t in [*rows, *base]]
    return spark.createDataFrame(out, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
