from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Awkward rows: null and empty texts, null ids, repeated rows, ties, words and lines that repeat.
AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b ", "en", "a", 5),
    (4, "one", "en", "a", 3),
    (5, "One", "en", "b", 3),
    (6, "one two", "en", "b", 7),
    (7, "the quick brown fox jumps over the lazy dog and the cat", "en", "b", 50),
    (7, "the quick brown fox jumps over the lazy dog and the cat", "en", "b", 50),
    (8, "THE QUICK brown fox jumps over the lazy dog and the cat", None, None, 50),
    (None, "the quick brown fox jumps over the lazy dog and the cat", "en", "b", 50),
    (None, None, None, None, None),
    (9, "1234 5678 !!! ###", None, "c", 17),
    (10, "漢字 é 😀 ñandú x y", "xx", "c", 12),
    (11, "a b c d e a b c d e f\n\nsame line\nsame line\n same line\nsame line", "en", "c", 60),
    (12, "Released under the MIT License. Licensed under the Apache License, Version 2.0.", "en", "a", 80),
    (13, "Licensed under CC BY-NC 4.0 Permission apache license version 2 gnu general public license version 3", "en", "a", 99),
    (14, "card 4532015112830366 not 4532015112830367 ip 10.0.0.1 day 2020-02-29 not 2021-02-29", "en", "a", 80),
]

CLASHES = ("size", "fp", "found", "part", "token", "keys", "node", "copy", "row", "c0", "TEXT", "Doc_Id")


def near_copies() -> list[tuple]:
    """Texts of which some differ in few words, and a large group of near copies."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    out, number = [], 100

    def put(words: list[str]) -> None:
        nonlocal number
        out.append((number, " ".join(words), "en", f"s{number % 3}", 1))
        number += 1

    for length in [3, 8, 9, 10, 11, 12, 13, 14, 20, 31, 32, 47, 48, 49, 60, 100, 150, 400]:
        for _ in range(3):
            base = [word() for _ in range(length)]
            put(base)
            put(base)
            for edits in range(1, 4):
                some = list(base)
                for _ in range(edits):
                    some[rng.randrange(length)] = word()
                put(some)
                put(base + [word() for _ in range(edits)])
                put(base[: max(1, length - edits)])
    shared = [word() for _ in range(120)]
    for _ in range(260):
        some = list(shared)
        for _ in range(rng.randrange(5)):
            some[rng.randrange(len(some))] = word()
        put(some)
    passage = [word() for _ in range(40)]
    for _ in range(40):
        put([word() for _ in range(60)] + passage)
    return out


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashes: bool = True):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        if not clashes:
            return df
        return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHES)])

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD)


@pytest.fixture(scope="session")
def no_rows(make_docs):
    return make_docs([])
