"""Frames with everything a table may hold that it should not."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, fp string, target double, row int, copy int, rule string, of_row int, t string, k int"
WORDS = "the of and river stone Green lamp été über niño 42 x".split()


def sentence(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows; more columns with names in use."""
    long = sentence(30_000, 1)
    texts = [
        (1, sentence(60, 2), "en", "a"),
        (1, sentence(60, 2), "en", "a"),
        (2, sentence(60, 2), "en", "b"),
        (3, None, "fr", "a"),
        (4, "", None, None),
        (5, " \t\n ", "de", "a"),
        (6, long, "en", "a"),
        (7, long + " end", "en", "a"),
        (None, sentence(40, 3), "es", "a"),
        (None, None, None, None),
        (8, "one", "xx", "b"),
        (9, "+" * 5000 + "@" * 5000 + "1" * 5000, "en", "c"),
        (10, "\x00\U0001f600 <|endoftext|>  ", "en", "c"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), 7, "seven", 0.5, 3, 9, "none", 4, "t", 5) for r in texts]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENTS)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)
