"""Small inputs with the cases every operator must take: NULLs, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

COLUMNS = "doc_id bigint, text string, row string, text_key int, places string, word string, point double, score string, label string, start int, ranges string"

LONG = "long words make a long text\n" * 3000

CASES = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here"),
    (2, "The quick  brown fox jumps over the lazy dog and runs far away from here"),
    (2, "The quick  brown fox jumps over the lazy dog and runs far away from here"),
    (3, ""),
    (4, None),
    (5, " \n\t "),
    (None, "The quick brown fox jumps over the lazy dog"),
    (None, None),
    (6, LONG),
    (7, LONG),
    (8, "ÉCOLE École école 漢字 😀 tail"),
    (9, "one"),
]


def messy(spark, cases=CASES):
    rows = [(i, t, f"row{n}", n, "p", "w", 0.5, "s", "l", 3, "r") for n, (i, t) in enumerate(cases)]
    return spark.createDataFrame(rows, COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def random_texts(seed, texts, words, length, lines=False):
    """Texts over a small vocabulary, so that much repeats by chance."""
    chosen = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    made = []
    for _ in range(texts):
        body = [chosen.choice(vocabulary) for _ in range(chosen.randrange(length))]
        made.append(("\n" if lines else " ").join(body))
        if made and chosen.random() < 0.3:
            made[-1] += ("\n" if lines else " ") + chosen.choice(made)
    return made
