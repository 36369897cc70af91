import random

import numpy as np
import pytest
from messy import LONG, empty, messy

from cityloom.llm import periodic


def slow(words, least=12):
    """Runs by comparing every word with that a period before it, and the words that stay."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        at = period
        while at < len(words):
            begin = at
            while at < len(words) and words[at] == words[at - period]:
                at += 1
            length = at - begin + period
            if length >= max(least, 2 * period):
                found.setdefault((begin - period, length), period)
            at += at == begin
    runs = sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return runs, " ".join(word for i, word in enumerate(words) if i not in gone)


def made(chosen):
    kinds, size = chosen.choice([1, 2, 2, 3, 5, 50]), chosen.choice([0, 1, 11, 12, 13, 30, 100, 300])
    words = [f"w{chosen.randrange(kinds)}é" for _ in range(size)]
    if words and chosen.random() < 0.6:
        begin, period = chosen.randrange(size), chosen.randrange(1, size + 1)
        words = [*words[:begin], *(words[begin + (i - begin) % min(period, size - begin)] for i in range(begin, size))]
    return " ".join(words)


@pytest.mark.parametrize(("tabled", "extended"), [(1 << 12, 1 << 20), (16, 1 << 20), (16, 7), (1 << 12, 7)])
def test_runs_equal_those_found_by_comparing_all_words(monkeypatch, tabled, extended):
    monkeypatch.setattr(periodic, "TABLED", tabled)
    monkeypatch.setattr(periodic, "EXTENDED", extended)
    monkeypatch.setattr(periodic, "_TABLE", [])
    chosen = random.Random(extended + tabled)
    texts = [made(chosen) for _ in range(120)]
    rows = periodic._arrays(periodic.pa.array(texts), 12).to_pylist()
    for text, row in zip(texts, rows, strict=True):
        runs, left = slow(text.split())
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == runs
        assert (row["collapsed"], row["n_words"]) == (left, len(text.split()))


def test_words_of_famous_sequences():
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    thue = ["a"]
    while len(thue) < 512:
        thue += ["b" if x == "a" else "a" for x in thue]
    texts = [" ".join(b), " ".join(thue), " ".join(["x"] * 999), " ".join(["x", "y"] * 300 + ["x"] * 40)]
    for text, row in zip(texts, periodic._arrays(periodic.pa.array(texts), 12).to_pylist(), strict=True):
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == slow(text.split())[0]


def test_extensions_to_both_sides():
    chosen = random.Random(5)
    words = [chosen.randrange(3) for _ in range(400)] * 2
    symbols = np.array([900, *words, 901])
    grammar = periodic.Grammar(symbols)
    a, b = np.array([sorted(chosen.sample(range(1, 801), 2)) for _ in range(500)], dtype=np.int32).T
    for step in (1, -1):
        for i, j, length in zip(a.tolist(), b.tolist(), grammar.extension(a, b, step).tolist(), strict=True):
            expected = 0
            while symbols[i + step * expected] == symbols[j + step * expected]:
                expected += 1
            assert length == expected
    assert sum(len(level.symbols) for level in grammar.levels) < 12 * len(symbols)


def test_texts_in_a_table(spark):
    rows = periodic.with_runs(messy(spark)).collect()
    assert len(rows) == 12 and {"row", "text_key", "places"} <= set(rows[0].asDict())
    for r in rows:
        expected, left = slow((r.text or "").split(" ")) if r.text != LONG else ([(0, 18000, 6)], None)
        assert [tuple(run) for run in r.runs.runs] == expected
        if r.text == LONG:
            assert r.runs.collapsed == "long words make a long text"
    assert periodic.with_runs(empty(spark)).collect() == []


def test_the_longest_run_and_ties(spark):
    text = " ".join(["a"] * 12 + ["x", "y"] + ["b", "c"] * 6 + ["z"])
    row = periodic.with_runs(spark.createDataFrame([(text,), ("a b",)], "text string"))
    found = row.select(periodic.longest("runs.runs").alias("best")).collect()
    assert [tuple(r.best) for r in found] == [(0, 12, 1), (None, None, None)]
