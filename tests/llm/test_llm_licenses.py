import random

import pytest
from messy import CASES, empty, messy

from cityloom.llm.licenses import CUES, TEMPLATES, Scanner, with_licenses


FILLER = "the quick brown fox jumps over lazy dogs while seven wizards box and mix jugs of liquid near quartz".split()


@pytest.fixture(scope="module")
def scanner():
    return Scanner(TEMPLATES)


def names(scanner, text):
    return [(found.license, found.status) for _, _, found in scanner.scan(text)]


@pytest.mark.parametrize("name", TEMPLATES)
def test_each_wording_is_found_exactly(scanner, name):
    text = TEMPLATES[name]
    assert any(cue in text.lower() for cue in CUES)
    for around in ("{}", "before\n{}\nafter", "some words before {} and some after", "{}\n\n" + "other text " * 500):
        assert names(scanner, around.format(text)) == [(name, "exact")]
    assert names(scanner, "\n".join(text.upper().split(". "))) == [(name, "exact")]


def test_other_licenses_are_not_taken_for_known_ones(scanner):
    for text in ("Licensed under CC BY-ND 4.0.", "Licensed under the Apache License, Version 1.1.", "The license of the driver was copyright 1999", "licensed"):
        assert names(scanner, text) == []


def test_differences_of_a_modified_notice(scanner):
    text = TEMPLATES["MIT-text"].replace("free of charge", "free of cost")
    [(_, _, found)] = scanner.scan(text)
    assert (found.license, found.status, found.differences) == ("MIT-text", "modified", "-charge +cost")


def test_several_statements_in_one_stretch(scanner):
    text = f"{TEMPLATES['GPL-3.0']}\n{TEMPLATES['all-rights-reserved']}"
    assert sorted(names(scanner, text)) == [("GPL-3.0", "exact"), ("all-rights-reserved", "exact")]


def around(scanner, words, seed):
    """Words with others before and behind, and the place of a cue in them."""
    chosen = random.Random(seed)
    text = [*chosen.choices(FILLER, k=chosen.randrange(60)), *words, *chosen.choices(FILLER, k=chosen.randrange(60))]
    return text, scanner._places(text)


def changed(words, scanner, name, chosen):
    """A wording with some words left out or put in, as a modified statement may have them."""
    words = list(words)
    for _ in range(chosen.randrange(scanner.changes(name) + 1)):
        at = chosen.randrange(len(words))
        if scanner.naming(words[at], name) or any(words[at].startswith(cue[:5]) for cue in CUES):
            continue
        words[at : at + chosen.randrange(2)] = chosen.choice([[], ["perhaps"]])
    return words


def by_words_alone(scanner, words, at):
    """What comparing every wording gives: that with the most words in place, of equal ones an exact one."""
    found = []
    for name, wording in scanner.words.items():
        low = max(0, at - scanner.reach(name))
        block = words[low : at + scanner.reach(name) + 1]
        if compared := scanner.compare(block, name):
            in_place = len(wording) - sum(word.startswith("-") for word in compared[1].split())
            found.append((-in_place, compared[0] != "exact", name))
    return min(found)[2] if found else None


def test_the_ranking_finds_what_comparing_all_wordings_finds(scanner):
    chosen, agreed, total = random.Random(3), 0, 0
    for seed in range(12):
        for name in TEMPLATES:
            words, places = around(scanner, changed(scanner.words[name], scanner, name, chosen), seed)
            for at in places[:2]:
                best = scanner._best(words, at)
                total += 1
                agreed += (best[0].license if best else None) == by_words_alone(scanner, words, at)
    assert total > 500 and agreed / total >= 0.99


def test_the_ranking_decides(scanner, monkeypatch):
    words, places = around(scanner, scanner.words["Apache-2.0-notice"], 1)
    assert scanner._best(words, places[0])[0].license == "Apache-2.0-notice"
    inner = Scanner.ranking
    monkeypatch.setattr(Scanner, "ranking", lambda self, *given: inner(self, *given)[::-1])
    assert scanner._best(words, places[0])[0].license == "Apache-2.0"


def test_the_right_wording_takes_most_off(scanner):
    first = 0
    for seed, (name, wording) in enumerate(scanner.words.items()):
        words, places = around(scanner, wording, seed)
        ranking = [other for _, other in scanner.ranking(words, places[0])]
        assert len(ranking) == len(TEMPLATES) and name in ranking[:3]
        first += ranking[0] == name
    assert first >= 0.8 * len(TEMPLATES)


def test_denied_statements(scanner):
    for text in ("Not licensed under CC BY 4.0.", "It was never released under the MIT License.", "No all rights reserved"):
        assert names(scanner, text) == []
    assert names(scanner, "It is not. Still it is licensed under CC BY 4.0.") == [("CC-BY-4.0", "exact")]


def test_messy_rows(spark):
    cases = [*CASES, (70, TEMPLATES["MIT"]), (70, TEMPLATES["MIT"])]
    docs = messy(spark, cases)
    rows = with_licenses(docs).collect()
    assert len(rows) == len(cases)
    for r in rows:
        assert [x.license for x in r.licenses] == (["MIT"] if r.doc_id == 70 else [])
    assert with_licenses(with_licenses(docs)).columns == [*docs.columns, "licenses"]
    assert with_licenses(empty(spark)).collect() == []
