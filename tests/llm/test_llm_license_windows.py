import random
import textwrap

import pytest

from cityloom.llm.licenses import TEMPLATES, Scanner

PROSE = random.Random(0)
WORDS = ["".join(PROSE.choices("etaoinshrdlucmfwypvbgk", range(22, 0, -1), k=PROSE.randrange(2, 10))) for _ in range(1500)]


@pytest.fixture(scope="module")
def scanner():
    return Scanner(TEMPLATES)


def found(scanner, text):
    return [(f.license, f.status) for _, _, f in scanner.scan(text)]


def invented(seed, count):
    return random.Random(seed).choices(WORDS, [1 / n for n in range(1, len(WORDS) + 1)], k=count)


@pytest.mark.parametrize("length", [250, 1_000, 20_000])
@pytest.mark.parametrize("name", TEMPLATES)
def test_exact_statements_inside_long_lines(scanner, name, length):
    for seed in range(5):
        line = invented(seed, length)
        line.insert(random.Random(seed).randrange(length), TEMPLATES[name])
        assert found(scanner, " ".join(line)) == [(name, "exact")]


def test_every_place_in_a_long_line_counts(scanner):
    line = [word for seed, wording in enumerate(list(TEMPLATES.values()) * 3) for word in (*invented(seed, 400), wording)]
    assert sorted(found(scanner, " ".join(line))) == sorted((name, "exact") for name in list(TEMPLATES) * 3)


def test_lines_of_a_statement(scanner):
    text = f"one\ntwo {TEMPLATES['MIT']}\n" + "filler words here\n" * 5 + TEMPLATES["CC0-1.0"].replace(", ", ",\n")
    assert [(first, last, f.license) for first, last, f in scanner.scan(text)] == [(1, 1, "MIT"), (7, 9, "CC0-1.0")]


@pytest.mark.parametrize("between", ["\n", "  ", "\t", "\r\n", " \u00a0", "\n# ", ",\n * "])
@pytest.mark.parametrize("name", TEMPLATES)
def test_statements_broken_at_any_word(scanner, name, between):
    words = TEMPLATES[name].split()
    for at in range(1, len(words)):
        text = "some prose before it. " + " ".join(words[:at]) + between + " ".join(words[at:]) + " Then other prose follows"
        assert found(scanner, text) == [(name, "exact")]


@pytest.mark.parametrize("width", [10, 40, 72])
@pytest.mark.parametrize("name", TEMPLATES)
def test_hard_wrapped_paragraphs(scanner, name, width):
    text = textwrap.fill(" ".join([*invented(1, 60), TEMPLATES[name], *invented(2, 60)]), width, break_long_words=False, break_on_hyphens=False)
    assert found(scanner, text) == [(name, "exact")]
