import json
import random

import pytest
from conftest import TESTDATA
from messy import CASES, empty, messy

from cityloom.llm import counts, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path(queries.WORD_TOKENIZER)
ALPHABET = [
    *"abcABCtheing  \n\t'’sStTrRevEmM!?.,0123459-_", "<|endoftext|>", "<|startoftext|>", "<|endof", "é", "é", "́", "İ", "ß", "Σ", "漢", "字", "😀", " ", " ", "​",
    "\x00", "\x1c", "\x85", "½", "²", "'s", "'LL", "가", "ﬁ", "ǅ", "﻿", "the", "ing", "quick ",
]


def expected(texts):
    library = tokenizers.Tokenizer.from_file(PATH)
    return [len(found.ids) for found in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library():
    chosen = random.Random(2)
    texts = ["".join(chosen.choice(ALPHABET) for _ in range(chosen.randrange(60))) for _ in range(3000)] + ["", " ", "x" * 5000, "漢" * 3000, "'s" * 900]
    counter = counts.Counter(PATH, frozenset(counts.whole_tokens(PATH)))
    assert counter.count(counts.pa.array(texts)).tolist() == expected(texts)
    # Once more, now from memory, and in slices.
    assert counter.count(counts.pa.array(texts).slice(7, 500)).tolist() == expected(texts[7:507])


def test_the_proof_holds_in_the_library():
    library = tokenizers.Tokenizer.from_file(PATH)
    whole = counts.whole_tokens(PATH)
    assert len(whole) > 30_000
    for word in whole[::50]:
        assert [token.value for token in library.model.tokenize(word)] == [word + "</w>"]


def test_strings_that_merges_do_not_reach_are_not_proven(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        rules = json.load(file)
    rules["model"]["merges"] = [pair for pair in rules["model"]["merges"] if list(pair) != ["th", "e</w>"]]
    path = str(tmp_path / "fewer.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(rules, file)
    whole = frozenset(counts.whole_tokens(path))
    assert "the" in counts.whole_tokens(PATH) and "the" not in whole
    text = "the other, then the quick"
    library = tokenizers.Tokenizer.from_file(path)
    assert counts.Counter(path, whole).count(counts.pa.array([text])).tolist() == [len(library.encode(text, add_special_tokens=False).ids)]


def test_whole_tokens_are_not_merged(monkeypatch):
    merged = []
    counter = counts.Counter(PATH, frozenset(counts.whole_tokens(PATH)))
    inner = counter.rules.merged
    monkeypatch.setattr(counter.rules, "merged", lambda word: merged.append(word) or inner(word))
    assert counter.count(counts.pa.array(["the quick the zzxqj quick"])).tolist() == expected(["the quick the zzxqj quick"])
    assert merged == ["zzxqj"]


def test_memory_is_bounded_and_long_stretches_are_not_kept(monkeypatch):
    monkeypatch.setattr(counts, "REMEMBERED", 3)
    counter = counts.Counter(PATH, frozenset(counts.whole_tokens(PATH)))
    texts = ["a b c d e f g", "y" * 200, "a b"]
    assert counter.count(counts.pa.array(texts)).tolist() == expected(texts)
    assert len(counter.remembered) <= 3


def test_rows_of_a_table(spark):
    rows = counts.with_token_counts(messy(spark), PATH, 1000).collect()
    texts = [text or "" for _, text in CASES]
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == sorted((len(t.encode()), n, n > 1000) for t, n in zip(texts, expected(texts), strict=True))
    assert counts.with_token_counts(empty(spark), PATH, 1000).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="another kind"):
        counts.Rules(public_tokenizers.path(queries.BYTE_TOKENIZER))


@pytest.mark.skipif(not TESTDATA.exists(), reason="test tables not present")
def test_query_equals_the_library(spark):
    sf = str(TESTDATA / "sf0.001")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    known = dict(zip(texts, expected(list(texts.values())), strict=True))
    rows = queries.QUERIES["op13_token_counts"](spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {i: (len(t.encode()), known[i], known[i] > 2048) for i, t in texts.items()}
    assert len(rows) == len(texts)
