import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from messy import CASES, empty, messy

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from cityloom.llm import rans  # noqa: E402
from cityloom.llm import token_files  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b's", "the", "ing", "word.", "end,", "x?!", " ", " ", " ", "  ", "\n", "\t", "é", "漢", "😀", "\x00", "...", "12", "<|endoftext|>", "'ll", "\xa0", "\x1c", "\x85", "\r\n", "　", "#$"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.mark.parametrize("size", [0, 1, 2, 31, 33, 1000, 65_537, 300_000])
@pytest.mark.parametrize("kinds", [1, 2, 50_257])
def test_blocks_decode_to_what_was_encoded(size, kinds):
    ids = np.minimum((np.random.default_rng(size).pareto(0.6, size) * 3).astype(np.int64), kinds - 1)
    table = rans.Table.from_counts(np.bincount(ids, minlength=1))
    assert not size or table.frequencies.sum() == 1 << rans.SCALE_BITS
    block = rans.encode_block(ids, table)
    read = rans.Table.from_bytes(table.to_bytes())
    assert np.array_equal(rans.decode_block(block, read), ids)
    if size:
        lanes, stretches = np.frombuffer(block, "<u4", 4, 9)[1:3].tolist()
        parts = [rans.decode_from(block, read, i) for i in range(stretches)]
        assert np.array_equal(np.concatenate(parts), ids) and len(parts[0]) == min(size, rans.CHECKPOINT * lanes)


def test_size_is_near_the_entropy():
    ids = np.minimum((np.random.default_rng(1).pareto(0.8, 500_000) * 30).astype(np.int64), 50_256)
    shares = np.bincount(ids) / len(ids)
    entropy = -(shares[shares > 0] * np.log2(shares[shares > 0])).sum()
    table = rans.Table.from_counts(np.bincount(ids))
    assert len(rans.encode_block(ids, table)) * 8 / len(ids) < 1.07 * entropy


def test_damage_is_found():
    table = rans.Table.from_counts(np.bincount([1, 2, 2]))
    block = bytearray(rans.encode_block(np.array([1, 2, 2]), table))
    block[-1] ^= 1
    with pytest.raises(ValueError):
        rans.decode_block(bytes(block), table)


@pytest.mark.parametrize("longest", [6, 20, 128])
def test_random_texts_equal_the_library(library, monkeypatch, longest):
    monkeypatch.setattr(token_files, "REMEMBERED", 300)
    monkeypatch.setattr(token_files, "LONGEST_REMEMBERED", longest)
    monkeypatch.setattr(token_files, "SLOT_BITS", 6)
    chosen = random.Random(8)
    tokenizer = token_files.Tokenizer(PATH, 2)
    for _ in range(6):
        texts = ["", *("".join(chosen.choices(PARTS, k=chosen.randrange(12))) for _ in range(800))]
        want = [e.ids + [2] for e in library.encode_batch(texts, add_special_tokens=False)]
        ids, lengths = tokenizer.encode(pa.array(texts))
        assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def thue_morse(letters):
    """A word and its complement: polynomials modulo a power of two agree on the two, whatever their base."""
    word = "a"
    while len(word) < letters:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("letters", [64, 128, 1024, 2048])
@pytest.mark.parametrize("place", ["start {}", "{}", "a {}. b", "{}\nx"])
def test_words_that_hashes_confuse_have_their_own_ids(library, letters, place):
    first, second = (place.format(word) for word in thue_morse(letters))
    want = {text: library.encode(text, add_special_tokens=False).ids + [2] for text in (first, second)}
    assert want[first] != want[second]
    together = token_files.Tokenizer(PATH, 2)
    assert together.encode(pa.array([first, second, first]))[0].tolist() == want[first] + want[second] + want[first]
    one_by_one = token_files.Tokenizer(PATH, 2)
    for text in (first, second, second, first):
        assert one_by_one.encode(pa.array([text]))[0].tolist() == want[text]


def test_long_stretches_that_repeat_are_not_remembered(library):
    tokenizer = token_files.Tokenizer(PATH, 2)
    long = ["x" * 500 + "." + "y" * n for n in range(5)]
    texts = [f"a {long[i % 5]} {long[i % 3]}\t{long[0]}" if i % 2 else f"{long[i % 5]} a\nb {long[i % 3]}." for i in range(40)]
    want = [e.ids + [2] for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert tokenizer.encode(pa.array(texts))[0].tolist() == sum(want, [])
    assert len(tokenizer.lengths) < 20


def test_files_read_back(spark, library, tmp_path):
    cases = CASES + [(1000 - i, f"document {i} of many") for i in range(300)]
    token_files.write_tokens(messy(spark, cases).repartition(3), f"{tmp_path}/t", PATH, 2, segment_tokens=100, block_tokens=64)
    rows = token_files.read_tokens(spark, f"{tmp_path}/t").orderBy("start").collect()
    assert len(rows) == len(cases)
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    at = 0
    for r in rows:
        assert r.start == at and len(r.token_ids) == 4 * r.n_tokens
        at += r.n_tokens
    want = [e.ids + [2] for e in library.encode_batch([t or "" for _, t in cases], add_special_tokens=False)]
    sums = [zlib.crc32(np.array(w, dtype="<u4").tobytes()) for w in want]
    assert sorted(zlib.crc32(r.token_ids) for r in rows) == sorted(sums)


def test_empty_table(spark, tmp_path):
    token_files.write_tokens(empty(spark), f"{tmp_path}/t", PATH, 2)
    assert token_files.read_tokens(spark, f"{tmp_path}/t").collect() == []
