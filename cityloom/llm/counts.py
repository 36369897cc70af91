"""Token counts of texts, mostly without encoding them.

For a byte-level BPE file whose pre-tokens never hold white space. Offline, once for a file, the merges are run on every vocabulary string that ends a word: those that come out as
one token are proven to be encoded alone as one token. In a text a pre-token among them counts 1 without another look; only the rest is merged. Texts are cut
at ASCII white space, where no pre-token and no step of the normalizer reaches across, and equal stretches of a batch are told by an exact dictionary, so each is counted once.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityloom.llm.common import text_of

#: Stretches, and merged pre-tokens, whose counts a process remembers, none of more than so many characters.
REMEMBERED, LONGEST_REMEMBERED = 600_000, 100
#: Pre-tokens of up to so many characters are merged by looking through all pairs, longer ones with a heap; the tokens are the same.
LOOKED_THROUGH = 48
#: Bytes of text looked at together.
BATCH_BYTES = 1 << 22

# The parts of a tokenizer file that this module knows. Pre-tokens after the normalizer: clitics, letters, single digits, other characters.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for printable ASCII characters in lower case, without white space.
_ASCII_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


class Rules:
    """The merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, cut, added = rules["model"], (rules["pre_tokenizer"] or {}).get("pretokenizers", []), rules["added_tokens"]
        known = (
            model["type"] == "BPE"
            and not any(model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and (rules["normalizer"] or {}).get("normalizers") == _NORMALIZER
            and [part["type"] for part in cut] == ["Split", "ByteLevel"]
            and (cut[0]["pattern"], cut[0]["behavior"], cut[0]["invert"]) == ({"Regex": _PATTERN}, "Removed", True)
            and not (cut[1]["add_prefix_space"] or cut[1]["use_regex"])
            and not any(token[name] for token in added for name in ("single_word", "normalized"))
            and not any(re.search(r"\s", token["content"]) for token in added)
        )
        if not known:
            raise ValueError(f"{path}: pre-tokens or merges of another kind than are known here")
        self.end = model.get("end_of_word_suffix") or ""
        pairs = (tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.vocabulary = model["vocab"]
        self.specials = [token["content"] for token in added]

    def merged(self, word: str) -> list[str]:
        """Tokens of a pre-token: always the pair of the lowest rank is merged, of several the leftmost."""
        parts = [*word[:-1], word[-1] + self.end]
        return self._merged_looking(parts) if len(parts) <= LOOKED_THROUGH else self._merged_waiting(parts)

    def _merged_looking(self, parts: list[str]) -> list[str]:
        rank, none = self.ranks.get, len(self.ranks)
        found = [rank(pair, none) for pair in pairwise(parts)]
        while found and (least := min(found)) < none:
            at = found.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at:
                found[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(found):
                found[at] = rank((parts[at], parts[at + 1]), none)
        return parts

    def _merged_waiting(self, whole: list[str]) -> list[str]:
        parts: list[str | None] = [*whole]
        behind, before = [*range(1, len(parts)), -1], list(range(-1, len(parts) - 1))
        ranks = self.ranks
        waiting = [(ranks[pair], at) for at, pair in enumerate(pairwise(whole)) if pair in ranks]
        heapq.heapify(waiting)
        while waiting:
            rank, at = heapq.heappop(waiting)
            other = behind[at]
            if parts[at] is None or other < 0 or ranks.get((parts[at], parts[other])) != rank:
                continue
            parts[at], parts[other] = parts[at] + parts[other], None
            behind[at] = further = behind[other]
            if further >= 0:
                before[further] = at
                if (rank := ranks.get((parts[at], parts[further]))) is not None:
                    heapq.heappush(waiting, (rank, at))
            if (earlier := before[at]) >= 0 and (rank := ranks.get((parts[earlier], parts[at]))) is not None:
                heapq.heappush(waiting, (rank, earlier))
        return [part for part in parts if part is not None]

    def proven(self) -> list[str]:
        """Pre-tokens, in the characters of the file, that are one token of the vocabulary by the merges themselves."""
        ending = (token[: len(token) - len(self.end)] for token in self.vocabulary if token.endswith(self.end) and len(token) > len(self.end))
        return sorted(word for word in ending if self.merged(word) == [word + self.end])


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> tuple[str, ...]:
    """The proof for a file: all pre-tokens that are one token. As many as the vocabulary has strings at most."""
    return tuple(Rules(path).proven())


class Counter:
    """Counts tokens of stretches without white space, and remembers those of short ones."""

    def __init__(self, path: str, whole: frozenset[str]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        import tokenizers

        library = tokenizers.Tokenizer.from_file(path)
        # Beyond ASCII the library's own Unicode tables decide on what is a letter, a digit, and its lower case.
        self.normalized, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.rules, self.whole = Rules(path), whole
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.rules.specials, key=len, reverse=True))) + ")") if self.rules.specials else None
        self.remembered: dict[str, int] = {}
        self.rest: dict[str, int] = {}

    def _pre_tokens(self, stretch: str) -> list[str]:
        if stretch.isascii() and stretch.isprintable():
            return _ASCII_PATTERN.findall(stretch.lower())
        return [word for word, _ in self.cut(self.normalized(stretch)) if word]

    def _ordinary(self, stretch: str) -> int:
        total = 0
        for word in self._pre_tokens(stretch):
            if word in self.whole:
                total += 1
            elif (count := self.rest.get(word)) is not None:
                total += count
            else:
                total += _kept(self.rest, word, len(self.rules.merged(word)))
        return total

    def tokens(self, stretch: str) -> int:
        count = self.remembered.get(stretch)
        if count is None:
            parts = self.special.split(stretch) if self.special and any(map(stretch.__contains__, self.rules.specials)) else [stretch]
            # Every second part is a special token.
            count = sum(1 if i % 2 else self._ordinary(part) for i, part in enumerate(parts) if part)
            _kept(self.remembered, stretch, count)
        return count

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of an array of strings without NULL."""
        offsets = np.frombuffer(texts.buffers()[1], dtype="<i4" if texts.type == pa.string() else "<i8")[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        if data is None or offsets[-1] == offsets[0]:
            return np.zeros(len(texts), dtype=np.int64)
        letters = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets -= offsets[0]
        filled = ~_WHITE[letters]
        begins = filled.copy()
        begins[1:] &= ~filled[:-1]
        # A text's first character begins a stretch, too.
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[heads] = filled[heads]
        starts = np.flatnonzero(begins)
        if not len(starts):
            return np.zeros(len(texts), dtype=np.int64)
        before = np.cumsum(filled)
        edges = np.append(before[starts] - 1, before[-1]).astype(np.int64)
        stretches = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(letters[filled]))
        coded = stretches.dictionary_encode()
        counts = np.fromiter(map(self.tokens, coded.dictionary.to_pylist()), dtype=np.int64, count=len(coded.dictionary))
        upto = np.append(0, np.cumsum(counts[coded.indices.to_numpy()]))
        return np.diff(upto[np.searchsorted(starts, offsets)])


def _kept(remembered: dict[str, int], name: str, count: int) -> int:
    if len(name) <= LONGEST_REMEMBERED:
        if len(remembered) >= REMEMBERED:
            remembered.clear()
        remembered[name] = count
    return count


@lru_cache(maxsize=2)
def _counter(path: str, whole: frozenset[str]) -> Counter:
    return Counter(path, whole)


def token_count(spark: SparkSession, text: str | Column, path: str) -> Column:
    """Tokens of each whole text, without begin, end or added tokens; special strings inside a text are special tokens, as is the library's default.

    ``path`` must name the same file on every executor. NULL and empty texts have none.
    """
    proof = spark.sparkContext.broadcast(frozenset(whole_tokens(path)))

    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(path, proof.value)
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch).to_numpy().astype(np.int64))
            at, parts = 0, [np.zeros(0, dtype=np.int64)]
            while at < len(batch):
                upper = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_BYTES, side="right")))
                parts.append(counter.count(batch.slice(at, upper - at)))
                at = upper
            yield pa.array(np.concatenate(parts))

    return counted(text_of(text))


def with_token_counts(docs: DataFrame, path: str, limit: int, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``, whether there are more tokens than ``limit``; columns of these names are replaced.

    Every text stands alone, so repeated rows and ties need no rule; an empty table stays empty. NULL texts have 0 bytes and 0 tokens.
    """
    tokens = token_count(docs.sparkSession, text_column, path)
    sized = docs.withColumns({"n_bytes": F.octet_length(text_of(text_column)).cast("bigint"), "n_tokens": tokens})
    return sized.withColumn("over_limit", F.col("n_tokens") > limit)
