"""SentencePiece encoding and decoding in vectorised merge rounds.

A text is cut where no piece of the vocabulary can reach across, equal cuts are encoded once, and all distinct ones of a batch are merged together:
their symbols lie in flat arrays, and in each round every word that still has a pair finds its pair of best rank, the leftmost of equals, merges that one,
and the arrays are compacted. One merge per word and round is what the library does with its queue: a merge may make a better pair beside it.
"""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
#: Types of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Bytes of text worked on at a time; a longer text is worked on alone.
BATCH_CHARACTERS = 1 << 20
#: Characters beyond which a text is worked on in parts.
LONG_TEXT = 1 << 20
#: Symbols beyond which a word is merged with a queue: a round costs as much as the word is long.
ROUNDS_UP_TO = 96
SLOT_BITS = 20
_BEFORE_WORD = re.compile(f"[^{SPACE}]{SPACE}")
NEVER = np.int32(np.iinfo(np.int32).max)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            length, at = (_varint(data, at)) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + length], at + length
        yield key >> 3, value


class PieceModel:
    """The pieces of a BPE model file with byte fallback and no character normalisation."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        self.texts: list[str] = []
        self.types: list[int] = []
        scores: list[float] = []
        for piece in (dict(_fields(value)) for number, value in message if number == 1):
            self.texts.append(piece[1].decode())
            scores.append(float(np.frombuffer(piece[2], dtype="<f4")[0]) if 2 in piece else 0.0)
            self.types.append(piece.get(3, NORMAL))
        trainer = dict(_fields(dict(message).get(2, b"")))
        rules = dict(_fields(dict(message).get(3, b"")))
        if trainer.get(3, 1) != 2 or not trainer.get(35) or rules.get(2) or rules.get(4, 1) or not rules.get(3, 1) or not rules.get(5, 1):
            raise ValueError("only BPE with byte fallback, a dummy prefix, escaped and kept white space and no other normalisation")
        if {USER_DEFINED, UNUSED} & set(self.types):
            raise ValueError("user-defined and unused pieces are not supported")
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.ids = {text: i for i, text in enumerate(self.texts) if self.types[i] == NORMAL}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i, text in enumerate(self.texts):
            if self.types[i] == BYTE:
                self.byte_ids[int(text[3:-1], 16)] = i
        self.ranks = np.unique(-np.array(scores), return_inverse=True)[1].astype(np.int32)
        self._pairs()
        self._cutter()
        self.surfaces = [self._surface(i) for i in range(len(self.texts))]

    def _surface(self, i: int) -> bytes:
        """The bytes that an id stands for in a decoded text."""
        if self.types[i] == BYTE:
            return bytes([int(self.texts[i][3:-1], 16)])
        if self.types[i] == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if self.types[i] == CONTROL else self.texts[i].replace(SPACE, " ").encode()

    def _pairs(self) -> None:
        """Which two symbols join to which piece, in a hash table of arrays.

        A symbol is a piece's id, or beyond those the code point of a character that is no piece by itself.
        """
        pieces = len(self.texts)
        self.symbols = pieces + sys.maxunicode + 1
        self.character = np.arange(pieces, self.symbols, dtype=np.int64)
        for text, i in self.ids.items():
            if len(text) == 1:
                self.character[ord(text)] = i
        found = {}
        for text, i in self.ids.items():
            for at in range(1, len(text)):
                left, right = (self.ids.get(part, self.character[ord(part)] if len(part) == 1 else None) for part in (text[:at], text[at:]))
                if left is not None and right is not None:
                    found[int(left) * self.symbols + int(right)] = i
        self.found = found
        keys = np.fromiter(found, dtype=np.int64, count=len(found))
        self.pair_piece = np.append(np.fromiter(found.values(), dtype=np.int64, count=len(found)), -1)
        self.pair_rank = np.append(self.ranks[self.pair_piece[:-1]], NEVER).astype(np.int32)
        self.pair_keys = np.append(keys, -1)
        # Keys whose slot is taken go to a second table, hashed otherwise; the last entry of the pairs means none.
        self.slots = []
        rest = np.arange(len(keys))
        multiplier = 0x9E3779B97F4A7C15
        while len(rest):
            slots = np.full(1 << SLOT_BITS, len(keys), dtype=np.int32)
            at = _slot(keys[rest], multiplier)
            slots[at] = rest
            self.slots.append((multiplier, slots))
            rest = rest[slots[at] != rest]
            multiplier = multiplier * 0xD1342543DE82EF95 % (1 << 64) | 1

    def _cutter(self) -> None:
        """A pattern of the stretches between which no piece reaches.

        No piece may hold a space mark after another character, so a text can be cut before each; and any character that no longer
        piece contains is cut out.
        """
        if any(re.search(f"[^{SPACE}]{SPACE}", text) for text in self.ids):
            raise ValueError("a piece with a space inside")
        joined = {c for text in self.ids if len(text) > 1 for c in text} - {SPACE}
        inside = "".join(map(re.escape, sorted(joined)))
        self.cuts = re.compile(f"{SPACE}*[{inside}]+|{SPACE}+|[^{inside}{SPACE}]+")
        self.neighbors = {a + b for text in self.ids for a, b in pairwise(text)}

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each two symbols the number of their pair, or that of the last entry, which is none."""
        keys = left * self.symbols + right
        result = np.full(len(keys), len(self.pair_keys) - 1, dtype=np.int32)
        for multiplier, slots in self.slots:
            pair = slots[_slot(keys, multiplier)]
            hit = self.pair_keys[pair] == keys
            result[hit] = pair[hit]
        return result

    def _symbols_of(self, words: list[str]) -> np.ndarray:
        return self.character[np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of all words, one after another, and how many each word has; no word is empty."""
        none = len(self.pair_keys) - 1
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ids = self._symbols_of(words)
        pair = np.append(self._lookup(ids[:-1], ids[1:]), np.int32(none))
        starts = np.cumsum(lengths) - lengths
        pair[starts + lengths - 1] = none  # a word's last symbol has no partner
        numbers = np.arange(len(words))
        done = []  # word numbers, lengths, symbols
        while len(numbers):
            rank = self.pair_rank[pair]
            best = np.minimum.reduceat(rank, starts)
            ended = best == NEVER
            if ended.any():
                symbols = np.repeat(ended, lengths)
                done.append((numbers[ended], lengths[ended], ids[symbols]))
                ids, pair, rank = ids[~symbols], pair[~symbols], rank[~symbols]
                numbers, lengths, best = numbers[~ended], lengths[~ended], best[~ended]
                starts = np.cumsum(lengths) - lengths
                if not len(numbers):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, lengths))
            # The leftmost hit of each word is the first at or after the word's start.
            first = hits[np.searchsorted(hits, starts)]
            ids[first] = self.pair_piece[pair[first]]
            keep = np.ones(len(ids), dtype=bool)
            keep[first + 1] = False
            ids, pair = ids[keep], pair[keep]
            order = np.arange(len(numbers))
            lengths = lengths - 1
            starts = starts - order
            at = first - order
            last = at == starts + lengths - 1
            pair[at[last]] = none
            right = at[~last]
            left = at[at > starts] - 1
            pair[right] = self._lookup(ids[right], ids[right + 1])
            pair[left] = self._lookup(ids[left], ids[left + 1])
        if not done:
            return ids, lengths
        order_words, order_lengths, flat = (np.concatenate([part[i] for part in done]) for i in range(3))
        begins = np.cumsum(order_lengths) - order_lengths
        order = np.argsort(order_words, kind="stable")
        return _gather(flat, begins[order], order_lengths[order]), order_lengths[order]

    def merged_by_queue(self, word: str) -> list[int]:
        """Final symbols of one long word: the same merges, from a priority queue."""
        ids = self._symbols_of([word]).tolist()
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        table = self.found
        queue = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] >= 0 and (piece := table.get(ids[at] * self.symbols + ids[after[at]])) is not None:
                queue.append((int(self.ranks[piece]), at, ids[at], ids[after[at]], piece))

        for at in range(len(ids)):
            offer(at)
        heapq.heapify(queue)
        while queue:
            _, at, left, right, piece = heapq.heappop(queue)
            follower = after[at]
            if ids[at] != left or follower < 0 or ids[follower] != right:
                continue
            ids[at], ids[follower] = piece, -1
            after[at] = after[follower]
            if after[at] >= 0:
                before[after[at]] = at
            fresh = len(queue)
            offer(before[at])
            offer(at)
            added, queue[fresh:] = queue[fresh:], []
            for entry in added:
                heapq.heappush(queue, entry)
        return [i for i in ids if i >= 0]

    def _as_ids(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and lengths of words, with the byte pieces of each character that is no piece."""
        pieces = len(self.texts)
        strange = np.flatnonzero(symbols >= pieces)
        if not len(strange):
            return symbols, lengths
        codes, which = np.unique(symbols[strange] - pieces, return_inverse=True)
        encoded = [chr(code).encode() for code in codes.tolist()]
        widths = np.array([len(data) for data in encoded])
        width = np.ones(len(symbols), dtype=np.int64)
        width[strange] = widths[which]
        flat = np.repeat(symbols, width)
        begins = (np.cumsum(width) - width)[strange]
        table = np.concatenate([self.byte_ids[list(data)] for data in encoded])
        table_begins = np.cumsum(widths) - widths
        flat[_gather(np.arange(len(flat)), begins, widths[which])] = _gather(table, table_begins[which], widths[which])
        ends = np.append(0, np.cumsum(width))[np.append(0, np.cumsum(lengths))]
        return flat, np.diff(ends)

    def _parts(self, word: str) -> list[str]:
        """A word cut where two neighboring characters stand side by side in no piece."""
        cuts = [at for at in range(1, len(word)) if word[at - 1 : at + 1] not in self.neighbors]
        return [word[a:b] for a, b in pairwise([0, *cuts, len(word)])]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has."""
        pieces, owners = words, None
        if any(len(word) > ROUNDS_UP_TO for word in words):
            pieces, owners = [], []
            for number, word in enumerate(words):
                parts = self._parts(word) if len(word) > ROUNDS_UP_TO else [word]
                pieces.extend(parts)
                owners.extend([number] * len(parts))
        long = [i for i, piece in enumerate(pieces) if len(piece) > ROUNDS_UP_TO]
        queued = {i: self.merged_by_queue(pieces[i]) for i in long}
        if long:
            flat, lengths = self.merged([piece[0] if i in queued else piece for i, piece in enumerate(pieces)])
            ends = np.cumsum(lengths)
            parts = [np.array(queued[i]) if i in queued else flat[ends[i] - lengths[i] : ends[i]] for i in range(len(pieces))]
            flat, lengths = np.concatenate(parts), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        else:
            flat, lengths = self.merged(pieces)
        flat, lengths = self._as_ids(flat, lengths)
        if owners is None:
            return flat, lengths
        return flat, np.bincount(np.array(owners, dtype=np.int64), weights=lengths, minlength=len(words)).astype(np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, between the begin and the end id; NULL as empty. A long text is worked on in parts."""
        normal = [SPACE + text.replace(" ", SPACE) if text else "" for text in texts]
        found = self._ids([text if len(text) <= LONG_TEXT else "" for text in normal])
        for i, text in enumerate(normal):
            if len(text) > LONG_TEXT:
                found[i] = np.concatenate([self._ids([part])[0] for part in _stretches(text)])
        return [np.concatenate(([self.begin], ids, [self.end])).astype("<u4") for ids in found]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text in which blanks are marked, its distinct stretches encoded once."""
        cuts = [self.cuts.findall(text) for text in texts]
        words = [word for cut in cuts for word in cut]
        if not words:
            return [np.zeros(0, dtype=np.int64)] * len(texts)
        numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
        codes = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
        ids, lengths = self.encode_words(list(numbers))
        flat = _gather(ids, (np.cumsum(lengths) - lengths)[codes], lengths[codes])
        ends = np.append(0, np.cumsum(lengths[codes]))
        bounds = ends[np.cumsum([0, *map(len, cuts)])]
        return [flat[a:b] for a, b in pairwise(bounds.tolist())]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: control ids vanish, the space of the first piece too, and each byte that is no UTF-8 becomes U+FFFD."""
        numbers = ids.tolist()
        types, surfaces = self.types, self.surfaces
        inner = [i for i in numbers if types[i] != CONTROL]
        start = int(bool(inner) and types[inner[0]] == NORMAL and self.texts[inner[0]].startswith(SPACE))
        try:
            if all(types[i] != CONTROL for i in numbers[1:-1]):  # else bytes on both sides of a control id would join
                return b"".join([surfaces[i] for i in inner])[start:].decode()
        except UnicodeDecodeError:
            pass
        parts = []
        for is_byte, run in groupby(numbers, lambda i: types[i] == BYTE):
            data = b"".join([surfaces[i] for i in run])
            parts.append(_lenient(data) if is_byte else data.decode())
        return "".join(parts)[start:]


def _stretches(text: str) -> Iterator[str]:
    """A long text in parts, cut before marked blanks that follow another character: no piece reaches across."""
    begin = 0
    while begin < len(text):
        cut = _BEFORE_WORD.search(text, begin + LONG_TEXT)
        end = cut.start() + 1 if cut else len(text)
        yield text[begin:end]
        begin = end


def _lenient(data: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that belongs to no valid character."""
    parts = []
    while data:
        try:
            return "".join((*parts, data.decode()))
        except UnicodeDecodeError as error:
            parts += [data[: error.start].decode(), "\ufffd"]
            data = data[error.start + 1 :]
    return "".join(parts)


def _slot(keys: np.ndarray, multiplier: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(multiplier)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _gather(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``begins``, one after another."""
    ends = np.cumsum(lengths)
    shift = np.repeat(begins - (ends - lengths), lengths)
    return flat[np.arange(len(shift)) + shift]


@lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    return PieceModel(path)


def _small_batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of a batch whose texts together have about ``BATCH_CHARACTERS`` bytes."""
    texts = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + BATCH_CHARACTERS, side="right")))
        yield batch.slice(begin, end - begin), texts.slice(begin, end - begin).to_pylist()
        begin = end


def with_pieces(docs: DataFrame, model_path: str, text_column: str = "text", ids: str = "piece_ids", decoded: str = "piece_text") -> DataFrame:
    """``docs`` with two columns: the ids of the text as little-endian unsigned 32-bit integers, begin and end id included, and the text decoded from them.

    All rows and other columns stay as they are; columns named like the two are replaced. NULL and empty texts give begin and end id and
    the empty text. Each row stands alone, so repeated rows, ties and empty tables need no rule. A task holds a few megabytes of text
    at a time, or one longer text. ``model_path`` must name the same file on every executor.
    """
    kept = docs.drop(ids, decoded)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.StringType())])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for batch in batches:
            for rows, texts in _small_batches(batch, text_column):
                coded = model.encode(texts)
                added = pa.array([value.tobytes() for value in coded], pa.binary()), pa.array(map(model.decode, coded), pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns, *added], [*batch.schema.names, ids, decoded])

    return kept.mapInArrow(encode, schema)
