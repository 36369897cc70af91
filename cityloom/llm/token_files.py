"""Token ids in a compressed, seekable file format.

Documents are put in the order of their ids by a range partitioning, and each task encodes its range while it streams through it. Ids gather into
a segment until it is full; a segment has one frequency table, built from all its ids, and blocks coded with that table by ``rans``, each with its own
checksum and checkpoints. A segment is a row of a Parquet table, so Spark's committer, splits and retries apply: any task can decode any
segment, a lost one is written or read again, and no task holds more than a segment or one document.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityloom.llm import rans
from cityloom.llm.common import size_guarded, text_of
from cityloom.session import stage

SEGMENT_TOKENS = 1 << 21
BLOCK_TOKENS = 1 << 19
#: Bytes of text tokenized at a time, and how many distinct stretches of text a process remembers the ids of.
BATCH_BYTES = 1 << 22
REMEMBERED = 500_000
#: Bytes of the longest stretch that is remembered.
LONGEST_REMEMBERED = 128
#: New stretches encoded in one call.
JOINED = 1 << 12
#: Bytes of the longest stretch that is packed into two numbers; slots of the table of these, as a power of two, to begin with.
PACKED, SLOT_BITS = 15, 20
#: Where a stretch stands.
AFTER_BLANK, ALONE = 1, 2
#: Numbers of stretches that are not remembered begin here.
PASSING = 1 << 40

#: White space other than single blanks and line ends between other characters.
_UNUSUAL = (
    r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|[ \n][ \n]|\A[ \n]|[ \n]\z"
)
#: Marks that the pattern parts from a letter before them.
_MARKS = ".,;:!?#$&*"


def _packed(strings: pa.Array, kind: int) -> np.ndarray:
    """Strings of up to ``PACKED`` bytes in a place as two numbers each: their bytes, and in the last one their length and place. Different strings differ."""
    offsets = np.frombuffer(strings.buffers()[1], dtype="<i4" if strings.type == pa.string() else "<i8")
    offsets = offsets[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = strings.buffers()[2]
    text = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    lengths, columns = np.diff(offsets), np.arange(PACKED + 1)
    letters = np.append(text, np.zeros(PACKED + 1, dtype=np.uint8))[(offsets[:-1] - offsets[0])[:, None] + columns]
    letters[columns >= lengths[:, None]] = 0
    letters[:, PACKED] = lengths + 16 * kind
    return letters.view("<u8")


class _Packed:
    """Numbers of packed strings: an open hash table of arrays, at most half full, that compares whole strings."""

    def __init__(self, strings: np.ndarray | None = None, numbers: np.ndarray | None = None):
        self.strings = np.zeros((0, 2), dtype=np.uint64)
        self.numbers = np.zeros(0, dtype=np.int64)
        self.slots = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        if strings is not None:
            self.add(strings, numbers)

    def _places(self, strings: np.ndarray) -> np.ndarray:
        mixed = (strings[:, 0] ^ (strings[:, 1] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return (mixed >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _following(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & (len(self.slots) - 1)

    def find(self, strings: np.ndarray) -> np.ndarray:
        """The number of each string, -1 for one that was not added."""
        found = np.full(len(strings), -1, dtype=np.int64)
        at, left = self._places(strings), np.arange(len(strings))
        while len(left):
            entry = self.slots[at[left]]
            left, entry = left[entry >= 0], entry[entry >= 0]
            hit = (self.strings[entry] == strings[left]).all(axis=1)
            found[left[hit]] = self.numbers[entry[hit]]
            left = left[~hit]
            at[left] = self._following(at[left])
        return found

    def add(self, strings: np.ndarray, numbers: np.ndarray) -> None:
        """Add different strings that are not there yet."""
        entries = np.arange(len(self.numbers), len(self.numbers) + len(numbers))
        self.strings, self.numbers = np.concatenate([self.strings, strings]), np.append(self.numbers, numbers)
        if 2 * len(self.numbers) > len(self.slots):
            self.slots = np.full(2 << (2 * len(self.numbers)).bit_length(), -1, dtype=np.int32)
            entries = np.arange(len(self.numbers))
        at, left = self._places(self.strings[entries]), np.arange(len(entries))
        while len(left):
            free = self.slots[at[left]] < 0
            self.slots[at[left[free]]] = entries[left[free]]
            left = left[self.slots[at[left]] != entries[left]]
            at[left] = self._following(at[left])


class Tokenizer:
    """A tokenizer file, with the ids of repeated stretches remembered.

    If the file is byte-level BPE over the usual pattern, a text can be cut at single blanks and line ends between other characters: no match
    of the pattern reaches across one, so the ids of the stretches, each with the blank before it, are the ids of the text. What was
    encoded before is told by the stretch itself. Long stretches are not remembered beyond the texts encoded together.
    """

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.separable = rules["normalizer"] is None and rules["pre_tokenizer"] == {
            "type": "ByteLevel",
            "add_prefix_space": False,
            "trim_offsets": True,
            "use_regex": True,
        }
        self.specials = [token["content"] for token in rules["added_tokens"]]
        #: Bytes of each token; the file writes one character for each byte.
        self.widths = np.array([len(self.whole.id_to_token(i) or "") for i in range(self.whole.get_vocab_size())], dtype=np.int64)
        self.end_id = end_id
        #: Numbers of the remembered stretches in each place, of short ones and of others.
        self.short = _Packed()
        self.others: dict[int, dict[str, int]] = {AFTER_BLANK: {}, ALONE: {}}
        self.flat = np.zeros(0, dtype=np.int32)
        self.begins = self.lengths = self.uses = np.zeros(0, dtype=np.int64)
        #: Ids of long stretches, and how many each has; numbered from ``PASSING``.
        self.passing: list[tuple[np.ndarray, np.ndarray]] = []
        self._remember(np.array([end_id]), np.ones(1, dtype=np.int64))  # number 0: the end of a document
        self._learn(ALONE, pa.array(["\n"]))  # number 1: the end of a line

    def _forget_rare(self) -> None:
        """Keep the more used half of what is remembered, and the ends of documents and lines."""
        kept = np.append([0, 1], np.sort(np.argsort(-self.uses[2:], kind="stable")[: REMEMBERED // 2]) + 2)
        numbers = np.full(len(self.lengths), -1, dtype=np.int64)
        numbers[kept] = np.arange(len(kept))
        new = numbers[self.short.numbers]
        self.short = _Packed(self.short.strings[new >= 0], new[new >= 0])
        self.others = {kind: {stretch: int(numbers[n]) for stretch, n in held.items() if numbers[n] >= 0} for kind, held in self.others.items()}
        flat, lengths, uses = _gather(self.flat, self.begins[kept], self.lengths[kept]), self.lengths[kept], self.uses[kept]
        self.flat = np.zeros(0, dtype=np.int32)
        self.begins = self.lengths = self.uses = np.zeros(0, dtype=np.int64)
        self._remember(flat, lengths)
        self.uses[:] = uses // 2

    def _remember(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Append the ids of stretches; returns their numbers."""
        numbers = np.arange(len(self.lengths), len(self.lengths) + len(lengths))
        self.begins = np.append(self.begins, len(self.flat) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.uses = np.append(self.uses, np.zeros(len(lengths), dtype=np.int64))
        self.flat = np.append(self.flat, flat.astype(np.int32))
        return numbers

    def _pass(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers for long stretches, good until the texts at hand are encoded."""
        begin = PASSING + sum(len(held) for _, held in self.passing)
        self.passing.append((flat.astype(np.int32), lengths))
        return np.arange(begin, begin + len(lengths))

    def _alone(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [encoding.ids for encoding in self.whole.encode_batch_fast(strings, add_special_tokens=False)]
        lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        return np.fromiter(chain.from_iterable(coded), dtype=np.int32, count=int(lengths.sum())), lengths

    def _together(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches behind a blank: encoded as one text, then told apart by their bytes."""
        words = strings.to_numpy(zero_copy_only=False).tolist()
        flat, _ = self._alone([" " + " ".join(words[at : at + JOINED]) for at in range(0, len(words), JOINED)])
        ends = np.cumsum(pc.binary_length(strings).to_numpy().astype(np.int64) + 1)
        token_ends = np.cumsum(self.widths[flat])
        last = np.searchsorted(token_ends, ends)
        if not np.array_equal(token_ends[last], ends):
            raise ValueError("a token reaches across a blank")
        return flat, np.diff(last, prepend=-1)

    def _coded(self, kind: int, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self._together(strings) if kind == AFTER_BLANK else self._alone(strings.to_pylist())

    def _learn(self, kind: int, strings: pa.Array) -> np.ndarray:
        """Numbers of different strings in a place, each encoded if it is new.

        One behind a blank that ends in marks after a letter is put together from the ids of both parts.
        """
        lengths = pc.binary_length(strings).to_numpy()
        found = np.full(len(strings), -1, dtype=np.int64)
        short = lengths <= PACKED
        found[short] = self.short.find(_packed(strings.filter(pa.array(short)), kind))
        if not short.all():
            known = self.others[kind]
            found[~short] = [known.get(name, -1) for name in strings.filter(pa.array(~short)).to_pylist()]
        new = found < 0
        if not new.any():
            return found
        long = new & (lengths > LONGEST_REMEMBERED)
        if long.any():
            found[long] = self._pass(*self._coded(kind, strings.filter(pa.array(long))))
            new &= ~long
        unknown = np.flatnonzero(new)
        fresh = strings.take(pa.array(unknown))
        stems = pc.utf8_rtrim(fresh, characters=_MARKS) if kind == AFTER_BLANK else fresh
        marked = pc.and_(pc.not_equal(stems, fresh), pc.match_substring_regex(stems, r"\pL\z")).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~marked)
        if len(plain):
            wholes = fresh.take(pa.array(plain))
            found[unknown[plain]] = self._remember(*self._coded(kind, wholes))
            self._keep(kind, wholes, found[unknown[plain]])
        both = np.flatnonzero(marked)
        if len(both):
            wholes, stems = fresh.take(pa.array(both)), stems.take(pa.array(both))
            pairs = zip(wholes.to_numpy(zero_copy_only=False), stems.to_numpy(zero_copy_only=False), strict=True)
            marks = pa.array([whole[len(stem) :] for whole, stem in pairs], pa.string())
            parts = np.stack([self._learn_all(AFTER_BLANK, stems), self._learn_all(ALONE, marks)], axis=1).reshape(-1)
            flat = _gather(self.flat, self.begins[parts], self.lengths[parts])
            found[unknown[both]] = self._remember(flat, self.lengths[parts].reshape(-1, 2).sum(axis=1))
            self._keep(kind, wholes, found[unknown[both]])
        return found

    def _keep(self, kind: int, strings: pa.Array, numbers: np.ndarray) -> None:
        """Note the numbers of new strings."""
        short = pc.binary_length(strings).to_numpy() <= PACKED
        self.short.add(_packed(strings.filter(pa.array(short)), kind), numbers[short])
        self.others[kind].update(zip(strings.filter(pa.array(~short)).to_pylist(), numbers[~short].tolist(), strict=True))

    def _learn_all(self, kind: int, strings: pa.Array) -> np.ndarray:
        """The same for strings that may repeat."""
        coded = strings.dictionary_encode()
        return self._learn(kind, coded.dictionary)[coded.indices.to_numpy()]

    def _whole(self, texts: pa.Array) -> pa.Array:
        """Which texts are not to be cut: those with other white space, or with special tokens."""
        if not self.separable:
            return pa.array(np.ones(len(texts), dtype=bool))
        found = pc.match_substring_regex(texts, _UNUSUAL)
        for special in self.specials:
            found = pc.or_(found, pc.match_substring(texts, special))
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, each with the end id; and how many each text has."""
        if not len(texts):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        if len(self.lengths) > REMEMBERED:
            self._forget_rare()
        self.passing = []
        whole = self._whole(texts)
        lines = pc.split_pattern(pc.if_else(whole, "", texts), "\n")
        words = pc.split_pattern(lines.flatten(), " ")
        in_line = pc.list_value_length(words).to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        index, distinct = coded.indices.to_numpy(), coded.dictionary
        # A line's first word stands alone, the others after a blank.
        firsts = np.cumsum(in_line) - in_line
        later = np.ones(len(index), dtype=bool)
        later[firsts] = False
        codes = np.empty(len(index), dtype=np.int64)
        for kind, places in ((AFTER_BLANK, later), (ALONE, firsts)):
            held = index[places]
            used = np.flatnonzero(np.bincount(held, minlength=len(distinct)))
            numbers = np.zeros(len(distinct), dtype=np.int64)
            numbers[used] = self._learn(kind, distinct.take(pa.array(used)))
            codes[places] = numbers[held]
        last_lines = np.cumsum(pc.list_value_length(lines).to_numpy()) - 1
        apart = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        codes[firsts[last_lines[apart]]] = self._learn_all(ALONE, texts.take(pa.array(apart)))
        # Behind each line comes its end, behind a text's last one the end of the document.
        ends = np.ones(len(in_line), dtype=np.int64)
        ends[last_lines] = 0
        order = np.arange(len(in_line))
        sequence = np.empty(len(codes) + len(ends), dtype=np.int64)
        sequence[np.arange(len(codes)) + np.repeat(order, in_line)] = codes
        sequence[np.cumsum(in_line) + order] = ends
        passing = sequence >= PASSING
        self.uses += np.bincount(sequence[~passing], minlength=len(self.uses))
        flat, begins, lengths = self.flat, self.begins, self.lengths
        if passing.any():
            sequence[passing] += len(lengths) - PASSING
            long = np.concatenate([held for _, held in self.passing])
            begins, lengths = np.append(begins, len(flat) + np.cumsum(long) - long), np.append(lengths, long)
            flat = np.concatenate([flat, *(ids for ids, _ in self.passing)])
        taken = lengths[sequence]
        ids = _gather(flat, begins[sequence], taken)
        return ids, np.diff(np.cumsum(taken)[sequence == 0], prepend=0)


def _gather(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``begins``, one after another."""
    shift = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths)
    shift += np.arange(len(shift))
    return flat[shift]


@lru_cache(maxsize=2)
def _tokenizer(path: str, end_id: int) -> Tokenizer:
    return Tokenizer(path, end_id)


def _segment_type(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("segment", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("frequencies", T.BinaryType()),
            T.StructField("blocks", T.ArrayType(T.BinaryType())),
        ]
    )


def _small_batches(batch: pa.RecordBatch) -> Iterator[tuple[list, pa.Array]]:
    """Ids and texts of slices of a batch whose texts together have about ``BATCH_BYTES``."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")))
        yield batch.column(0).slice(begin, end - begin).to_pylist(), batch.column(1).slice(begin, end - begin)
        begin = end


def _segments(tokenizer_path: str, end_id: int, segment_tokens: int, block_tokens: int):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path, end_id)
        part = TaskContext.get().partitionId()
        segment = first = gathered = 0
        names: list = []
        pieces: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            tokens = np.concatenate(pieces)
            table = rans.Table.from_counts(np.bincount(tokens))
            blocks = [rans.encode_block(tokens[at : at + block_tokens], table) for at in range(0, len(tokens), block_tokens)]
            row = (part, segment, first, len(tokens), names, np.concatenate(counts).tolist(), table.to_bytes(), blocks)
            columns = ("part", "segment", "first", "tokens", "ids", "lengths", "frequencies", "blocks")
            kinds = {"part": pa.int32(), "segment": pa.int32(), "ids": pa.list_(id_kind), "blocks": pa.list_(pa.binary())}
            return pa.RecordBatch.from_arrays([pa.array([v], type=kinds.get(n)) for n, v in zip(columns, row, strict=True)], list(columns))

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for ids, texts in _small_batches(batch):
                tokens, lengths = tokenizer.encode(texts)
                names, pieces, counts = [*names, *ids], [*pieces, tokens], [*counts, lengths]
                gathered += len(tokens)
                if gathered >= segment_tokens:
                    yield close()
                    segment, first, gathered, names, pieces, counts = segment + 1, first + gathered, 0, [], [], []
        if names:
            yield close()

    return encode


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    segment_tokens: int = SEGMENT_TOKENS,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, in ascending order of the document ids.

    ``tokenizer_path`` must name the same file on every executor. NULL and empty texts have the end id alone. NULL ids come first; rows that repeat an
    id are all written, in the order of their texts' hashes. An empty table gives an empty table of segments; other columns play no part.
    """
    text = text_of(text_column)
    ordered = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    kind = _segment_type(docs.schema[id_column].dataType)
    encode = _segments(tokenizer_path, end_id, segment_tokens, block_tokens)
    ordered.mapInArrow(encode, kind).write.parquet(path)


def _decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            part, first, ids, lengths, frequencies, blocks = (batch.column(name)[i] for name in ("part", "first", "ids", "lengths", "frequencies", "blocks"))
            table = rans.Table.from_bytes(frequencies.as_py())
            tokens = np.concatenate([rans.decode_block(block, table) for block in blocks.as_py()]).astype("<u4")
            counts = np.array(lengths.as_py(), dtype=np.int64)
            starts = np.cumsum(counts) - counts
            if int(counts.sum()) != len(tokens):
                raise ValueError("damaged segment")
            offsets = pa.py_buffer(np.append(starts * 4, len(tokens) * 4).astype(np.int32).tobytes())
            values = pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets, pa.py_buffer(tokens.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.as_py()] * len(counts), pa.int32()), ids.values, pa.array(starts + first.as_py()), pa.array(counts), values],
                ["part", "doc_id", "start", "n_tokens", "token_ids"],
            )


def read_tokens(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """What the files hold, one row per document: id, ``start`` (tokens of all documents before it), ``n_tokens``, ``token_ids``.

    ``token_ids`` are little-endian unsigned 32-bit integers. A block that is damaged fails the read.
    """
    segments = spark.read.parquet(path)
    id_type = segments.schema["ids"].dataType.elementType
    kind = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("doc_id", id_type),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("token_ids", T.BinaryType()),
        ]
    )
    # One row per file of the table goes through this window.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.groupBy("part").agg(F.sum("tokens").alias("size"))
    offsets = stage(sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")), "offsets")
    decoded = segments.mapInArrow(_decode, kind)
    return decoded.join(size_guarded(offsets), "part").select(
        F.col("doc_id").alias(id_column), (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "token_ids"
    )
