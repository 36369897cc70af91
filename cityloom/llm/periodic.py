"""Periodic runs of words, found by recompression.

The words of a batch of texts, with a mark of its own between any two texts, are compressed in turns: a block of equal symbols becomes one symbol, then
pairs of neighbors are replaced, the symbols being dealt at random to a left and a right side and a pair being a left one before a right one. Equal stretches are
compressed alike but for their edges, so the rounds make a run-length grammar in which two symbols are equal if and only if they stand for the same words. A longest
common extension of two places climbs the levels of the grammar while the symbols agree and descends where they differ, a bounded number of
steps on each level. It is exact whatever the dealing; only the number of steps depends on chance.

A run with period q spans two periods at least, so of the places at multiples of q one lies in it whose partner q words on lies in it, too. Such pairs with equal words are
the candidates; their extensions to both sides give every run, and multiples of a period give the same stretch, of which the smallest period stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityloom.llm.common import text_of

LEAST_LENGTH = 12
#: Bytes of text that one grammar is made for, and candidates that are extended at a time.
BATCH_BYTES = 1 << 21
EXTENDED = 1 << 20
#: Up to so many words the grid of candidates is taken from a table, beyond it is walked period by period.
TABLED = 1 << 12


class _Level:
    """Symbols of a level, and how they join into those of the next one."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, blocks: bool):
        self.symbols = symbols
        self.first = first
        self.last = np.append(first[1:], True)
        #: Symbol of the next level that a symbol is part of; first symbol of each of those.
        self.up = (np.cumsum(first) - 1).astype(np.int32)
        self.down = np.append(np.flatnonzero(first), len(symbols)).astype(np.int32)
        #: Equal symbols from a place on to the right and to the left, where blocks were joined.
        self.ahead = self.behind = None
        if blocks:
            at = np.arange(len(symbols), dtype=np.int32)
            self.ahead, self.behind = self.down[self.up + 1] - at, at - self.down[self.up] + 1


class Grammar:
    """A run-length grammar of a sequence of numbers, made by alternating block and pair compression."""

    def __init__(self, symbols: np.ndarray, seed: int = 7):
        self.levels: list[_Level] = []
        fresh, dealt = int(symbols.max(initial=0)) + 1, np.random.default_rng(seed)
        symbols = symbols.astype(np.int32)
        while len(symbols) > 1:
            apart = np.append(True, symbols[1:] != symbols[:-1])
            if not apart.all():
                symbols, fresh = self._join_blocks(symbols, apart, fresh)
                continue
            side = (symbols.astype(np.uint64) * np.uint64(dealt.integers(1, 1 << 62) * 2 + 1)) >> np.uint64(63) == 0
            left = np.flatnonzero(side[:-1] & ~side[1:])
            if len(left):
                symbols, fresh = self._join_pairs(symbols, left, fresh)
        self.levels.append(_Level(symbols, np.ones(len(symbols), dtype=bool), False))

    def _join_blocks(self, symbols: np.ndarray, first: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        level = _Level(symbols, first, True)
        self.levels.append(level)
        joined, sizes = symbols[level.down[:-1]], np.diff(level.down).astype(np.int64)
        several = np.flatnonzero(sizes > 1)
        kinds, names = np.unique(joined[several].astype(np.int64) * (int(sizes.max()) + 1) + sizes[several], return_inverse=True)
        joined[several] = fresh + names
        return joined, fresh + len(kinds)

    def _join_pairs(self, symbols: np.ndarray, left: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        first = np.ones(len(symbols), dtype=bool)
        first[left + 1] = False
        level = _Level(symbols, first, False)
        self.levels.append(level)
        joined = symbols[level.down[:-1]]
        kinds, names = np.unique(symbols[left].astype(np.int64) * fresh + symbols[left + 1], return_inverse=True)
        joined[level.up[left]] = fresh + names
        return joined, fresh + len(kinds)

    def extension(self, a: np.ndarray, b: np.ndarray, step: int = 1) -> np.ndarray:
        """How many symbols agree from the different places a and b on, to the right, or to the left with a ``step`` of -1.

        A symbol that occurs only once has to stand somewhere on the way of each pair.
        """
        begin, query = a, np.arange(len(a))
        stopped: list[list[tuple[np.ndarray, ...]]] = [[] for _ in self.levels]
        for k, level in enumerate(self.levels):
            edge = level.first if step > 0 else level.last
            climbing = []
            while len(query):
                (query, a, b), differ = self._part(level, query, a, b)
                stopped[k].append(differ)
                climbs = edge[a] & edge[b]
                climbing.append((query[climbs], level.up[a[climbs]], level.up[b[climbs]]))
                query, a, b = query[~climbs], a[~climbs], b[~climbs]
                a, b = self._ahead(level, a, b, step)
            query, a, b = _joined(climbing)
        length = np.zeros(len(begin), dtype=np.int64)
        query, a, b = _joined([])
        for k in range(len(self.levels) - 1, -1, -1):
            level, found = self.levels[k], stopped[k]
            while len(query):
                (query, a, b), differ = self._part(level, query, a, b)
                found.append(differ)
                a, b = self._ahead(level, a, b, step)
            query, a, b = _joined(found)
            if k:
                below = self.levels[k - 1].down
                a, b = (below[a], below[b]) if step > 0 else (below[a + 1] - 1, below[b + 1] - 1)
        length[query] = (a - begin[query]) * step
        return length

    @staticmethod
    def _part(level: _Level, query: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """Queries whose symbols agree, and the others."""
        same = level.symbols[a] == level.symbols[b]
        return (query[same], a[same], b[same]), (query[~same], a[~same], b[~same])

    @staticmethod
    def _ahead(level: _Level, a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """The places behind what is known to agree: a symbol, or what both blocks have left of it."""
        equal = level.ahead if step > 0 else level.behind
        far = step if equal is None else step * np.minimum(equal[a], equal[b])
        return a + far, b + far


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _table(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all places up to ``size``, in ascending order, each with its divisors: places, divisors, and how many pairs the places before each number have."""
    divisors = np.concatenate([np.full((size - 1) // p, p, dtype=np.int32) for p in range(1, size)])
    places = np.concatenate([np.arange(p, size, p, dtype=np.int32) for p in range(1, size)])
    order = np.argsort(places, kind="stable")
    return places[order], divisors[order], np.searchsorted(places[order], np.arange(size + 1))


_TABLE: list[tuple[np.ndarray, ...]] = []


def _grid(symbols: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place, period) of all texts: places at multiples of a period whose partners one period before hold the same word."""
    if not _TABLE:
        _TABLE.append(_table(TABLED))
    places, divisors, upto = _TABLE[0]
    short = np.flatnonzero((counts >= LEAST_LENGTH) & (counts < TABLED))
    sizes = upto[counts[short]]
    ends = np.cumsum(sizes)
    at = 0
    while at < len(short):
        upper = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + EXTENDED, side="right")))
        size, chosen = sizes[at:upper], short[at:upper]
        entry = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        period, place = divisors[entry], places[entry] + np.repeat(begins[chosen], size)
        kept = np.flatnonzero((symbols[place] == symbols[place - period]) & (2 * period <= np.repeat(counts[chosen], size)))
        yield place[kept], period[kept]
        at = upper
    for text in np.flatnonzero(counts >= TABLED):
        words = symbols[begins[text] : begins[text] + counts[text]]
        found, gathered = [], 0
        for period in range(1, int(counts[text]) // 2 + 1):
            grid = words[::period]
            same = np.flatnonzero(grid[1:] == grid[:-1])
            if len(same):
                found.append((begins[text] + (same + 1) * period, np.full(len(same), period)))
                gathered += len(same)
            if gathered >= EXTENDED:
                yield _joined(found)
                found, gathered = [], 0
        if found:
            yield _joined(found)


def find_runs(symbols: np.ndarray, begins: np.ndarray, counts: np.ndarray, least: int = LEAST_LENGTH) -> np.ndarray:
    """All runs of texts that lie in one sequence, as rows (start, length, period) by start and period.

    ``symbols`` has a number that occurs only once before the first text, between texts, and behind the last one.
    """
    found = [np.zeros((0, 3), dtype=np.int64)]
    grammar = None
    for place, period in _grid(symbols, begins, counts):
        if not len(place):
            continue
        grammar = grammar or Grammar(symbols)
        for at in range(0, len(place), EXTENDED):
            b, q = place[at : at + EXTENDED].astype(np.int32), period[at : at + EXTENDED].astype(np.int32)
            a = b - q
            ahead, behind = grammar.extension(a, b), grammar.extension(a - 1, b - 1, -1)
            length = ahead + behind + q
            runs = np.flatnonzero((length >= 2 * q) & (length >= least))
            rows = np.stack([(a - behind)[runs], length[runs], q[runs]], axis=1).astype(np.int64)
            found.append(_smallest_periods(rows))
    return _smallest_periods(np.concatenate(found))


def _smallest_periods(rows: np.ndarray) -> np.ndarray:
    """Of the rows with one start and length that with the smallest period."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    kept = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]
    rows = rows[kept]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


_TYPE = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def _analysed(texts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Words of each text, its runs, their rows, and its words without what a run repeats."""
    words = [text.split() for text in texts]
    counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    numbers: dict[bytes, int] = {}
    flat = np.fromiter((numbers.setdefault(word, len(numbers)) for word in chain.from_iterable(words)), dtype=np.int64, count=int(counts.sum()))
    begins = np.cumsum(counts) - counts + np.arange(len(counts)) + 1
    symbols = np.empty(len(flat) + len(counts) + 1, dtype=np.int64)
    symbols[np.append(0, begins + counts)] = len(numbers) + np.arange(len(counts) + 1)
    symbols[np.arange(len(flat)) + np.repeat(np.arange(len(counts)), counts) + 1] = flat
    runs = find_runs(symbols, begins, counts, least)
    owner = np.searchsorted(begins, runs[:, 0], side="right") - 1
    covered = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(covered) == 0
    with_runs = set(owner.tolist())
    left = [
        b" ".join(compress(own, kept[begin : begin + len(own)].tolist()) if i in with_runs else own)
        for i, (own, begin) in enumerate(zip(words, begins.tolist(), strict=True))
    ]
    runs[:, 0] -= begins[owner]
    return counts, np.bincount(owner, minlength=len(counts)), runs, left


def _arrays(texts: pa.Array, least: int) -> pa.Array:
    counts, sizes, runs, left = _analysed(pc.cast(texts, pa.binary()).to_pylist(), least)
    rows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, i])) for i in range(3)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), rows)
    return pa.StructArray.from_arrays([pa.array(counts), lists, pa.array([text.decode() for text in left], pa.string())], ["n_words", "runs", "collapsed"])


def periodic_runs(text: str | Column, least: int = LEAST_LENGTH) -> Column:
    """Words, runs and the text without repetitions of each whole text.

    ``runs`` has start (number of the word, from 0), length and smallest period, in words, of every stretch of ``least`` words or more, and of two periods or more, that no
    neighboring word extends with that period; by start, then period. ``collapsed`` has the words that are in no run, or in the first period of all
    runs they are in, with single blanks between them. Words are parted by ASCII white space. NULL and empty texts have no words and no runs.
    """

    @F.arrow_udf(_TYPE)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch).to_numpy().astype(np.int64))
            at, parts = 0, []
            while at < len(batch):
                upper = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_BYTES, side="right")))
                parts.append(_arrays(batch.slice(at, upper - at), least))
                at = upper
            yield pa.concat_arrays(parts) if parts else _arrays(batch, least)

    return found(text_of(text))


def with_runs(docs: DataFrame, text_column: str | Column = "text", result: str = "runs", least: int = LEAST_LENGTH) -> DataFrame:
    """``docs`` with the runs of each text (see ``periodic_runs``) in a column that replaces one of its name.

    Every text stands alone, so repeated rows and ties need no rule; an empty table stays empty. A text is worked on by one task, in memory of some 200 bytes a word.
    """
    return docs.withColumn(result, periodic_runs(text_column, least))


def longest(runs: str | Column) -> Column:
    """The run with the greatest length; of several the one that starts first, then that of the smallest period. NULL without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period"))
