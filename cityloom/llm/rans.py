"""Static range asymmetric numeral system over arrays of token ids.

Token t of a block belongs to lane t mod ``lanes``; all lanes step together as one numpy vector. A lane's state is a 64-bit number that
gives off or takes in 32 bits at a time. The encoder runs backwards; every ``CHECKPOINT`` steps it notes all states and how many words
of the stream lie behind, so that a decoder can begin there, and all stretches between checkpoints can be decoded at the same time.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Frequencies of a table add up to 2 to this power.
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
#: Steps between two places at which a decoder can begin.
CHECKPOINT = 256
MOST_LANES = 1024
MAGIC = b"rans1"


class Table:
    """Frequencies of the ids that occur, scaled so that they add up to 2**SCALE_BITS and none is 0."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray):
        self.symbols = symbols
        self.frequencies = frequencies.astype(np.uint64)
        self.begins = np.cumsum(self.frequencies) - self.frequencies
        #: Index of each id, for encoding.
        self.index = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 1, dtype=np.int32)
        self.index[symbols] = np.arange(len(symbols))
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        """Which symbol each of the 2**SCALE_BITS values stands for; built for decoding only."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.symbols), dtype=np.int32), self.frequencies.astype(np.int64))
        return self._slots

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Table:
        """The table of how often each id occurs."""
        symbols = np.flatnonzero(counts)
        occurs = counts[symbols]
        if len(symbols) > 1 << SCALE_BITS:
            raise ValueError("more different ids than the table can tell apart")
        total = int(occurs.sum())
        scaled = np.maximum(occurs * float(1 << SCALE_BITS) / max(total, 1), 1).astype(np.int64)
        excess = int(scaled.sum()) - (1 << SCALE_BITS) if len(symbols) else 0
        # What rounding left over goes to the most frequent; what it took is taken from those that have more than one.
        if excess < 0:
            scaled[np.argmax(scaled)] -= excess
        while excess > 0:
            spare = np.minimum(scaled - 1, np.maximum(scaled * excess // int(scaled.sum()), 1))
            order = np.argsort(-scaled, kind="stable")
            taken = np.minimum(spare[order], np.maximum(excess - (np.cumsum(spare[order]) - spare[order]), 0))
            scaled[order] -= taken
            excess -= int(taken.sum())
        return cls(symbols.astype(np.int64), scaled)

    def to_bytes(self) -> bytes:
        gaps = np.diff(self.symbols, prepend=0).astype("<u4")
        return zlib.compress(np.uint32(len(gaps)).tobytes() + gaps.tobytes() + self.frequencies.astype("<u4").tobytes(), 6)

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        numbers = np.frombuffer(zlib.decompress(data), dtype="<u4")
        n = int(numbers[0])
        return cls(np.cumsum(numbers[1 : n + 1].astype(np.int64)), numbers[n + 1 :].astype(np.int64))


def _lanes(tokens: int) -> int:
    """More lanes make longer vectors; a short block has few, as each costs 8 bytes a checkpoint."""
    return min(MOST_LANES, max(1, tokens // 32))


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """One block: a header, the lane states at each checkpoint, and the stream of 32-bit words."""
    n = len(ids)
    lanes = _lanes(n)
    steps = -(-n // lanes) if n else 0
    index = table.index[ids]
    frequencies, begins = table.frequencies[index], table.begins[index]
    state = np.full(lanes, LOW, dtype=np.uint64)
    limits = frequencies << np.uint64(63 - SCALE_BITS)
    words, counts, states = [], [], []
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min((step + 1) * lanes, n)
        x = state[: b - a]
        full = x >= limits[a:b]
        if full.any():
            words.append(x[full].astype("<u4")[::-1])
            x = np.where(full, x >> WORD, x)
        quotient, rest = np.divmod(x, frequencies[a:b])
        state[: b - a] = (quotient << np.uint64(SCALE_BITS)) + rest + begins[a:b]
        if step % CHECKPOINT == 0:
            states.append(state.copy())
            counts.append(sum(map(len, words)) - sum(counts))
    stream = np.concatenate(words)[::-1] if words else np.zeros(0, dtype="<u4")
    # Words of each stretch, the first stretch first.
    lengths = np.array(counts[::-1], dtype="<u4")
    kept = np.concatenate(states[::-1]).astype("<u8") if states else np.zeros(0, dtype="<u8")
    header = np.array([n, lanes, len(lengths), len(stream)], dtype="<u4")
    body = header.tobytes() + lengths.tobytes() + kept.tobytes() + stream.astype("<u4").tobytes()
    return MAGIC + np.uint32(zlib.crc32(body)).tobytes() + body


def decode_block(data: bytes, table: Table) -> np.ndarray:
    """The ids of a block; raises if its checksum does not hold. All stretches between checkpoints step together."""
    if data[:5] != MAGIC or zlib.crc32(data[9:]) != int(np.frombuffer(data, "<u4", 1, 5)[0]):
        raise ValueError("damaged block")
    n, lanes, stretches, size = np.frombuffer(data, "<u4", 4, 9).tolist()
    if not n:
        return np.zeros(0, dtype=np.int64)
    at = 25
    lengths = np.frombuffer(data, "<u4", stretches, at).astype(np.int64)
    state = np.frombuffer(data, "<u8", stretches * lanes, at + 4 * stretches).reshape(stretches, lanes).astype(np.uint64)
    stream = np.append(np.frombuffer(data, "<u4", size, at + 4 * stretches + 8 * stretches * lanes), np.uint32(0))
    return _decode(n, lanes, np.cumsum(lengths) - lengths, state, stream, table)


def decode_from(data: bytes, table: Table, stretch: int) -> np.ndarray:
    """The ids of a block from one checkpoint to the next, without the rest."""
    n, lanes, stretches, size = np.frombuffer(data, "<u4", 4, 9).tolist()
    lengths = np.frombuffer(data, "<u4", stretches, 25).astype(np.int64)
    states_at = 25 + 4 * stretches
    state = np.frombuffer(data, "<u8", lanes, states_at + 8 * lanes * stretch).reshape(1, lanes).astype(np.uint64)
    begin = int(lengths[:stretch].sum())
    stream = np.frombuffer(data, "<u4", int(lengths[stretch]), states_at + 8 * lanes * stretches + 4 * begin)
    tokens = min(n - stretch * CHECKPOINT * lanes, CHECKPOINT * lanes)
    return _decode(tokens, lanes, np.zeros(1, dtype=np.int64), state, np.append(stream, np.uint32(0)), table)


def _decode(n: int, lanes: int, position: np.ndarray, state: np.ndarray, stream: np.ndarray, table: Table) -> np.ndarray:
    stretches = len(state)
    steps = min(CHECKPOINT, -(-n // lanes))
    out = np.zeros((stretches, steps, lanes), dtype=np.int32)
    slots, frequencies, begins = table.slots, table.frequencies, table.begins
    mask = np.uint64((1 << SCALE_BITS) - 1)
    lane = np.arange(lanes)
    first_of_last = (stretches - 1) * CHECKPOINT * lanes
    last = stretches - 1
    for step in range(steps):
        # Only the last stretch can be shorter than the others.
        left = n - first_of_last - step * lanes
        rows = stretches if left > 0 else last
        if not rows:
            break
        x = state[:rows]
        low = x & mask
        symbol = slots[low]
        x = frequencies[symbol] * (x >> np.uint64(SCALE_BITS)) + low - begins[symbol]
        need = x < LOW
        if 0 < left < lanes:
            idle = lane >= left
            x[last, idle] = state[last, idle]
            need[last, idle] = False
        # The encoder wrote the words of a step from the highest lane down, and all of it backwards.
        order = np.cumsum(need, axis=1)
        row, col = np.nonzero(need)
        x[row, col] = (x[row, col] << WORD) | stream[position[row] + order[row, col] - 1].astype(np.uint64)
        position[:rows] += order[:, -1]
        state[:rows] = x
        out[:rows, step] = symbol
    flat = out.reshape(stretches, steps * lanes)
    if stretches > 1:
        return table.symbols[np.concatenate([flat[:last].reshape(-1), flat[last]])[:n]]
    return table.symbols[flat[0, :n]]
