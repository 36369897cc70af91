"""Near-duplicates by SimHash fingerprints, found over pigeonhole blocks.

Fingerprints are cut into blocks. Two that differ in at most ``distance`` bits agree on all blocks but ``distance`` of them, so they share at least one
choice of the other blocks as join key. More blocks give longer keys: their number follows from that of the fingerprints, so that a key
holds few by chance; the links found are the same for any number.

A key with many fingerprints is not expanded into pairs. Its members are dealt once more, by blocks of the bits that the key leaves out. Keys that stay crowded hold dense points, and
these are linked through midpoints: two fingerprints are within an even
distance of each other exactly if some 64-bit word is within half of it of both. Every such member lists those words, and members with a word in common
are linked to the smallest of them. That loses no link and gives rows in proportion to the members.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityloom.llm.common import size_guarded, text_of
from cityloom.llm.components import components
from cityloom.session import stage

SEED = 42
#: Members of a join key beyond which they are not expanded into pairs.
PAIRED_MEMBERS = 32
#: By so many blocks more than the distance a crowded key is dealt once more.
FINER_BLOCKS = 2
#: Bytes of a text that are worked on at a time, and shingles whose bits are added at a time.
STRETCH = 1 << 20
_CHUNK = 1 << 16
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint as an unsigned number; 0 for a text without words.

    A-Z count as lower case; words are what ASCII white space separates; a text of fewer words than a shingle is one shingle.
    """
    ones, total, words = np.zeros(64, dtype=np.int64), 0, []
    for part in _stretches((text or "").encode().lower()):
        words += part.split()
        if len(words) >= shingle:
            total += _add_bits(words, shingle, ones)
            words = words[len(words) - shingle + 1 :]
    if not total and words:
        total = _add_bits(words, len(words), ones)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _stretches(data: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a word does."""
    begin = 0
    while begin < len(data):
        space = _SPACE.search(data, begin + STRETCH)
        end = space.start() if space else len(data)
        yield data[begin:end]
        begin = end


def _add_bits(words: list[bytes], size: int, ones: np.ndarray) -> int:
    """Add how often each bit is set in the hashes of the shingles; returns the number of shingles."""
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1]
    bounds = zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in bounds], dtype="<u8")
    for at in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return len(hashes)


def _fingerprints(shingle: int):
    @F.pandas_udf("long")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.fromiter((fingerprint(text, shingle) for text in texts), dtype=np.uint64, count=len(texts))
            yield pd.Series(values.view(np.int64))

    return signed


def _blocks(points: int, distance: int) -> int:
    """Blocks to cut into: the fewest whose join keys have as many values as there are fingerprints."""
    most = 2 * distance + 2
    return next((n for n in range(distance + 1, most) if 1 << (64 // n * (n - distance)) >= points), most)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _masks(blocks: int, distance: int) -> list[int]:
    """For each choice of blocks that agree, the bits of its join key."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(kept) for kept in combinations(parts, blocks - distance)]
    assert len(masks) == comb(blocks, distance)
    return [_signed(mask) for mask in masks]


def _midpoints(members: DataFrame, radius: int) -> DataFrame:
    """All words within ``radius`` bits of each member."""
    words = members.select("point", F.col("point").alias("word"), F.lit(-1).alias("last"))
    result = words
    for _ in range(radius):
        words = words.select("point", "word", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"), "last").where("bit > last")
        flipped = F.col("word").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit")))
        words = words.select("point", flipped.alias("word"), F.col("bit").alias("last"))
        result = result.union(words)
    return result


def _finer_masks(mask: int, distance: int) -> list[int]:
    """The bits that a key leaves out, cut into blocks once more: for each choice of blocks that agree, their bits."""
    left = [bit for bit in range(64) if not mask >> bit & 1]
    blocks = min(len(left), distance + FINER_BLOCKS)
    if blocks <= distance:
        return []
    edges = [len(left) * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << bit for bit in left[edges[i] : edges[i + 1]]) for i in range(blocks)]
    return [_signed(sum(kept)) for kept in combinations(parts, blocks - distance)]


def _near_pairs(members: DataFrame, distance: int, *key: str) -> DataFrame:
    left, right = (members.select(*key, F.col("point").alias(name)) for name in "ab")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return left.join(right, list(key)).where((F.col("a") > F.col("b")) & near).select("a", "b")


def _by_size(keyed: DataFrame, label: str, paired_members: int, *key: str) -> tuple[DataFrame, DataFrame]:
    """Points of keys that several share: those of keys with few of them, and those of crowded ones."""
    shared = stage(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).where("members > 1"), f"{label}-keys")
    members = stage(keyed.join(size_guarded(shared), list(key)), f"{label}-members")
    few = F.col("members") <= paired_members
    return members.where(few), members.where(~few)


def near_links(points: DataFrame, distance: int, paired_members: int = PAIRED_MEMBERS) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all within ``distance`` bits of each other.

    ``points`` is a staged table of distinct bigint values in column ``point``. Every link joins two that are near. The points of a crowded key are dealt once more, by blocks of the bits
    that the key leaves out, of which near ones share a choice, too. Only of what stays crowded, points that are dense, not every near pair is listed, but all are connected, through the words between them. ``distance`` is even.
    """
    if distance < 0 or distance % 2:
        raise ValueError("the distance must be even")
    masks = _masks(_blocks(points.count(), distance), distance)
    keys = [F.struct(F.lit(i).alias("choice"), F.col("point").bitwiseAND(F.lit(mask)).alias("key")) for i, mask in enumerate(masks)]
    keyed = points.select("point", F.explode(F.array(*keys)).alias("k")).select("point", "k.*")
    paired, crowded = _by_size(keyed, "block", paired_members, "choice", "key")
    links = _near_pairs(paired, distance, "choice", "key")
    if not crowded.isEmpty():
        finer = [(i, sub, bits) for i, mask in enumerate(masks) for sub, bits in enumerate(_finer_masks(mask & (1 << 64) - 1, distance))]
        # As many rows as choices of blocks, whatever the points.
        finer = F.broadcast(points.sparkSession.createDataFrame(finer, "choice int, sub int, bits bigint"))
        again = crowded.join(finer, "choice").select("choice", "key", "sub", F.col("point").bitwiseAND(F.col("bits")).alias("subkey"), "point")
        finer_paired, dense = _by_size(again, "finer", paired_members, "choice", "key", "sub", "subkey")
        links = links.union(_near_pairs(finer_paired, distance, "choice", "key", "sub", "subkey"))
        middle = stage(_midpoints(dense.select("point").distinct(), distance // 2), "midpoints")
        least = middle.groupBy("word").agg(F.min("point").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("word", "b")
        links = links.union(middle.join(least, "word").where("point > b").select(F.col("point").alias("a"), "b"))
    return links.distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, id_column: str = "doc_id", text_column: str = "text", paired_members: int = PAIRED_MEMBERS
) -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` (bigint), ``component_id``, the smallest id that a chain of near fingerprints reaches.

    Texts without words, NULL included, have fingerprint 0, which links like any other. Equal fingerprints are one point, so copies cost no links. A NULL
    id is smaller than none: a component has id NULL only if all its ids are. Rows that repeat an id are rows of the result.
    An empty table gives no rows; other columns of ``docs`` play no part.
    """
    prints = docs.select(F.col(id_column).alias("doc_id"), _fingerprints(shingle)(text_of(text_column)).alias("point"))
    prints = stage(prints, "prints")
    points = stage(prints.groupBy("point").agg(F.min("doc_id").alias("least_id")), "points")
    rooted = stage(components(near_links(points, distance, paired_members)), "roots")
    placed = points.join(rooted, points["point"] == rooted["node"], "left").select(
        points["point"], "least_id", F.coalesce("root", points["point"]).alias("root")
    )
    lowest = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = stage(placed.join(lowest, "root").select("point", "component_id"), "named")
    return prints.join(size_guarded(named), "point").select(
        F.col("doc_id").alias(id_column), F.col("point").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose id is the smallest of their component.

    Rows with NULL ids stay only where their whole component has none; rows that repeat the staying id all stay.
    """
    found = near_duplicates(docs, shingle, distance, id_column, text_column)
    stays = F.bool_or(F.col(id_column).eqNullSafe(F.col("component_id")))
    # The ids that go are the fewer ones: texts are shuffled only where even these are too many for a broadcast.
    gone = found.groupBy(F.col(id_column).alias("__id")).agg(stays.alias("stays")).where("NOT stays").select("__id")
    gone = size_guarded(stage(gone, "gone"))
    return docs.join(gone, docs[id_column].eqNullSafe(gone["__id"]), "left_anti")


def hex_fingerprint(column: str = "fingerprint") -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
