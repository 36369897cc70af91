import random

import pytest
import xxhash
from messy import CASES, empty, messy

from cityloom.llm import simhash
from cityloom.llm.components import components
from cityloom.llm.simhash import _blocks, _masks, fingerprint, hex_fingerprint, near_duplicates, near_links, one_of_each
from pyspark.sql import functions as F


def slow_fingerprint(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(points, distance):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in points:
        for b in points:
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


def clustered(seed, centers, each, flips):
    chosen = random.Random(seed)
    points = set()
    for _ in range(centers):
        center = chosen.getrandbits(64)
        for _ in range(each):
            point = center
            for _ in range(chosen.randrange(flips + 1)):
                point ^= 1 << chosen.randrange(64)
            points.add(point - (1 << 64) if point >> 63 else point)
    return sorted(points)


@pytest.mark.parametrize("size", [1, 4])
@pytest.mark.parametrize("stretch", [1, 20, 1 << 20])
def test_fingerprints_equal_the_definition(size, stretch, monkeypatch):
    monkeypatch.setattr(simhash, "STRETCH", stretch)
    for _, text in CASES:
        assert fingerprint(text, size) == slow_fingerprint(text, size)


@pytest.mark.parametrize(("distance", "paired"), [(4, 32), (4, 1), (2, 1), (0, 1)])
def test_links_connect_all_near_points_and_no_others(spark, distance, paired):
    points = clustered(distance + paired, 12, 25, 3)
    frame = spark.createDataFrame([(p,) for p in points], "point bigint")
    links = near_links(frame, distance, paired)
    far = links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > distance)
    assert far.count() == 0
    got = {r.node: r.root for r in components(links).collect()}
    assert {p: got.get(p, p) for p in points} == roots(points, distance)


def test_a_crowded_key_of_scattered_points_needs_no_midpoints(spark, monkeypatch):
    chosen = random.Random(6)
    # All share a third of their bits, so that keys are crowded, and pairs of them are near.
    low = chosen.getrandbits(24)
    points = {low | chosen.getrandbits(40) << 24 for _ in range(150)}
    points |= {p ^ 1 << chosen.randrange(24, 64) ^ 1 << chosen.randrange(24, 64) for p in list(points)[:60]}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in points)
    staged = {}
    inner = simhash.stage
    monkeypatch.setattr(simhash, "stage", lambda df, label: staged.setdefault(label, inner(df, label)))
    links = near_links(spark.createDataFrame([(p,) for p in signed], "point bigint"), 4, 32)
    got = {r.node: r.root for r in components(links).collect()}
    assert {p: got.get(p, p) for p in signed} == roots(signed, 4)
    assert staged["midpoints"].count() == 0 < staged["finer-members"].count()


def test_finer_blocks_cover_the_distance():
    for mask in (m % (1 << 64) for m in _masks(6, 4)):
        left = [bit for bit in range(64) if not mask >> bit & 1]
        finer = [m % (1 << 64) for m in simhash._finer_masks(mask, 4)]
        assert all(not m & mask and m for m in finer)
        chosen = random.Random(mask)
        for _ in range(100):
            flipped = sum(1 << b for b in chosen.sample(left, 4))
            assert any(not flipped & m for m in finer)


def test_odd_distances_are_refused(spark):
    with pytest.raises(ValueError):
        near_links(spark.range(3).toDF("point"), 3)


def test_every_choice_of_blocks_covers_the_distance():
    for points in (10, 10**6, 10**10):
        blocks = _blocks(points, 4)
        masks = [m % (1 << 64) for m in _masks(blocks, 4)]
        assert all(m.bit_count() >= (blocks - 4) * (64 // blocks) for m in masks)
        chosen = random.Random(points)
        for _ in range(200):
            flipped = sum(1 << b for b in chosen.sample(range(64), 4))
            assert any(not flipped & m for m in masks)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, i) for i in range(1001, 1300)]
    rows = components(spark.createDataFrame([*chain, *star, *star, (5, 5)], "a bigint, b bigint")).collect()
    got = {r.node: r.root for r in rows}
    assert len(rows) == len(got)
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1300)}}


def test_groups_of_messy_rows(spark):
    rows = near_duplicates(messy(spark), 4, 4).withColumn("hex", hex_fingerprint()).collect()
    assert len(rows) == len(CASES)
    prints = [f"{slow_fingerprint(t, 4):016x}" for _, t in CASES]
    assert sorted(r.hex for r in rows) == sorted(prints)
    by_id = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by_id[3] == by_id[4] == by_id[5] == 3 and by_id[2] == by_id[1] == 1 and by_id[7] == 6
    kept = one_of_each(messy(spark))
    assert kept.columns == messy(spark).columns
    assert {3, 1, 6, 8, 9} == {r.doc_id for r in kept.collect() if r.doc_id is not None}


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).collect() == []
    assert one_of_each(empty(spark)).collect() == []
