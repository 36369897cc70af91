import zlib
from collections import defaultdict

from messy import CASES, empty, messy

from cityloom.llm.shards import FIRST_JUMPS, assign_shards, jump_shard


def jump(key, shards):
    key, b, j = (key or 0) % (1 << 64), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jumps_equal_the_published_loop(spark):
    keys = [None, 0, 1, -1, 7, 2**63 - 1, -(2**63), *range(1000, 1200)]
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for shards in (1, 2, 16, FIRST_JUMPS + 1, 1000):
        got = {r.k: r.s for r in frame.select("k", jump_shard("k", shards).alias("s")).collect()}
        assert got == {k: jump(k, shards) for k in keys}


def test_one_more_shard_takes_rows_into_itself_only(spark):
    rows = assign_shards(spark.range(5000).selectExpr("id AS doc_id", "'x' AS text"), 16).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {16}
    assert 0.04 < len(moved) / 5000 < 0.08
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.shard] += 1
    assert len(sizes) == 16 and max(sizes.values()) < 1.3 * 5000 / 16


def test_slots_have_no_gaps_and_follow_the_ids(spark):
    rows = assign_shards(messy(spark).repartition(5), 2).collect()
    assert len(rows) == len(CASES)
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    for shard in by_shard.values():
        shard.sort(key=lambda r: r.slot)
        assert [r.slot for r in shard] == list(range(len(shard)))
        ids = [-1 if r.doc_id is None else r.doc_id for r in shard]
        assert ids == sorted(ids)
    checks = sorted((r.size, r.text_crc32) for r in rows)
    assert checks == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in CASES)


def test_empty_table(spark):
    assert assign_shards(empty(spark), 16).collect() == []
