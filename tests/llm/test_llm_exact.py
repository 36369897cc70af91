import hashlib
import re
from collections import defaultdict

import pytest
from messy import CASES, empty, messy, random_texts

from cityloom.llm import exact
from cityloom.llm.exact import drop_copies, find_copies, twice_set, with_possible_repeats
from pyspark.sql import functions as F


def expected(cases):
    """(doc_id, keep_id, size, sha) of each row, and how many rows of each group stay."""
    groups = defaultdict(list)
    for i, text in cases:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()].append((i, text or ""))
    result = []
    for sha, rows in groups.items():
        keep = min(rows, key=lambda r: (-len(r[1]), r[0] is not None, r[0] or 0))[0]
        result += [(i, keep, len(rows), sha) for i, _ in rows]
    return sorted(result, key=str)


@pytest.mark.parametrize(("bits", "limit"), [(1, None), (8, None), (3000, 20_000)])
def test_groups_equal_brute_force(spark, monkeypatch, bits, limit):
    if limit:
        monkeypatch.setattr(exact, "PAGES_BYTES", limit)
    cases = CASES + [(100 + i, t) for i, t in enumerate(random_texts(1, 200, 3, 5))]
    got = find_copies(messy(spark, cases), bits_per_row=bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(cases)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}
    assert all(r.may_repeat for r in got if r.group_size > 1)


def test_filter_lets_few_single_rows_through(spark):
    hashes = spark.range(20_000).select(F.xxhash64("id").alias("row_hash"))
    flagged = with_possible_repeats(hashes).agg(F.avg(F.col("may_repeat").cast("int"))).first()[0]
    assert flagged < 0.02


def test_filter_keeps_bits_of_repeated_rows_only(spark):
    hashes = spark.createDataFrame([(1,), (2,), (2,)], "row_hash bigint")
    pages = twice_set(hashes, 1 << 20).collect()
    assert len(pages) == 1 and pages[0].page == 2 and 1 <= sum(byte.bit_count() for byte in pages[0].twice) <= 3


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" :+-") for line in plan.split("\n") if "Exchange " in line and "BroadcastExchange" not in line]


def test_no_row_is_shuffled_to_the_filter(spark):
    hashes = spark.range(30_000).select(F.xxhash64(F.col("id") % 29_000).alias("row_hash"))
    whole, ranged = with_possible_repeats(hashes), with_possible_repeats(hashes, pages_bytes=20_000)
    for flagged in (whole, ranged):
        assert exchanges(flagged) == [] and flagged.count() == 30_000
        assert flagged.where("may_repeat").select("row_hash").distinct().count() >= 1000
        repeated = flagged.groupBy("row_hash").agg(F.count(F.lit(1)).alias("n"), F.bool_and("may_repeat").alias("kept")).where("n > 1")
        assert repeated.count() == 1000 and repeated.where("NOT kept").isEmpty()
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") > 2 and "SortMergeJoin" not in plan


def test_dropping_keeps_rows_and_columns(spark):
    docs = messy(spark)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [re.sub(r"\s", "", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted({re.sub(r"\s", "", t or "") for _, t in CASES})


def test_empty_table(spark):
    assert find_copies(empty(spark)).collect() == []
    assert drop_copies(empty(spark)).collect() == []


def test_only_possible_repeats_are_shuffled_by_text(spark, monkeypatch):
    cases = [(i, f"text {i if i > 9 else 0}") for i in range(5000)]
    shuffled = []
    inner = exact.stage

    def staged(df, label):
        if label == "repeated":
            found = [line for line in exchanges(df) if "text_sha256" in line]
            shuffled.append((len(found), df))
        return inner(df, label)

    monkeypatch.setattr(exact, "stage", staged)
    found = find_copies(messy(spark, cases))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and exchanges(found) == []
    assert [n for n, _ in shuffled] == [1]
    # Ten copies, and at most a few others by chance, are grouped.
    assert 10 <= found.where("may_repeat").count() < 60
