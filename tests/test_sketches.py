import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cityloom.operators import shape
from cityloom.operators.indicators import top_groups, top_groups_sketched


@pytest.mark.parametrize(("kinds", "tracked", "buckets"), [(5, 100, 64), (3000, 10, 16), (3000, 50, 1 << 12), (40, 10, 4)])
def test_top_lists_equal_the_exact_ones(spark, kinds, tracked, buckets):
    rng = random.Random(kinds + tracked)
    values = [None if rng.random() < 0.1 else f"k{min(int(rng.paretovariate(0.6)), kinds)}" for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "key string").repartition(5)
    for n in (1, 5, 60):
        assert top_groups_sketched(df, "key", n, tracked, buckets).collect() == top_groups(df, "key", n).collect()


def test_top_lists_of_little(spark):
    empty = spark.createDataFrame([], "key int")
    assert top_groups_sketched(empty, "key").collect() == []
    ones = spark.createDataFrame([(None,), (None,), (3,)], "key int")
    assert [tuple(r) for r in top_groups_sketched(ones, "key").collect()] == [(None, 2), (3, 1)]


def test_counted_rows_do_not_grow_with_the_keys(spark, monkeypatch):
    from cityloom.operators import indicators

    staged = {}
    inner = indicators.stage
    monkeypatch.setattr(indicators, "stage", lambda df, label: staged.setdefault(label, []).append(inner(df, label)) or staged[label][-1])
    for size in (2_000, 40_000):
        df = spark.range(size).select(F.when(F.col("id") % 4 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"))
        assert top_groups_sketched(df, "key", 1, 10, 256).first().key == -1
    assert max(found.count() for found in staged["candidate-counts"]) <= 10 + 256


def test_profiles_merge(spark):
    df = spark.range(5000).select(
        "id", (F.col("id") % 50).cast("string").alias("text"), F.when(F.col("id") % 5 > 0, F.col("id") / 2).alias("half"), F.lit(None).cast("double").alias("void"), F.array("id").alias("list"),
        F.struct("id").alias("a.b"), F.create_map("id", "id").alias("map"), (F.col("id") % 2 == 0).alias("flag"),
    )
    state = shape.profile_state(df)
    least = {r.column_name: (r.least, r.greatest) for r in state.collect()}
    assert least["id"] == ("0", "4999") and least["text"] == ("0", "9") and least["list"] == (None, None)
    common = ["column_name", "n_rows", "nulls", "distinct", "quantiles"]
    parts = [shape.profile_state(df.where(f"id % 3 = {i}")).select(*common) for i in range(3)]
    merged = shape.merged_profiles(parts[0].union(parts[1]).union(parts[2]))
    for found in (shape.column_profile(state), shape.column_profile(merged)):
        by = {r.column_name: r for r in found.collect()}
        assert set(by) == set(df.columns)
        assert (by["id"].n_rows, by["id"].nulls, by["half"].nulls, by["void"].nulls) == (5000, 0, 1000, 5000)
        assert by["void"].distinct == 0 and by["void"].median is None and by["text"].median is None
        assert abs(by["id"].distinct - 5000) < 250 and abs(by["text"].distinct - 50) < 3 and by["flag"].distinct == 2
        assert abs(by["id"].median - 2500) < 150 and abs(by["half"].low_quartile - 625) < 60
        assert abs(by["map"].distinct - 5000) < 250 and abs(by["a.b"].distinct - 5000) < 250
    empty = shape.column_profile(shape.profile_state(df.limit(0)))
    assert {(r.n_rows, r.nulls, r.distinct, r.median) for r in empty.collect()} == {(0, 0, 0, None)}
    assert len(rows(empty)) == len(df.columns)
