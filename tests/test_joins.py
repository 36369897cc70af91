import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from cityloom.operators.lookup import Level, add_name, reconcile
from cityloom.operators.relate import join_keeping_left, left_join_suffixed
from cityloom.operators.skew import hot_keys, is_small, spread_join


def skewed(spark, n=600, seed=1):
    rng = random.Random(seed)
    data = [(rng.choice([7, 7, 7, None, rng.randint(0, 30)]), rng.choice(["x", "y"]), i) for i in range(n)]
    return spark.createDataFrame(data, "k int, j string, v int")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_spread_join_equals_plain_join(spark, how, keys):
    large = skewed(spark)
    small = spark.createDataFrame([(k, j, f"{k}{j}{c}") for k in (7, 3, None, 40) for j in "xy" for c in "ab"], "k int, j string, w string")
    if keys == ["k"]:
        small = small.drop("j")
    plain = large.join(small, keys, how)
    spread = spread_join(large, small, keys, how, hot_rows=50)
    assert rows(spread.select(*plain.columns)) == rows(plain)


def test_hot_and_null_rows_are_spread(spark):
    large = skewed(spark)
    ((key, buckets),) = rows(hot_keys(large, ["k"], 50))
    assert key == 7 and buckets == -(-large.where("k = 7").count() // 50)
    plan = plan_of(spread_join(large, spark.range(5).selectExpr("int(id) AS k", "id AS w"), ["k"], "left", 50))
    assert "_join_salt" in plan and "BroadcastHashJoin" in plan


def test_small_is_measured(spark):
    assert is_small(spark.range(10), 10)
    assert not is_small(spark.range(11), 10)
    assert not is_small(spark.range(1).select(F.repeat(F.lit("x"), 5000).alias("t")), 10)
    assert is_small(spark.range(0), 10)


def lookup(spark, data=(("a", "A!"), ("b", "B!"))):
    return spark.createDataFrame(list(data), "name string, label string")


def test_reconcile(spark):
    df = spark.createDataFrame([("a", 1), ("zz", 2), (None, 3)], "name string, v int")
    got = reconcile(df, Level(lookup(spark), "name", "name", "label", "label"))
    assert rows(got, "v", "name", "label") == [(1, "a", "A!"), (2, "zz", None), (3, None, None)]
    replaced = reconcile(df, Level(lookup(spark), "name", "name", "label", "name"))
    assert rows(replaced, "v", "name") == [(1, "A!"), (2, None), (3, None)]


def test_large_lookup_gives_the_same_without_broadcasting_it(spark):
    df = skewed(spark).withColumn("name", F.col("k").cast("string")).drop("j")
    table = spark.range(20).selectExpr("string(id) AS name", "id * 10 AS label")
    level = Level(table, "name", "name", "label", "label")
    small, large = add_name(df, level), add_name(df, level, max_rows=5, hot_rows=50)
    assert rows(small) == rows(large)
    assert small.count() == df.count()
    assert "_join_salt" in plan_of(large) and "_join_salt" not in plan_of(small)
    assert "BroadcastHashJoin" in plan_of(small)


def test_repeated_lookup_keys(spark):
    df = spark.createDataFrame([("a",)], "name string")
    level = Level(lookup(spark, [("a", "1"), ("a", "2")]), "name", "name", "label", "label")
    with pytest.raises(ValueError, match="unique"):
        add_name(df, level)
    assert add_name(df, level, check_unique=False).count() == 2


def test_null_lookup_keys_match_nothing(spark):
    df = spark.createDataFrame([(None,), ("a",)], "name string")
    level = Level(lookup(spark, [(None, "none"), (None, "none"), ("a", "A")]), "name", "name", "label", "label")
    assert rows(add_name(df, level)) == [("a", "A"), (None, None)]


def test_output_must_be_new(spark):
    df = spark.sql("SELECT 'a' AS name, 'q' AS label")
    with pytest.raises(ValueError, match="label"):
        add_name(df, Level(lookup(spark), "name", "name", "label", "label"))


def test_key_type_mismatch(spark):
    df = spark.createDataFrame([("1",), ("x",)], "k string")
    table = spark.createDataFrame([(1, "one")], "id int, label string")
    level = Level(table, "k", "id", "label", "label")
    assert rows(add_name(df, level), "label") == [("one",), (None,)]
    assert rows(add_name(df, level, on_mismatch="null"), "k", "label") == [(None, None), (None, None)]


def test_reconciliation_keeps_the_row_count(spark):
    for seed in range(3):
        df = skewed(spark, 200, seed).withColumn("name", F.col("k").cast("string"))
        table = spark.range(12).selectExpr("string(id) AS key", "id AS label")
        assert reconcile(df, Level(table, "name", "key", "label", "label")).count() == 200


@pytest.mark.parametrize("large", ["left", "right"])
def test_join_keeps_the_left_copy(spark, large):
    left = spark.createDataFrame([(1, "l1", "2020"), (2, "l2", "x"), (None, "l3", "2020")], "k int, c string, year string")
    right = spark.createDataFrame([(1, "r1", 2020, 5), (1, "r2", 2020, 6), (2, "r3", 2020, 7), (None, "r4", 2020, 8)], "k int, c string, year int, w int")
    got = join_keeping_left(left, right, ["k", "year"], large=large, hot_rows=2, max_rows=0)
    assert got.columns == ["k", "c", "year", "w"]
    assert rows(got) == [(1, "l1", "2020", 5), (1, "l1", "2020", 6)]


def test_join_needs_its_keys(spark):
    with pytest.raises(ValueError, match="zz"):
        join_keeping_left(spark.range(1), spark.range(1), ["id", "zz"])


def test_left_join_with_suffixes(spark):
    left = spark.sql("SELECT 1 AS k, 'a' AS n UNION ALL SELECT 2, 'b'")
    right = spark.sql("SELECT 1 AS k, 'c' AS n")
    got = left_join_suffixed(left, right, "k", "k")
    assert got.columns == ["k", "n", "k_1", "n_1"]
    assert rows(got) == [(1, "a", 1, "c"), (2, "b", None, None)]


@pytest.mark.parametrize("swap", [False, True])
def test_tasks_of_a_fan_out_are_cut_by_the_rows_they_form(spark, swap):
    from cityloom.operators.skew import fan_out_join

    many = spark.sql("SELECT IF(id < 600, 'hot', concat('k', id % 40)) AS k, id AS a FROM range(1000) UNION ALL SELECT NULL, -1")
    few = spark.sql("SELECT IF(id < 30, 'hot', concat('k', id % 50)) AS k, id AS b FROM range(230) UNION ALL SELECT NULL, -1")
    sides = (few, many) if swap else (many, few)
    expected = sides[0].join(sides[1], "k")
    got = fan_out_join(*sides, ["k"], joined_rows=2000)
    assert rows(got, "k", "a", "b") == rows(expected, "k", "a", "b")
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    # Of 18,000 rows of the hot key and some more.
    assert len(per_task) > 5 and max(per_task) < 9000


def test_no_rows_meet_in_a_fan_out(spark):
    from cityloom.operators.skew import fan_out_join

    assert fan_out_join(spark.sql("SELECT 1 AS k, 2 AS a"), spark.sql("SELECT 3 AS k, 4 AS b"), ["k"], joined_rows=1).collect() == []


def test_exact_sums_equal_those_of_decimals(spark):
    from cityloom.gallery.relations import exact_sum

    values = [0.1, 0.2, -0.3, 1.005, 2.675, 123456789.12, 9e15, -12.345, 0.0, -0.0, 33.33, None]
    df = spark.createDataFrame([(i % 2, v) for v in values for i in range(3)] + [(2, None), (3, 1e12), (3, 0.01)], "g int, v double")
    plain = F.sum(F.col("v").cast("decimal(18,2)")).cast("double")
    assert rows(df.groupBy("g").agg(exact_sum("v").alias("s"))) == rows(df.groupBy("g").agg(plain.alias("s")))
