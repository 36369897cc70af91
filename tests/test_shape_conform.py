import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from cityloom.operators import shape
from cityloom.operators.conform import align_key, conform_union, drop_duplicate_rows


def test_union_orders_columns_by_first_appearance_and_fills_nulls(spark):
    a = spark.createDataFrame([(1, "x")], "b int, a string")
    b = spark.createDataFrame([("y", 2.5)], "a string, c double")
    df = conform_union([a, b])
    assert df.columns == ["b", "a", "c"]
    assert rows(df) == [(1, "x", None), (None, "y", 2.5)]


def test_union_types(spark):
    small = spark.createDataFrame([(1,)], "k int")
    large = spark.createDataFrame([(2**40,)], "k bigint")
    text = spark.createDataFrame([("z",)], "k string")
    void = spark.sql("SELECT NULL AS k")
    assert dict(conform_union([small, large]).dtypes) == {"k": "bigint"}
    assert dict(conform_union([void, small]).dtypes) == {"k": "int"}
    assert rows(conform_union([small, large, text, void])) == [("1",), (str(2**40),), ("z",), (None,)]


def test_bigint_and_double_stay_numbers_where_a_type_holds_both(spark):
    whole, large = spark.sql("SELECT 5L AS n UNION ALL SELECT NULL"), spark.sql(f"SELECT {2**62 + 1}L AS n")
    half, tiny = spark.sql("SELECT 2.5D AS N"), spark.sql("SELECT 1e-30D AS n")
    got = conform_union([whole, half, spark.sql("SELECT 7 AS n")])
    assert dict(got.dtypes) == {"n": "double"} and rows(got) == [(2.5,), (5.0,), (7.0,), (None,)]
    exact = conform_union([large, half])
    assert dict(exact.dtypes) == {"n": "decimal(38,18)"} and sorted(float(r[0]) for r in exact.collect()) == [2.5, float(2**62)]
    assert int(exact.agg(F.max("n")).first()[0]) == 2**62 + 1
    assert dict(conform_union([large, tiny]).dtypes) == {"n": "string"}
    assert dict(conform_union([spark.sql(f"SELECT {-2**63 + 1}L AS n"), spark.sql("SELECT double('nan') AS n")]).dtypes) == {"n": "string"}
    assert dict(conform_union([whole, tiny, spark.sql("SELECT float(1.5) AS n")]).dtypes) == {"n": "double"}


def test_union_merges_structs_and_turns_clashing_ones_to_text(spark):
    a = spark.sql("SELECT named_struct('x', 1) AS s")
    b = spark.sql("SELECT named_struct('x', 2, 'y', 'q') AS s")
    merged = conform_union([a, b])
    assert [(r.s.x, r.s.y) for r in merged.orderBy("s.x").collect()] == [(1, None), (2, "q")]
    c = spark.sql("SELECT named_struct('x', 'text') AS s")
    assert rows(conform_union([a, c])) == [('{"x":"text"}',), ('{"x":1}',)]


def test_union_keeps_every_row(spark):
    rng = random.Random(3)
    for _ in range(5):
        frames = [
            spark.createDataFrame(
                [tuple(rng.randint(0, 9) for _ in names) for _ in range(rng.randint(1, 6))], ", ".join(f"{n} int" for n in names)
            )
            for names in (rng.sample("abcde", rng.randint(1, 5)) for _ in range(rng.randint(1, 4)))
        ]
        assert conform_union(frames).count() == sum(f.count() for f in frames)


def test_align_key(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "k string")
    assert rows(align_key(df, "k", IntegerType())) == [(1,), (None,), (None,)]
    assert rows(align_key(df, "k", IntegerType(), "null")) == [(None,), (None,), (None,)]
    ints = spark.createDataFrame([(1,)], "k int")
    assert rows(align_key(ints, "k", LongType())) == [(1,)]
    assert align_key(ints, "k", IntegerType()) is ints
    nested = spark.sql("SELECT named_struct('a', 1) AS k")
    target = StructType().add("a", LongType())
    assert align_key(nested, "k", target, "null").first().k.a == 1


def test_duplicates_go_once_and_for_all(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, None)], "k int, v string")
    once = drop_duplicate_rows(df)
    assert once.count() == 3
    assert rows(drop_duplicate_rows(once)) == rows(once)
    nested = spark.sql("SELECT array(named_struct('y', 1)) AS info UNION ALL SELECT array(named_struct('y', 1))")
    assert drop_duplicate_rows(nested).count() == 1


def test_copies_collapse_before_the_shuffle(spark):
    plan = plan_of(drop_duplicate_rows(spark.range(10).selectExpr("id % 2 AS k")))
    assert plan.count("HashAggregate") == 2


def test_select_present_warns(spark, caplog):
    df = spark.sql("SELECT 1 AS a, 2 AS b")
    assert shape.select_present(df, ["b", "zz", "a"]).columns == ["b", "a"]
    assert "zz" in caplog.text


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('x', 2, 'y', 3) AS s")
    assert shape.flatten_struct(df, "s").columns == ["id", "x", "y"]
    clash = spark.sql("SELECT 1 AS X, 5 AS z, named_struct('x', 2) AS s")
    with pytest.raises(ValueError, match="x"):
        shape.flatten_struct(clash, "s")
    replaced = shape.flatten_struct(clash, "s", overwrite=True)
    assert tuple(replaced.first()) == (2, 5)


def test_flatten_where_a_frame_lacks_the_struct(spark):
    frames = [spark.sql("SELECT 1 AS id, named_struct('x', 2) AS s"), spark.sql("SELECT 2 AS id")]
    kept = conform_union(shape.flatten_in_frames(frames, "s"))
    assert rows(kept) == [(1, 2), (2, None)]
    assert rows(conform_union(shape.flatten_in_frames(frames, "s", "drop"))) == [(1, 2)]


def test_first_element(spark):
    df = spark.sql(
        """SELECT 1 AS id, array(named_struct('RFD', 10.0, 'year', 2017), named_struct('RFD', 99.0, 'year', 2018)) AS info
        UNION ALL SELECT 2, array() UNION ALL SELECT 3, NULL"""
    )
    got = shape.first_element(df, "info", ("RFD", "year"))
    assert got.columns == ["id", "RFD", "year"]
    assert [(r.id, r.RFD and float(r.RFD), r.year) for r in got.orderBy("id").collect()] == [(1, 10.0, 2017), (2, None, None), (3, None, None)]


def test_suffixes():
    assert shape.suffix_repeated(["a", "b", "a", "a", "a_1"]) == ["a", "b", "a_1", "a_2", "a_1_1"]


def test_null_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 3, None)], "a int, b int, `c d` string")
    assert rows(shape.null_profile(df)) == [("a", 0), ("b", 1), ("c d", 1)]
    assert shape.drop_null_columns(df).columns == ["a"]
    with pytest.raises(ValueError, match="b"):
        shape.drop_null_columns(df, protect=["b"])
    empty = df.limit(0)
    assert shape.drop_null_columns(empty).columns == df.columns


def test_shape(spark):
    assert rows(shape.frame_shape(spark.range(7).withColumn("b", F.lit(1)))) == [(7, 2)]


def test_large_integers_survive_a_union_with_floating_numbers(spark):
    whole, part = spark.sql("SELECT 9007199254740993L AS v"), spark.sql("SELECT 0.5D AS v")
    assert [str(r[0]).rstrip("0") for r in conform_union([whole, part]).orderBy("v").collect()] == ["0.5", f"{2**53 + 1}."]
    assert rows(conform_union([spark.sql("SELECT 7 AS v"), part])) == [(0.5,), (7.0,)]
