import datetime
import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from cityloom.operators import indicators as ind
from cityloom.operators import marts
from cityloom.plans import indicators as plan

D = datetime.date


def listings(spark, seed=0, n=300):
    rng = random.Random(seed)
    data = [
        (rng.choice(["hot", "hot", "a", "b", None]), D(2021, rng.randint(1, 3), rng.randint(1, 28)), rng.choice([None, rng.uniform(1e6, 2e6)]))
        for _ in range(n)
    ]
    return spark.createDataFrame(data, "neighborhood string, date date, price double")


def income(spark, seed=0):
    rng = random.Random(seed + 100)
    data = [(rng.choice(["hot", "a", "b", "c", None]), rng.choice([None, rng.uniform(50, 200)])) for _ in range(40)]
    return spark.createDataFrame(data, "neighborhood string, RFD double")


@pytest.mark.parametrize("nulls", ["skip", "zero"])
@pytest.mark.parametrize("seed", [0, 1])
def test_joined_correlation_equals_the_naive_one(spark, nulls, seed):
    left, right = listings(spark, seed), income(spark, seed)
    naive = ind.correlation(left.join(right, "neighborhood"), "price", "RFD", nulls).first()[0]
    assert ind.joined_correlation(left, "price", right, "RFD", ["neighborhood"], nulls).first()[0] == pytest.approx(naive, abs=1e-9)
    cube = plan.listing_cube(left, nulls)
    assert plan.price_income_correlation(cube, right, nulls).first()[0] == pytest.approx(naive, abs=1e-9)


def test_correlation_is_precise_far_from_zero(spark):
    left = spark.range(1000).selectExpr("id % 10 AS k", "1e9 + id % 7 AS x")
    right = spark.range(1000).selectExpr("id % 10 AS k", "1e9 + id % 10 + id % 3 AS y")
    joined = left.join(right, "k")
    naive = joined.select(F.corr(F.col("x") - 1e9, F.col("y") - 1e9)).first()[0]
    assert ind.joined_correlation(left, "x", right, "y", ["k"]).first()[0] == pytest.approx(naive, abs=1e-6)


def test_correlation_without_spread_or_rows_is_null(spark):
    df = spark.sql("SELECT 1 AS k, 0.1D AS x, 2.0D AS y UNION ALL SELECT 1, 0.1D, 3.0D UNION ALL SELECT 2, 0.1D, 4.0D")
    assert ind.correlation(df, "x", "y").first()[0] is None
    assert ind.joined_correlation(df, "x", df.select("k", "y"), "y", ["k"]).first()[0] is None
    assert ind.correlation(df.limit(0), "x", "y").first()[0] is None
    assert ind.joined_correlation(df.limit(0), "x", df, "y", ["k"]).first()[0] is None


def test_correlation_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, None), (4.0, 5.0), (5.0, 4.0)], "x double, y double")
    skip = df.dropna().select(F.corr("x", "y")).first()[0]
    zero = df.fillna(0).select(F.corr("x", "y")).first()[0]
    assert ind.correlation(df, "x", "y").first()[0] == pytest.approx(skip)
    assert ind.correlation(df, "x", "y", "zero").first()[0] == pytest.approx(zero)
    assert df.stat.corr("x", "y") == pytest.approx(zero)


def test_listings_pass_no_join_for_correlation(spark):
    text = plan_of(ind.joined_correlation(listings(spark), "price", income(spark), "RFD", ["neighborhood"]))
    below_join = text[text.index("Join"):]
    assert "partial_var_pop" in below_join


def test_days(spark):
    df = spark.createDataFrame([(D(2021, 1, 1),), (D(2021, 1, 1),), (D(2021, 1, 2),), (None,)], "date date")
    assert rows(ind.rows_per_day(df)) == [(D(2021, 1, 1), 2), (D(2021, 1, 2), 1), (None, 1)]
    assert ind.mean_rows_per_day(df).first()[0] == pytest.approx(4 / 3)
    cube = plan.listing_cube(df.selectExpr("'a' AS neighborhood", "date", "1.0D AS price"))
    assert plan.mean_listings_per_day(cube).first()[0] == pytest.approx(4 / 3)


def test_latest_month(spark):
    days = [D(2020, 3, 9), D(2021, 2, 28), D(2021, 3, 1), D(2021, 3, 31), None]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    assert rows(ind.in_latest_month(df)) == [(D(2021, 3, 1),), (D(2021, 3, 31),)]
    stamps = df.select(F.col("date").cast("timestamp_ntz").alias("date"))
    assert ind.in_latest_month(stamps).count() == 2
    assert ind.in_latest_month(df.limit(0)).count() == 0


def test_latest_month_filters_the_bare_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("date_add(date'2021-01-01', int(id * 9)) AS date", "id AS k").write.parquet(path)
    df = ind.in_latest_month(spark.read.parquet(path), "date")
    assert df.count() == 3
    assert "(date#" in plan_of(df) and "cast(date" not in plan_of(df).split("Subquery")[0]


def test_top_groups(spark):
    df = spark.createDataFrame([(k,) for k in ["b", "a", "a", None, None, None, "c", "b", "d", "e", "f"]], "k string")
    got = [tuple(r) for r in ind.top_groups(df, "k").collect()]
    assert got == [(None, 3), ("a", 2), ("b", 2), ("c", 1), ("d", 1)]
    plan_text = plan_of(ind.top_groups(df, "k"))
    assert "TakeOrderedAndProject" in plan_text and "Python" not in plan_text


def test_kpis(spark):
    air = spark.createDataFrame(
        [("hot", "2021", "8"), ("a", "2021", "14"), ("a", "2021", "x"), ("b", "2020", "9"), ("b", "n/a", "9"), (None, "2021", "7")],
        "neighborhood string, year string, Codi_Contaminant string",
    )
    rows_in, money = listings(spark), income(spark)
    got = dict(tuple(r) for r in plan.kpis(plan.listing_cube(rows_in), money, air).collect())
    joined = rows_in.withColumn("year", F.year("date")).join(
        air.selectExpr("neighborhood", "try_cast(year AS int) AS year", "try_cast(Codi_Contaminant AS double) AS code"),
        ["neighborhood", "year"],
    )
    assert set(got) == {plan.MEAN_LISTINGS, plan.PRICE_INCOME, plan.PRICE_AIR}
    assert got[plan.PRICE_AIR] == pytest.approx(ind.correlation(joined, "price", "code").first()[0], abs=1e-9)
    assert got[plan.MEAN_LISTINGS] == pytest.approx(ind.mean_rows_per_day(rows_in).first()[0])


def test_top_sellers_from_the_cube(spark):
    rows_in = listings(spark)
    direct = ind.top_groups(ind.in_latest_month(rows_in), "neighborhood")
    assert [tuple(r) for r in plan.latest_top_sellers(plan.listing_cube(rows_in)).collect()] == [tuple(r) for r in direct.collect()]


def test_marts(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 2), (None, 9), ("b", 6), ("c", 6)], "neighborhood string, count bigint")
    assert [tuple(r) for r in marts.top_areas(df, rows_per_area=None).collect()] == [("a", 7), ("b", 6), ("c", 6)]
    assert [tuple(r) for r in marts.top_areas(df, rows_per_area=1).collect()] == [("b", 6), ("c", 6)]
    assert [tuple(r) for r in marts.top_sellers(df, ["b", "zz"]).collect()] == [(None, 9), ("a", 7), ("c", 6)]
    assert rows(marts.groups_of_at_most(df, "neighborhood", 1)) == [("b", 1), ("c", 1), (None, 0)]
    kpis = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("x", 3.0)], "KPI string, Value double")
    assert rows(marts.kpi_summary(kpis)) == [("x", 3.0, 4.0)]
