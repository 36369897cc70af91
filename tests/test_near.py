import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cityloom.operators.lookup import Level, reconcile
from cityloom.operators.near import add_near_name, near_names


def edits(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            previous, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, previous + (x != y))
    return line[-1]


def slow(names, known, most):
    found = []
    for name in sorted(set(names) - {None}):
        apart = {k: edits(name, k) for k in set(known) - {None}}
        least = min(apart.values(), default=most + 1)
        if least <= most:
            nearest = [k for k, d in apart.items() if d == least]
            found.append((name, least, len(nearest), nearest[0] if len(nearest) == 1 else None))
    return found


@pytest.mark.parametrize("most", [1, 2, 3])
def test_all_pairs_within_the_distance_are_found(spark, most):
    rng = random.Random(most)
    word = lambda: "".join(rng.choice("aaab é漢") for _ in range(rng.randrange(10)))
    names, known = [word() for _ in range(150)] + [None, "", "aa"], [word() for _ in range(60)] + [None, ""]
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "name string")
    got = near_names(frame(names), frame(known), most)
    assert sorted(tuple(r) for r in got.select("name", "distance", "n_nearest", "match").collect()) == slow(names, known, most)


def test_empty_sides(spark):
    nothing = spark.createDataFrame([], "name string")
    some = spark.createDataFrame([("abc",)], "name string")
    assert near_names(nothing, some).collect() == near_names(some, nothing).collect() == []
    with pytest.raises(ValueError, match="1 at least"):
        near_names(some, some, 0)


def test_published_spellings(spark):
    lookup = spark.createDataFrame(
        [("la nova esquerra de l eixample", "La Nova Esquerra"), ("la vall d hebron", "Vall"), ('"sant pere, santa caterina i la ribera"', "Sant Pere"), ("sants", "Sants"), ("sarria", "S1"), ("sarrib", "S2")],
        "area string, label string",
    )
    df = spark.createDataFrame([("la nova esquerra de l'eixample", 1), ("la vall d'hebron", 2), ("sant pere, santa caterina i la ribera", 3), ("sants", 4), ("sarric", 5), (None, 6), ("far away", 7)], "area string, id int")
    level = Level(lookup, "area", "area", "label", "label")
    named = reconcile(df, level)
    assert rows(named.where(F.col("label").isNotNull()), "id") == [(4,)]
    filled = add_near_name(named, level, 2)
    assert filled.columns == named.columns
    assert rows(filled, "id", "label") == [(1, "La Nova Esquerra"), (2, "Vall"), (3, "Sant Pere"), (4, "Sants"), (5, None), (6, None), (7, None)]


def test_a_repeated_key_is_compared_once(spark):
    lookup = spark.createDataFrame([("abcdef", "L")], "k string, label string")
    df = spark.range(500).select(F.lit("abcdex").alias("k"))
    level = Level(lookup, "k", "k", "label", "label")
    assert add_near_name(reconcile(df, level), level, 1).where("label = 'L'").count() == 500


def test_names_of_one_pattern_are_found_among_few(spark):
    from cityloom.operators import near

    known = spark.range(2000).select(F.format_string("Supplier#%09d", F.col("id") * 37).alias("name"))
    names = known.select(F.regexp_replace("name", "#", "").alias("name"))
    rarity = known.select(F.explode(near._grams(F.col("name"))).alias("mark")).groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
    marks = [near._marks(frame, rarity, 2) for frame in (names, known.withColumnRenamed("name", "known").select(F.col("known").alias("name")))]
    pairs = marks[0].join(marks[1].withColumnRenamed("name", "known"), "mark")
    # A single gram would be shared by a twentieth of all pairs and more.
    assert pairs.count() < 2000 * 2000 / 20
    assert near_names(names, known).where("distance = 1").count() == 2000
