"""Matching names that differ by a few letters.

Names within an edit distance k share all but k * q of their q-grams at least (the count filter), so if the grams of every name are put in one order, the rarest of the lookup's first, two such names share m of their first
k * q + m grams (the prefix filter). A join on every m of these finds every pair; single grams are shared by a share of all names, so that pairs would grow with the square of the names, while few names share several. The edit
distance is taken of the pairs found only. Names of so few grams that the filter says nothing are found by the
strings that at most k deletions leave of them, of which two such names share one.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityloom.operators.lookup import Level
from cityloom.operators.skew import MAX_JOIN_TASKS, balanced_join, fan_out_join, is_small
from cityloom.session import stage

GRAM = 2
#: Grams that two names must share: the more, the fewer pairs are found in vain, and the more marks a name has.
SHARED = 3
#: Names of which a task makes the marks.
TASK_NAMES = 2_000
#: Stands before and behind a name, so that its first and last letters are in as many grams as the others.
_EDGE = "\x01"


def _grams(name: Column) -> Column:
    """The grams of a name, each with the number of its occurrence, so that a gram that stands twice counts twice."""
    edged = F.concat(F.lit(_EDGE * (GRAM - 1)), name, F.lit(_EDGE * (GRAM - 1)))
    grams = F.transform(F.sequence(F.lit(1), F.char_length(name) + GRAM - 1), lambda at: F.substr(edged, at, F.lit(GRAM)))
    return F.transform(grams, lambda gram, at: F.concat(F.lit("g"), F.size(F.filter(F.slice(grams, F.lit(1), at + 1), lambda other: other == gram)).cast("string"), F.lit(":"), gram))


def _remains(name: Column, distance: int) -> Column:
    """What up to ``distance`` deletions leave of a short name."""

    def shorter(text: Column) -> Column:
        places = F.when(F.char_length(text) > 0, F.sequence(F.lit(1), F.char_length(text))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda at: F.concat(F.substr(text, F.lit(1), at - 1), F.substr(text, at + 1)))

    found = last = F.array(name)
    for _ in range(distance):
        last = F.flatten(F.transform(last, shorter))
        found = F.array_union(found, last)
    return F.transform(found, lambda text: F.concat(F.lit("d:"), text))


def _marks(names: DataFrame, rarity: DataFrame, distance: int) -> DataFrame:
    """Names with what pairs are found by: (name, mark)."""
    grams = names.select("name", F.explode(_grams(F.col("name"))).alias("mark")).join(rarity, "mark", "left")
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "mark")))
    prefix = distance * GRAM + SHARED
    first = grams.groupBy("name").agg(F.slice(ordered, 1, prefix)["mark"].alias("first"))
    # Hashes that are equal by chance cost a comparison only.
    several = [F.when(F.size("first") > places[-1], F.xxhash64(*[F.get("first", F.lit(place)) for place in places])) for places in combinations(range(prefix), SHARED)]
    by_gram = first.select("name", F.explode(F.array_compact(F.array(*several))).alias("mark"))
    # Longer names, or shorter ones near a longer one, have grams enough to share.
    short = F.char_length("name") <= distance * GRAM - GRAM + SHARED
    return by_gram.unionByName(names.where(short).select("name", F.explode(F.transform(_remains(F.col("name"), distance), lambda text: F.xxhash64(text))).alias("mark")))


def _dealt(names: DataFrame) -> DataFrame:
    """Staged names in tasks of about ``TASK_NAMES``: few bytes, but much work for each."""
    return names.repartition(min(names.count() // TASK_NAMES + 1, MAX_JOIN_TASKS), "name")


def near_names(names: DataFrame, known: DataFrame, distance: int = 2) -> DataFrame:
    """For every different name the nearest known ones, of those at most ``distance`` edits away: (name, distance, n_nearest, match).

    Both inputs have a column ``name``; NULL is left out. ``n_nearest`` known names are equally near; ``match`` is the one if it is only one, else NULL: ties are reported, not
    guessed. Names without a near one are not in the result. Edits are letters put in, left out or replaced.
    """
    if distance < 1:
        raise ValueError("equal names need no search: the distance is 1 at least")
    names, known = (_dealt(stage(frame.select("name").dropna().distinct(), "names")) for frame in (names, known))
    rarity = stage(known.select(F.explode(_grams(F.col("name"))).alias("mark")).groupBy("mark").agg(F.count(F.lit(1)).alias("n")), "rarity")
    theirs = stage(_marks(known, rarity, distance).withColumnRenamed("name", "known"), "known-marks")
    ours = _marks(names, rarity, distance)
    pairs = ours.join(F.broadcast(theirs), "mark") if is_small(theirs) else fan_out_join(stage(ours, "marks"), theirs, ["mark"])
    alike = pairs.where(F.abs(F.char_length("name") - F.char_length("known")) <= distance)
    apart = F.levenshtein("name", "known", distance)
    # Measured before the copies of a pair are put together: few pairs are left to move.
    measured = alike.select("name", "known", apart.alias("distance")).where("distance >= 0").distinct()
    per_distance = measured.groupBy("name", "distance").agg(F.count(F.lit(1)).alias("n_nearest"), F.min("known").alias("match"))
    nearest = per_distance.groupBy("name").agg(F.min(F.struct("distance", "n_nearest", "match")).alias("best"))
    found = nearest.select("name", "best.*")
    return found.withColumn("match", F.when(F.col("n_nearest") == 1, F.col("match")))


def add_near_name(df: DataFrame, level: Level, distance: int) -> DataFrame:
    """Fill the names that a reconciliation level left NULL, where one lookup key only is nearest to the row's key and not farther than ``distance``.

    ``df`` has the level's key, as text, and its output. Only the different keys without a name are compared, each once.
    """
    if level.output == level.key:
        raise ValueError("the key is needed beside the name")
    key = F.col(f"`{level.key}`")
    unnamed = df.where(F.col(f"`{level.output}`").isNull()).select(key.alias("name"))
    known = level.lookup.select(F.col(f"`{level.lookup_key}`").alias("match"), F.col(f"`{level.name}`").alias("_near_name"))
    found = near_names(unnamed, known.select(F.col("match").alias("name")), distance).dropna(subset=["match"])
    named = found.join(known, "match").select(F.col("name").alias("_near_key"), "_near_name")
    joined = balanced_join(df.withColumn("_near_key", key), named, ["_near_key"], "left")
    filled = F.coalesce(F.col(f"`{level.output}`"), F.col("_near_name")).alias(level.output)
    return joined.select(*[filled if name == level.output else F.col(f"`{name}`") for name in df.columns])
