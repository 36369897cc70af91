"""Equi-joins that stay balanced when single keys hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds this many rows of the large side: about the rows one task handles well.
HOT_ROWS = 2_000_000
# A table is broadcast only if it has at most this many rows, none above the byte limit.
BROADCAST_ROWS = 100_000
BROADCAST_ROW_BYTES = 1_000
# Joined rows that a task of a join with a fan-out forms: some seconds of work.
JOINED_ROWS = 1_000_000
MAX_JOIN_TASKS = 50_000
_SALT = "_join_salt"
_BUCKETS = "_join_buckets"


def _far_too_large(df: DataFrame, max_rows: int) -> bool:
    """Whether the files of a table alone are larger than its rows could be if it were small; nothing is read. Other plans are not judged by estimates."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if plan.collectLeaves().size() != 1:
        return False
    return int(str(plan.stats().sizeInBytes())) > 8 * max_rows * BROADCAST_ROW_BYTES


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the whole table fits a broadcast: its rows and its widest row are measured, up to one row beyond the limit."""
    if _far_too_large(df, max_rows):
        return False
    rows, widest = df.select(row_width(df.columns).alias("width")).limit(max_rows + 1).agg(F.count("*"), F.max("width")).first()
    return fits_broadcast(rows, widest, max_rows)


def row_width(columns: Iterable[str]) -> Column:
    """Bytes of a row's values as text."""
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in columns]
    return sum(widths, F.lit(0))


def fits_broadcast(rows: int, widest: int | None, max_rows: int = BROADCAST_ROWS) -> bool:
    return rows <= max_rows and (widest or 0) <= BROADCAST_ROW_BYTES


def hot_keys(df: DataFrame, keys: Iterable[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and the buckets of about ``hot_rows`` rows each they need.

    There are fewer than row count / ``hot_rows`` of them. Counts are combined before the shuffle,
    so the hot keys cost no more than the others.
    """
    keys = list(keys)
    return buckets_of(df.dropna(subset=keys).groupBy(*keys).count(), "count", hot_rows).drop("count")


def buckets_of(counts: DataFrame, rows: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hot ones among keys whose rows are already counted, with their buckets."""
    hot = counts.where(F.col(rows) > hot_rows)
    return hot.withColumn(_BUCKETS, F.ceil(F.col(rows) / hot_rows).cast("int"))


def _row_salt(df: DataFrame, buckets: Column) -> Column:
    """Salt from the row's own content: a re-run task places every row where it was before.

    Full copies of a row share a salt; drop duplicates first, or leave them to the run-time split.
    """
    hashable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in hashable]), buckets).cast("int")


def spread_join(
    large: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Shuffled ``inner`` or ``left`` join of ``large`` with ``small`` on equally named keys.

    Rows of ``large`` with a hot key are spread over buckets, as many as the key needs, and only the
    matching rows of ``small`` are repeated, once per bucket. Rows with a NULL key match nothing; in a left join they
    are not shuffled but added as they are. The result equals ``large.join(small, keys, how)``,
    whatever keys are taken as hot; ``hot`` saves counting them where that is known.
    """
    # Safe to broadcast: fewer than row count / hot_rows keys.
    hot = F.broadcast(hot_keys(large, keys, hot_rows) if hot is None else hot)
    keyed = large.dropna(subset=keys)
    buckets = F.col(_BUCKETS)
    salt = F.when(buckets.isNotNull(), _row_salt(large, buckets)).otherwise(F.lit(0))
    spread = keyed.join(hot, keys, "left").withColumn(_SALT, salt).drop(_BUCKETS)
    per_row = F.sequence(F.lit(0), F.coalesce(F.col(_BUCKETS), F.lit(1)) - 1)
    repeated = small.join(hot, keys, "left").withColumn(_SALT, F.explode(per_row)).drop(_BUCKETS)
    joined = spread.join(repeated, [*keys, _SALT], how).drop(_SALT)
    return _with_keyless(joined, large, small, keys) if how == "left" else joined


def _with_keyless(joined: DataFrame, large: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """A left join with the rows that have a NULL key, which match nothing and so need no shuffle."""
    keyless = large.where(F.greatest(*[F.col(f"`{k}`").isNull() for k in keys], F.lit(False)))
    added = {f.name: F.lit(None).cast(f.dataType) for f in small.schema if f.name not in keys}
    return joined.unionByName(keyless.withColumns(added))


def balanced_join(
    large: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot_rows: int | None = None,
    max_rows: int = BROADCAST_ROWS,
    known_small: bool | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join by broadcast when ``small`` is measured small, so ``large`` is not shuffled; else a shuffled join.

    That is a ``spread_join`` where hot keys are known in ``hot``, or to be counted, which reads ``large`` once more: with ``hot_rows``. Otherwise partitions that turn
    out too large are split at run time. ``known_small`` is given where the caller has that answer already.
    """
    if is_small(small, max_rows) if known_small is None else known_small:
        return large.join(F.broadcast(small), keys, how)
    if hot is not None or hot_rows is not None:
        return spread_join(large, small, keys, how, HOT_ROWS if hot_rows is None else hot_rows, hot)
    joined = large.dropna(subset=keys).join(small, keys, how)
    return _with_keyless(joined, large, small, keys) if how == "left" else joined


def fan_out_join(left: DataFrame, right: DataFrame, keys: list[str], joined_rows: int | None = None) -> DataFrame:
    """Shuffled inner join of many rows with many, in tasks that form about ``joined_rows`` rows each, however few bytes they read for them.

    The rows of every key are counted on both sides first. A key with more joined rows than a task shall form is dealt: on the side where it has more rows these are spread, and those of the other
    side repeated. The result equals ``left.join(right, keys)``. Both inputs are read twice, so let them be staged. Only full copies of a row stay together.
    """
    joined_rows = JOINED_ROWS if joined_rows is None else joined_rows
    sides = [side.dropna(subset=keys) for side in (left, right)]
    counted = [side.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(name)) for side, name in zip(sides, ("_ours", "_theirs"), strict=True)]
    met = counted[0].join(counted[1], keys).withColumn("_joined", F.col("_ours") * F.col("_theirs"))
    total = met.agg(F.sum("_joined")).first()[0] or 0
    if total <= joined_rows:
        return sides[0].join(sides[1], keys)
    more = F.col("_ours") >= F.col("_theirs")
    # Safe to broadcast: fewer than joined rows / ``joined_rows`` keys.
    hot = F.broadcast(buckets_of(met, "_joined", joined_rows).select(*keys, *[F.when(own, F.col(_BUCKETS)).otherwise(1).alias(f"{_BUCKETS}{i}") for i, own in enumerate((more, ~more))]))
    tasks = min(-int(-total // joined_rows), MAX_JOIN_TASKS)
    dealt = []
    for own, side in enumerate(sides):
        buckets = F.col(f"{_BUCKETS}{own}")
        spread = F.when(buckets.isNotNull(), _row_salt(side, buckets)).otherwise(0)
        repeated = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"{_BUCKETS}{1 - own}"), F.lit(1)) - 1))
        salted = side.join(hot, keys, "left").withColumn(f"{_SALT}{own}", spread).withColumn(f"{_SALT}{1 - own}", repeated)
        # A number of partitions that is asked for is not merged by size, which says nothing of the rows formed.
        dealt.append(salted.drop(f"{_BUCKETS}0", f"{_BUCKETS}1").repartition(tasks, *keys, f"{_SALT}0", f"{_SALT}1"))
    return dealt[0].join(dealt[1].hint("merge"), [*keys, f"{_SALT}0", f"{_SALT}1"]).drop(f"{_SALT}0", f"{_SALT}1")
