"""Counts, top lists and correlations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityloom.session import stage


def rows_per_day(listings: DataFrame, date: str = "date") -> DataFrame:
    """Rows per date; rows without a date form one group."""
    return listings.groupBy(date).count()


def mean_rows_per_day(listings: DataFrame, date: str = "date") -> DataFrame:
    """Mean of the daily counts over the days that have rows."""
    return rows_per_day(listings, date).agg(F.avg("count").alias("value"))


def in_latest_month(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows of the calendar month of the latest date.

    The latest date is a subquery of the same plan, and the condition is a plain lower
    bound on the bare column, which reaches the scan.
    """
    first_day = F.trunc(F.max(date).cast("date"), "month").cast(df.schema[date].dataType)
    return df.where(F.col(date) >= df.select(first_day).scalar())


def top_groups(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The ``n`` groups with most rows, NULL included as a group; ties go by key, NULL last."""
    counts = df.groupBy(key).count()
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(key)).limit(n)


def top_groups_sketched(df: DataFrame, key: str, n: int = 5, tracked: int = 1_000, buckets: int = 1 << 16) -> DataFrame:
    """The same for keys without bound, of an atomic type: exact, and what is shuffled does not grow with the different keys.

    Summaries of up to ``tracked`` frequent keys, one for each task and merged in two steps, choose candidates. A second pass counts these exactly, NULL too, and all other rows by a hash bucket of their key: a key has
    no more rows than its bucket, so keys of buckets with fewer rows than the last place of the list cannot be in it. If other buckets are left, the keys in these alone are counted.
    """
    column = F.col(f"`{key}`")
    summaries = df.where(column.isNotNull()).groupBy(F.pmod(F.spark_partition_id(), F.lit(256)).alias("part")).agg(F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("summary"))
    # By a group, so that there is none without rows.
    merged = summaries.groupBy(F.col("part") * 0).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary, {tracked}), {tracked})").alias("found"))
    candidates = stage(merged.select(F.explode("found.item").alias(key)).dropna().distinct(), "candidates").withColumn("_candidate", F.lit(True))
    # At most as many rows as are tracked.
    marked = df.select(column.alias(key)).join(F.broadcast(candidates), key, "left")
    chosen = F.col("_candidate").isNotNull() | column.isNull()
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    groups = marked.groupBy(chosen.alias("chosen"), F.when(chosen, column).alias(key), F.when(~chosen, bucket).alias("bucket"))
    counts = stage(groups.count(), "candidate-counts")
    exact = counts.where("chosen").select(key, "count")
    last = exact.orderBy(F.desc("count")).limit(n).agg(F.when(F.count("*") == n, F.min("count"))).first()[0] or 1
    open_buckets = counts.where(~F.col("chosen") & (F.col("count") >= last)).select("bucket")
    if not open_buckets.isEmpty():
        # At most as many rows as there are buckets.
        rest = marked.where(~chosen).withColumn("bucket", bucket).join(F.broadcast(open_buckets), "bucket", "left_semi")
        exact = exact.unionByName(rest.groupBy(key).count())
    return exact.orderBy(F.desc("count"), F.asc_nulls_last(key)).limit(n)


def correlation(df: DataFrame, x: str, y: str, nulls: str = "skip") -> DataFrame:
    """Pearson correlation as one row; NULL if either side is constant or there are no rows.

    ``nulls='skip'`` leaves out rows with a NULL, ``'zero'`` counts a NULL as 0.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    if nulls == "zero":
        pair = df.select(F.coalesce(a, F.lit(0.0)).alias("a"), F.coalesce(b, F.lit(0.0)).alias("b"))
    else:
        pair = df.select(a.alias("a"), b.alias("b")).dropna()
    spread = F.stddev_pop("a") * F.stddev_pop("b")
    return pair.agg(F.try_divide(F.covar_pop("a", "b"), spread).alias("value"))


def moments(df: DataFrame, keys: Sequence[str], x: str, name: str, nulls: str = "skip") -> DataFrame:
    """Rows, mean, sum of squared deviations, least and greatest value of ``x`` per key.

    The columns are ``{name}_n``, ``_mean``, ``_dev``, ``_min`` and ``_max``. Keys without a value have none.
    """
    value = F.col(x).cast("double")
    if nulls == "zero":
        value = F.coalesce(value, F.lit(0.0))
    return df.groupBy(*keys).agg(*moment_columns(value, name)).where(F.col(f"{name}_n") > 0)


def moment_columns(value: Column, name: str) -> list[Column]:
    return [
        F.count(value).alias(f"{name}_n"),
        F.avg(value).alias(f"{name}_mean"),
        (F.var_pop(value) * F.count(value)).alias(f"{name}_dev"),
        F.min(value).alias(f"{name}_min"),
        F.max(value).alias(f"{name}_max"),
    ]


def _centre(moments: DataFrame, name: str) -> Column:
    """Mean of all values, as a subquery: sums of squares taken from it lose no digits to a large common offset."""
    n, mean = F.col(f"{name}_n").cast("double"), F.col(f"{name}_mean")
    return moments.where(n > 0).select((F.sum(n * mean) / F.sum(n)).alias("centre")).scalar()


def merge_moments(finer: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Moments per ``keys`` from moments of finer groups, as if taken from the rows; one partial aggregation."""
    n = F.col(f"{name}_n").cast("double")
    off = F.col(f"{name}_mean") - F.col("centre")
    centred = finer.withColumn("centre", _centre(finer, name)).where(n > 0)
    sums = centred.groupBy(*keys).agg(
        F.sum(f"{name}_n").alias(f"{name}_n"),
        F.first("centre").alias("centre"),
        F.sum(n * off).alias("off"),
        F.sum(F.col(f"{name}_dev") + n * off * off).alias("square"),
        F.min(f"{name}_min").alias(f"{name}_min"),
        F.max(f"{name}_max").alias(f"{name}_max"),
    )
    # The numerator of a constant column can come out just below 0.
    deviation = F.greatest(F.col("square") - F.col("off") * F.col("off") / n, F.lit(0.0))
    return sums.withColumns({f"{name}_mean": F.col("centre") + F.col("off") / n, f"{name}_dev": deviation}).drop(
        "centre", "off", "square"
    )


def correlation_of_moments(left: DataFrame, x: str, right: DataFrame, y: str, keys: Sequence[str]) -> DataFrame:
    """Pearson correlation over the inner join of two data sets, from their moments per join key.

    Every key contributes all pairs of its left and right rows, but the pairs are never formed: within
    a key the two sides are independent, so only counts, means and deviations are needed.
    One row per key is joined, however many rows a key has, and all sums are partial aggregates.
    One row; NULL as in ``correlation``.
    """
    left_n, right_n = F.col(f"{x}_n").cast("double"), F.col(f"{y}_n").cast("double")
    ours = left.withColumn("_x", F.col(f"{x}_mean") - _centre(left, x))
    theirs = right.withColumn("_y", F.col(f"{y}_mean") - _centre(right, y))
    n, from_x, from_y = left_n * right_n, F.col("_x"), F.col("_y")
    sums = ours.join(theirs, list(keys)).agg(
        F.sum(n).alias("n"),
        F.sum(n * from_x).alias("x"),
        F.sum(n * from_y).alias("y"),
        F.sum(F.col(f"{x}_dev") * right_n + n * from_x * from_x).alias("xx"),
        F.sum(F.col(f"{y}_dev") * left_n + n * from_y * from_y).alias("yy"),
        F.sum(n * from_x * from_y).alias("xy"),
        (F.min(f"{x}_min") < F.max(f"{x}_max")).alias("x_varies"),
        (F.min(f"{y}_min") < F.max(f"{y}_max")).alias("y_varies"),
    )
    spread = [F.col(f"{c}{c}") - F.col(c) * F.col(c) / F.col("n") for c in "xy"]
    together = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    value = F.try_divide(together, F.sqrt(spread[0]) * F.sqrt(spread[1]))
    return sums.select(F.when(F.col("x_varies") & F.col("y_varies"), value).alias("value"))


def joined_correlation(
    left: DataFrame, x: str, right: DataFrame, y: str, keys: Sequence[str], nulls: str = "skip"
) -> DataFrame:
    """Correlation of ``x`` and ``y`` over ``left`` joined with ``right`` on ``keys``, without the join."""
    return correlation_of_moments(
        moments(left, keys, x, "left", nulls), "left", moments(right, keys, y, "right", nulls), "right", keys
    )


def kpi_rows(values: dict[str, DataFrame]) -> DataFrame:
    """Long form (KPI, Value) of one-row results; the rows never pass the driver."""
    rows = [df.select(F.lit(name).alias("KPI"), F.col("value").cast("double").alias("Value")) for name, df in values.items()]
    return reduce(DataFrame.unionByName, rows)
