"""Reconciling names through lookup tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityloom.operators.conform import align_key
from cityloom.operators.skew import BROADCAST_ROWS, balanced_join, fits_broadcast, row_width
from cityloom.session import stage


@dataclass(frozen=True)
class Level:
    """One reconciliation step: match ``key`` with ``lookup_key``, add ``name`` of the lookup as ``output``."""

    lookup: DataFrame
    key: str
    lookup_key: str
    name: str
    output: str


def measure(lookup: DataFrame, key: str) -> tuple[int, int, bool]:
    """Rows, bytes of the widest row, and whether a key occurs more than once, which would multiply the rows that match it.

    One pass; the rows of a key are combined before the shuffle.
    """
    per_key = lookup.groupBy(key).agg(F.count("*").alias("n"), F.max(row_width(lookup.columns)).alias("width"))
    row = per_key.agg(F.sum("n").alias("n"), F.max("width").alias("width"), F.max(F.when(F.col(key).isNotNull(), F.col("n"))).alias("most")).first()
    return row.n or 0, row.width or 0, (row.most or 0) > 1


def add_name(
    df: DataFrame,
    level: Level,
    on_mismatch: str = "cast",
    check_unique: bool = True,
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Left join to one lookup; the name is NULL where nothing matches.

    Repeated lookup keys are an error unless ``check_unique`` is off; then they multiply rows as any
    left join does.
    """
    return _with_name(df, level, on_mismatch, check_unique, max_rows, hot_rows)[0]


def _with_name(
    df: DataFrame,
    level: Level,
    on_mismatch: str = "cast",
    check_unique: bool = True,
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int | None = None,
) -> tuple[DataFrame, bool]:
    """The joined rows, and whether the join shuffles them."""
    if level.output in df.columns and level.output != level.key:
        raise ValueError(f"column {level.output} exists already")
    # The lookup loses its own column names, so equal names on both sides cannot clash.
    lookup = level.lookup.select(
        F.col(f"`{level.lookup_key}`").alias("_lookup_key"), F.col(f"`{level.name}`").alias("_lookup_name")
    )
    count, widest, repeated = measure(lookup, "_lookup_key")
    if check_unique and repeated:
        raise ValueError(f"lookup key {level.lookup_key} is not unique")
    small = fits_broadcast(count, widest, max_rows)
    keyed = align_key(df, level.key, lookup.schema["_lookup_key"].dataType, on_mismatch)
    keyed = keyed.withColumn("_lookup_key", F.col(f"`{level.key}`"))
    joined = balanced_join(keyed, lookup, ["_lookup_key"], "left", hot_rows, known_small=small)
    kept = [F.col(f"`{c}`") for c in keyed.columns if c not in (level.output, "_lookup_key")]
    return joined.select(*kept, F.col("_lookup_name").alias(level.output)), not small


def reconcile(df: DataFrame, *levels: Level, drop: tuple[str, ...] = (), **options) -> DataFrame:
    """Apply the levels in turn to one conformed frame, then drop the columns no longer needed.

    A level may replace its own key column (``output`` equal to ``key``). A level whose lookup is too large to broadcast
    is staged before the next one.
    """
    for i, level in enumerate(levels):
        df, shuffled = _with_name(df, level, **options)
        if shuffled and i < len(levels) - 1:
            df = stage(df, "reconciled")
    outputs = {level.output for level in levels}
    return df.drop(*[name for name in drop if name not in outputs])
