"""Bringing frames of differing schema together."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    LongType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructType,
)

# Whole numbers as large as a bigint, and 18 places.
DECIMAL = "decimal(38,18)"


def _agree(left: DataType, right: DataType) -> bool:
    """Whether a union of the two types needs no help: equal, untyped, both numeric, or both nested alike."""
    if left == right or isinstance(left, NullType) or isinstance(right, NullType):
        return True
    if isinstance(left, NumericType) and isinstance(right, NumericType):
        # A floating type holds not every bigint.
        kinds = {type(left), type(right)}
        return not (LongType in kinds and kinds & {FloatType, DoubleType})
    if isinstance(left, StructType) and isinstance(right, StructType):
        theirs = {f.name.lower(): f.dataType for f in right}
        return all(_agree(f.dataType, theirs.get(f.name.lower(), f.dataType)) for f in left)
    if isinstance(left, ArrayType) and isinstance(right, ArrayType):
        return _agree(left.elementType, right.elementType)
    return False


def _as_text(df: DataFrame, name: str) -> DataFrame:
    dtype = df.schema[name].dataType
    if isinstance(dtype, StringType):
        return df
    nested = isinstance(dtype, StructType | ArrayType | MapType)
    column = F.col(f"`{name}`")
    return df.withColumn(name, F.to_json(column) if nested else column.cast("string"))


def _number_type(frames: list[DataFrame], name: str) -> str | None:
    """A type that holds all values of a column that is bigint in some frames and floating in others; None if there is none.

    The values are measured by one aggregate per frame: doubles hold bigints below 2**53, and decimals hold any bigint and those doubles that need no more than 18 places.
    """
    largest, exact = 0, True
    for frame in frames:
        column = next((f for f in frame.schema if f.name.lower() == name), None)
        if column is None or not isinstance(column.dataType, LongType | FloatType | DoubleType):
            continue
        value = F.col(f"`{column.name}`")
        if isinstance(column.dataType, LongType):
            largest = max(largest, int(frame.agg(F.max(F.abs(value.cast("decimal(20,0)")))).first()[0] or 0))
        else:
            back = value.try_cast(DECIMAL).cast(column.dataType)
            exact = exact and not frame.agg(F.bool_or(value.isNotNull() & (back.isNull() | (back != value)))).first()[0]
    if largest < 1 << 53:
        return "double"
    return DECIMAL if exact else None


def _all_numbers(types: list[DataType]) -> bool:
    return all(isinstance(kind, NumericType | NullType) for kind in types)


def conform_union(frames: Iterable[DataFrame]) -> DataFrame | None:
    """UNION ALL by name: columns in order of first appearance, missing ones NULL.

    Where frames disagree on a column's type beyond lossless numeric widening, the column becomes text
    everywhere, since Spark's own widening of text with numbers fails on non-numeric text. A column that is bigint in some frames and floating in others stays a number if one
    type holds all its values, which are measured then: a double, else a decimal; otherwise it becomes text, as Spark's widening rounds. No frames give None.
    """
    frames = list(frames)
    if not frames:
        return None
    types: dict[str, list[DataType]] = {}
    for frame in frames:
        for f in frame.schema:
            types.setdefault(f.name.lower(), []).append(f.dataType)
    mixed = {name for name, seen in types.items() if not all(_agree(a, b) for i, a in enumerate(seen) for b in seen[:i])}
    numbers = {name: kind for name in mixed if _all_numbers(types[name]) and (kind := _number_type(frames, name))}
    for name, kind in numbers.items():
        frames = [frame.withColumns({f.name: F.col(f"`{f.name}`").cast(kind) for f in frame.schema if f.name.lower() == name}) for frame in frames]
    mixed -= numbers.keys()
    conformed = [
        reduce(_as_text, [f.name for f in frame.schema if f.name.lower() in mixed], frame) for frame in frames
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), conformed)


def align_key(df: DataFrame, key: str, target: DataType, on_mismatch: str = "cast") -> DataFrame:
    """Give a join key the type of the lookup key.

    ``cast`` converts values and yields NULL where a value cannot be converted. ``null`` replaces
    the whole key by NULL unless the target is a struct, so every row stays but none can match.
    """
    if df.schema[key].dataType == target:
        return df
    column = F.col(f"`{key}`")
    if on_mismatch == "null" and not isinstance(target, StructType):
        return df.withColumn(key, F.lit(None).cast(target))
    return df.withColumn(key, column.cast(target) if isinstance(target, StructType) else column.try_cast(target))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication. Copies collapse before the shuffle, so a hot group of copies is one row per task."""
    return df.dropDuplicates()
