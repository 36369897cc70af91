"""Sharding by jump consistent hashing.

A row's shard follows from its key and the number of shards alone. When shards are appended, a row either stays or
moves into a new shard, and no table of the ring is kept. The hash is the published one (Lamping and Veach), written as a fold over a
sequence; products of 64-bit numbers are taken as decimals, which hold them exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityloom.llm.common import size_guarded, text_of
from cityloom.session import stage

MULTIPLIER = 2862933555777941757
#: A row takes about ln(shards) jumps; those that take more go on in a second fold, which no other row pays for.
FIRST_JUMPS = 40


def _fold(start: str, steps: int, shards: int) -> str:
    jump = f"""
        transform(array(CAST((s.k * CAST({MULTIPLIER} AS DECIMAL(19,0)) + 1) % CAST(18446744073709551616 AS DECIMAL(20,0)) AS DECIMAL(20,0))),
            k -> named_struct('b', s.j, 'j', CAST(floor((s.j + 1) * (2147483648D / CAST((k DIV 8589934592) + 1 AS DOUBLE))) AS BIGINT), 'k', k))[0]"""
    return f"aggregate(sequence(1, {steps}), {start}, (s, i) -> CASE WHEN s.j < {shards} THEN {jump} ELSE s END)"


def jump_shard(key: str, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a bigint column; NULL goes where 0 goes. Hash other types first."""
    if shards < 1:
        raise ValueError("at least one shard")
    unsigned = f"coalesce(CAST(`{key}` AS DECIMAL(20,0)), 0) + CASE WHEN `{key}` < 0 THEN CAST(18446744073709551616 AS DECIMAL(20,0)) ELSE 0 END"
    start = f"named_struct('b', -1L, 'j', 0L, 'k', CAST({unsigned} AS DECIMAL(20,0)))"
    folded = _fold(start, min(shards, FIRST_JUMPS), shards)
    if shards > FIRST_JUMPS:
        folded = f"transform(array({folded}), f -> CASE WHEN f.j < {shards} THEN {_fold('f', shards - FIRST_JUMPS, shards)} ELSE f END)[0]"
    return F.expr(f"CAST({folded}.b AS INT)")


def assign_shards(docs: DataFrame, shards: int, grown: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Shard and gapless slot of every row: id, ``size``, ``text_crc32``, ``shard``, ``slot``, ``grown_shard``.

    Slots number a shard's rows from 0 in the order of id, checksum and size. Rows are numbered in pieces of a range partitioning, and
    each piece starts where the pieces before it end, so no task sees a whole shard. ``grown_shard`` is the shard among ``grown`` (one more by default).

    NULL ids go where 0 goes and come first; rows equal in all three take neighboring slots; NULL text has size 1 and checksum 0.
    An empty table gives no rows; other columns of ``docs`` play no part.
    """
    text = text_of(text_column)
    keyed = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = ("doc_id", "text_crc32", "size")
    placed = keyed.withColumns({"shard": jump_shard("doc_id", shards), "grown_shard": jump_shard("doc_id", grown or shards + 1)})
    pieces = stage(placed.repartitionByRange(*order).withColumn("piece", F.spark_partition_id()), "pieces")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pieces.groupBy("shard", "piece")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "piece", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    numbered = pieces.withColumn("within", F.row_number().over(Window.partitionBy("piece", "shard").orderBy(*order)))
    return numbered.join(size_guarded(stage(offsets, "offsets")), ["shard", "piece"]).select(
        F.col("doc_id").alias(id_column),
        "size",
        "text_crc32",
        "shard",
        (F.col("offset") + F.col("within") - 1).cast("bigint").alias("slot"),
        "grown_shard",
    )
