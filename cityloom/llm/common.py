"""What several operators here share: text expressions, size-checked broadcasts, row keys."""

from __future__ import annotations

import os
import string
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityloom.session import MAX_SHUFFLE_PARTITIONS, MB_128, SHUFFLE_PARTITIONS_SETTING, stage

#: A side of a join is broadcast only when its measured size stays below this, whatever the input's size.
BROADCAST_BYTES = 16 << 20
#: What a broadcast row costs beside its values.
ROW_BYTES = 32
#: Bytes of rows that are handed to a Python worker at a time. The default of 64 MB is held several times over, by the executor and by the workers of all its cores.
BATCH_BYTES = 4 << 20
BATCH_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package at the driver's place, if it is not installed or sent along with ``--py-files``, and get rows in small batches.

    A lower limit on the bytes of a batch that the session has stays. A row larger than the limit is a batch of its own.
    """
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_BYTES_SETTING))
    if limit > BATCH_BYTES:
        spark.conf.set(BATCH_BYTES_SETTING, str(BATCH_BYTES))
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def text_of(column: str | Column) -> Column:
    """A text column with NULL read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are.

    ``lower`` does just that to a text without characters beyond ASCII, and is faster.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def size_guarded(staged: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A staged table, marked for broadcast if its rows and texts were measured to fit ``limit`` bytes.

    Otherwise it is returned as it is, and the join shuffles.
    """
    flat = 8 * len(staged.columns) + ROW_BYTES
    texts = [F.sum(F.octet_length(f.name)) for f in staged.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    texts += [F.sum(2 * F.octet_length(F.to_json(f.name))) for f in staged.schema if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    measured = staged.agg(F.count(F.lit(1)), *texts).first()
    size = measured[0] * flat + sum(value or 0 for value in measured[1:])
    return F.broadcast(staged) if size <= limit else staged


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of the named columns of both sides, NULL equal to NULL."""
    result = F.lit(True)
    for name in names:
        result = result & left[name].eqNullSafe(right[name])
    return result


def packed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``docs`` as (row, doc_id, text_key): all columns in one struct, so that none of their names can clash with others.

    A document is named by its id and a hash of its text, so that rows that repeat an id stay apart.
    """
    text_key = F.xxhash64(text_of(text_column)).alias("text_key")
    return docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), F.col(id_column).alias("doc_id"), text_key)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``docs`` is called so."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash_sample(texts: DataFrame, group: str, each: int) -> DataFrame:
    """At most ``each`` different texts of every group, with their hashes in ``key``: those with the lowest hashes. A group with fewer texts is taken whole.

    The hashes are spread evenly, so a bound below which a little more than ``each`` texts of a group lie follows from the number of its different texts. One pass counts, another
    joins the bounds, a row for each group, and only the hashes below them, a bounded number for a group, are ranked. Texts stay where their hashes put them: no task holds those of a group.
    """
    keyed = texts.withColumn("key", F.xxhash64("text"))
    # The counts are estimates within a few hundredths; the margin makes too few texts below a bound next to impossible, however small ``each``.
    share = F.lit(1.5 * each + 100) / F.col("n")
    low = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise((share * float(1 << 64) - float(1 << 63)).cast("bigint"))
    sizes = keyed.groupBy(F.col(group).alias("__group")).agg(F.approx_count_distinct("key").alias("n"))
    bounds = size_guarded(stage(sizes.select("__group", low.alias("__low")), "bounds"))
    below = keyed.join(bounds, F.col(group).eqNullSafe(F.col("__group"))).where("key <= __low").drop("__group", "__low").dropDuplicates(["key", group])
    below = stage(below, "below")
    lowest = F.row_number().over(Window.partitionBy("__group").orderBy("__key"))
    places = below.select(F.col(group).alias("__group"), F.col("key").alias("__key")).withColumn("__place", lowest)
    last = places.where(F.col("__place") <= each).groupBy("__group").agg(F.max("__key").alias("__last"))
    kept = below.join(size_guarded(stage(last, "last")), F.col(group).eqNullSafe(F.col("__group"))).where("key <= __last")
    return kept.drop("__group", "__last")


@contextmanager
def sized_shuffles(docs: DataFrame) -> Iterator[None]:
    """Within the block, shuffles begin with as many partitions as the bytes of a table ask for, one for 128 MB; run-time execution merges small ones but splits none outside joins.

    The bytes are those that the plan knows of, the sizes of the files; nothing is read.
    """
    spark = docs.sparkSession
    total = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    setting, most = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", int(spark.conf.get(SHUFFLE_PARTITIONS_SETTING, str(MAX_SHUFFLE_PARTITIONS)))
    before = spark.conf.get(setting, None)
    wanted = min(total // MB_128, most)
    if wanted <= int(before or spark.conf.get("spark.sql.shuffle.partitions")):
        yield
        return
    spark.conf.set(setting, str(wanted))
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def power_of_two(least: int) -> int:
    """The smallest power of two that is not below ``least``."""
    return 1 << max(0, int(least) - 1).bit_length()
