"""Exact de-duplication with a two-pass Bloom filter.

The first pass sets three bits per row in a filter cut into pages and keeps only those bits that
two or more rows have set. A row of which every bit was kept may have an equal partner; only such rows are shuffled
by their hash, and all others pass straight through. What the filter wrongly lets through is sorted out by the exact grouping.

A row's bits lie in one page, and a page is one row of a table: 4 KB for the bits of some 2,000 rows. The pages are broadcast. Where they are too many for one broadcast, the
hashes are dealt into files by ranges of pages, without a shuffle, and the ranges are looked up one after another, each in its own pages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityloom.llm.common import packed, same, size_guarded, text_of
from cityloom.session import scratch_dir, stage

#: Deleted before texts are compared.
WHITESPACE = r"[\x20\x09-\x0D]+"
#: With sixteen bits a row and three hashes, one single row in some two hundred passes by chance.
BITS_PER_ROW = 16
HASHES = 3
#: Fixed value: bits of the bitmaps that Spark's functions make.
PAGE_BITS = 1 << 15
#: Bytes of pages that are broadcast at a time.
PAGES_BYTES = 32 << 20


def normalized(text: str | Column) -> Column:
    """The text without white space; NULL as empty."""
    return F.regexp_replace(text_of(text), WHITESPACE, "")


def _places() -> list[Column]:
    """Where in its page a row's bits are."""
    mixed = F.xxhash64("row_hash", F.lit("bits"))
    return [F.shiftrightunsigned(mixed, 15 * i).bitwiseAND(F.lit(PAGE_BITS - 1)) for i in range(HASHES)]


def _has_bit(page: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(page, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, (place % 8).cast("int")) == 1


def twice_set(hashes: DataFrame, pages: int) -> DataFrame:
    """First pass: filter pages (page, twice) holding the bits that at least two rows set; pages without one are left out.

    What moves is up to three small rows a document, equal ones of a task as one, so a frequent text costs one small row per task. Bitmaps of each task would be larger
    as soon as the rows are dealt to more than some dozens of tasks.
    """
    slots = hashes.select(F.pmod("row_hash", F.lit(pages)).alias("page"), F.explode(F.array_distinct(F.array(*_places()))).alias("place"))
    repeated = slots.groupBy("page", "place").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return repeated.groupBy("page").agg(F.bitmap_construct_agg("place").alias("twice"))


def with_possible_repeats(hashes: DataFrame, bits_per_row: int = BITS_PER_ROW, pages_bytes: int | None = None) -> DataFrame:
    """Second pass: a staged table with column ``row_hash``, plus boolean ``may_repeat``; never false for a repeated hash. No row is shuffled."""
    pages = hashes.count() * bits_per_row // PAGE_BITS + 1
    bloom = stage(twice_set(hashes, pages), "bloom")
    at_a_time = max(1, (pages_bytes or PAGES_BYTES) // (PAGE_BITS // 8 + 64))
    ranges = -(-bloom.count() // at_a_time)
    paged = hashes.withColumn("page", F.pmod("row_hash", F.lit(pages)))
    found = F.lit(True)
    for place in _places():
        found = found & _has_bit(F.col("twice"), place)

    def looked_up(rows: DataFrame, part: DataFrame) -> DataFrame:
        # About ``pages_bytes``.
        return rows.join(F.broadcast(part), "page", "left").withColumn("may_repeat", F.coalesce(found, F.lit(False))).drop("page", "twice")

    if ranges <= 1:
        return looked_up(paged, bloom)
    path = scratch_dir(hashes.sparkSession, "paged-hashes")
    paged.withColumn("page_range", F.expr(f"page % {ranges}")).write.partitionBy("page_range").parquet(path)
    dealt = hashes.sparkSession.read.parquet(path)
    parts = [looked_up(dealt.where(F.col("page_range") == i).drop("page_range"), bloom.where(F.expr(f"page % {ranges}") == i)) for i in range(ranges)]
    return reduce(DataFrame.unionByName, parts)


def find_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """For each row of ``docs`` which row of its equal texts stays.

    Texts are equal when they are after white space is deleted. The row with the most code points stays, of those the one with the
    smallest id (NULL first). Returns id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``may_repeat``, one row per input row.

    NULL texts count as empty, so NULL, empty and blank texts are one group. Rows that repeat id and text count each in
    ``group_size``, and just one of them is kept. An empty table gives no rows; other columns of ``docs`` play no part.
    """
    text = text_of(text_column)
    keyed = docs.select(
        F.col(id_column).alias("doc_id"),
        F.sha2(normalized(text_column), 256).alias("text_sha256"),
        F.char_length(text).alias("points"),
        F.monotonically_increasing_id().alias("row_id"),
    ).withColumn("row_hash", F.xxhash64("text_sha256"))
    flagged = with_possible_repeats(stage(keyed, "hashes"), bits_per_row)
    passed = flagged.where(~F.col("may_repeat")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "may_repeat"
    )
    suspects = flagged.where("may_repeat")
    groups = suspects.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct((-F.col("points")).alias("shorter"), "doc_id", "row_id")).alias("best"),
    )
    # Staged, so that the rows meet one row per repeated text: by broadcast, or in a join whose hot texts run-time execution splits.
    repeated = groups.where("copies > 1").select("text_sha256", "copies", F.col("best.doc_id").alias("best_id"), F.col("best.row_id").alias("best_row"))
    single = F.col("copies").isNull()
    checked = suspects.join(size_guarded(stage(repeated, "repeated")), "text_sha256", "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).alias("group_size"),
        (single | (F.col("best_row") == F.col("row_id"))).alias("kept"),
        "text_sha256",
        "may_repeat",
    )
    return passed.unionByName(checked).withColumnRenamed("doc_id", id_column)


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and texts; rows equal in id and text count as one."""
    staying = find_copies(docs, id_column, text_column).where("kept").select(F.col(id_column).alias("doc_id"), "text_sha256")
    rows = packed(docs, id_column, text_column).withColumn("text_sha256", F.sha2(normalized(F.col(f"row.`{text_column}`")), 256))
    kept = rows.join(staying, same(rows, staying, "doc_id", "text_sha256"), "left_semi")
    return kept.dropDuplicates(["doc_id", "text_sha256"]).select("row.*")
