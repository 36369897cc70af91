"""Line de-duplication by a suffix array over the lines of all documents.

Every line gets an id, and the suffixes of the documents' line sequences are ranked by prefix doubling: the ranks by 2h lines are the sorted pairs of the
ranks by h lines at a place and h lines further on. Suffixes that no other one equals so far are ranked for good and drop out, so each round works on
repeated stretches only. Ranks are given by range partitions of the distinct pairs, so a frequent line is one row there.

The suffixes that share their first d lines, an interval of the suffix array with a longest common prefix of d or more, are those that agree in their ranks by h
lines at the beginning and at d - h, for h the largest power of two up to d. Any run of lines of ``min_words`` words or more is covered by the shortest
runs of so many words that begin or end at one of its lines, so intervals are taken at the depths of these: their first suffix is the copy that stays,
and what the others cover is the union of all maximal repeated runs without their first copies. A run so short has no more lines than words, so a
few rounds suffice at any size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityloom.llm.common import packed, same, size_guarded, text_of
from cityloom.session import stage

MIN_WORDS = 50

_KEY = ("doc_id", "text_key")


#: White space of any script, with the zero-width space that parts words in some.
_SPACE = r"\s\p{Z}\x1C-\x1F\x85\u200B"
#: Scripts that do not part words by spaces: Thai to Myanmar, Khmer, Tai, Balinese, Javanese, Chinese and Japanese with their punctuation, Yi.
_SPACELESS = (
    r"\u0E00-\u109F\u1780-\u17FF\u1950-\u19DF\u1A20-\u1AAF\u1B00-\u1B7F\u3001-\u312F\u31A0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF"
    r"\uA000-\uA4CF\uA980-\uA9FF\uAA60-\uAADF\uF900-\uFAFF\uFF61-\uFF9F\x{1B000}-\x{1B16F}\x{20000}-\x{3FFFF}"
)
WORD = rf"[{_SPACELESS}]|[^{_SPACE}{_SPACELESS}]+"
#: A character that makes a line count.
FILLED = rf"[^{_SPACE}]"
#: All white space but the blank and all spaceless scripts are among these, and little else, so that most lines are counted by their blanks.
_OTHER = r"[\x00-\x1F\x7F-\xA0\u0E00-\u200B\u2028-\u202F\u205F\u3000-\x{10FFFF}]"


def line_words(line: Column) -> Column:
    """Words of a line: what white space separates, and each character of a script without spaces. 0 for a blank line only."""
    plain = F.size(F.array_remove(F.split(line, " "), ""))
    return F.when(line.rlike(_OTHER), F.regexp_count(line, F.lit(WORD))).otherwise(plain)


def line_table(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The lines that are not blank, in one staged row each: document, ``line_no``, ``pos`` among them, two hashes, ``words``."""
    text = text_of(text_column)
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("line_no"), line.alias("line")))
    filled = F.filter(lines, lambda x: x["line"].rlike(FILLED))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.posexplode(filled).alias("pos", "x"))
    line = F.col("x.line")
    hashes = (F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))
    return stage(rows.select(*_KEY, "pos", "x.line_no", *hashes, line_words(line).alias("words")), "lines")


def ranked(keys: DataFrame, *order: str) -> DataFrame:
    """Distinct rows numbered in sorted order from 0, over range partitions."""
    pieces = stage(keys.repartitionByRange(*order).withColumn("piece", F.spark_partition_id()), "sorted")
    # One row per range partition goes through this window.
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("rows"))
    offsets = stage(sizes.select("piece", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")), "offsets")
    within = F.row_number().over(Window.partitionBy("piece").orderBy(*order))
    numbered = pieces.withColumn("within", within).join(size_guarded(offsets), "piece")
    return stage(numbered.select(*order, (F.col("offset") + F.col("within") - 1).alias("rank")), "ranks")


def _repeated(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` whose key others share, with the rank of the key; staged."""
    shared = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(*key)
    return stage(rows.join(size_guarded(ranked(shared, *key)), list(key)), "level")


def _minimal_runs(active: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs of ``min_words`` words that begin or end at each line: document, ``start``, ``len``, first and last line.

    Only stretches of neighboring repeated lines count.
    """
    in_doc = Window.partitionBy(*_KEY).orderBy("pos")
    # Rows that repeat id and text give equal rows here, which dense ranks keep apart from neighbors.
    stretches = active.select(*_KEY, "pos", "line_no", "words").distinct()
    stretches = stretches.withColumn("stretch", F.col("pos") - F.row_number().over(in_doc))
    place = F.struct("words", "line_no")
    along = Window.partitionBy(*_KEY, "stretch").orderBy("pos")
    forward = F.collect_list(place).over(along.rowsBetween(0, min_words - 1))
    backward = F.reverse(F.collect_list(place).over(along.rowsBetween(1 - min_words, 0)))

    def shortest(lines: Column) -> Column:
        zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("len"), F.lit(0).alias("line_no"))
        return F.aggregate(
            lines,
            zero,
            lambda run, line: F.when(run["words"] >= min_words, run).otherwise(
                F.struct((run["words"] + line["words"]).alias("words"), (run["len"] + 1).alias("len"), line["line_no"].alias("line_no"))
            ),
        )

    runs = stretches.withColumns({"f": shortest(forward), "b": shortest(backward)})
    begin_here = runs.where(F.col("f.words") >= min_words).select(
        *_KEY, F.col("pos").alias("start"), F.col("f.len").alias("len"), F.col("line_no").alias("first_line"), F.col("f.line_no").alias("last_line")
    )
    end_here = runs.where(F.col("b.words") >= min_words).select(
        *_KEY, (F.col("pos") - F.col("b.len") + 1).alias("start"), F.col("b.len").alias("len"), F.col("b.line_no").alias("first_line"), F.col("line_no").alias("last_line")
    )
    return stage(begin_here.union(end_here).distinct(), "runs")


def _levels(active: DataFrame, longest: int) -> DataFrame:
    """Ranks of repeated stretches by 1, 2, 4, ... lines, as (level, document, pos, rank)."""
    level, tables = 0, [active.select(F.lit(0).alias("level"), *_KEY, "pos", "rank")]
    current = tables[0]
    while 2 << level <= longest:
        further = Window.partitionBy(*_KEY).orderBy("pos").rangeBetween(1 << level, 1 << level)
        pairs = current.withColumn("next", F.first("rank").over(further)).where("next IS NOT NULL")
        pairs = pairs.select(*_KEY, "pos", F.col("rank").alias("left"), F.col("next").alias("right"))
        level += 1
        current = _repeated(pairs, "left", "right").select(F.lit(level).alias("level"), *_KEY, "pos", "rank")
        tables.append(current)
    return reduce(DataFrame.union, tables)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Later copies of repeated runs: (doc_id, text_key, start, len, first_line, last_line), overlapping where the maximal run is longer; staged.

    A copy is later than another by (id, hash of the text, line); NULL ids come first. Later copies may overlap the first one: of text that repeats
    itself with a period shorter than a run, all but the lines before the second copy go, so no whole run of it stays.
    """
    lines = line_table(docs, id_column, text_column)
    active = _repeated(lines, "h1", "h2")
    runs = _minimal_runs(active, min_words)
    longest = runs.agg(F.max("len")).first()[0] or 0
    levels = _levels(active, longest).distinct()
    level = F.floor(F.log2("len")).cast("int")
    wanted = runs.withColumns({"level": level, "shift": (F.col("len") - F.expr("shiftleft(1, floor(log2(len)))")).cast("int")})
    at_start = levels.select("level", *_KEY, F.col("pos").alias("start"), F.col("rank").alias("left"))
    at_end = levels.select("level", *_KEY, F.col("pos").alias("end"), F.col("rank").alias("right"))
    wanted = wanted.join(at_start, same(wanted, at_start, "level", *_KEY, "start")).select(wanted["*"], "left")
    wanted = wanted.withColumn("end", F.col("start") + F.col("shift"))
    placed = stage(wanted.join(at_end, same(wanted, at_end, "level", *_KEY, "end")).select(wanted["*"], "right"), "intervals")
    here = F.struct("doc_id", "text_key", "start")
    intervals = placed.groupBy("len", "left", "right").agg(F.count(F.lit(1)).alias("copies"), F.min(here).alias("kept")).where("copies > 1")
    later = placed.join(size_guarded(stage(intervals, "kept")), ["len", "left", "right"]).where(here > F.col("kept"))
    return stage(later.select(*_KEY, "start", "len", "first_line", "last_line"), "copies")


def _merged(copies: DataFrame) -> DataFrame:
    """Runs of a document joined where they overlap or touch; positions do not count blank lines."""
    in_doc = Window.partitionBy(*_KEY).orderBy("start", "len")
    before = F.max(F.col("start") + F.col("len")).over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    opening = F.when(F.col("start") <= before, 0).otherwise(1)
    stretches = copies.withColumn("opening", opening).withColumn("stretch", F.sum("opening").over(in_doc))
    return stretches.groupBy(*_KEY, "stretch").agg(F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line"))


def without_repeated_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text", result: str = "removed_lines"
) -> DataFrame:
    """``docs`` without the lines of later copies, plus an array of the ranges (first, last) of line numbers that were taken out.

    All rows and other columns stay; a column named like the result is replaced. Blank lines belong to no run; those between two lines that go, go too.
    NULL texts stay NULL, and a text that loses all its lines becomes empty. Rows equal in id and text are one document and get the same text.
    """
    copies = repeated_runs(docs, min_words, id_column, text_column)
    line_range = F.struct(F.col("first_line").alias("first"), F.col("last_line").alias("last"))
    per_doc = _merged(copies).groupBy(*_KEY).agg(F.sort_array(F.collect_set(line_range)).alias("ranges"))
    # Texts are shuffled only where the ranges are too many for a broadcast.
    per_doc = size_guarded(stage(per_doc, "ranges"))
    rows = packed(docs.drop(result), id_column, text_column)
    joined = rows.join(per_doc, same(rows, per_doc, *_KEY), "left").select("row", "ranges")
    text = F.col(f"row.`{text_column}`")

    def without_ranges(lines: Column) -> Column:
        """Line numbers are compared as sets, so that many lines and many ranges take no more than their sum."""
        gone = F.flatten(F.transform("ranges", lambda r: F.sequence(r["first"], r["last"])))
        staying = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(staying, lambda i: F.get(lines, i)), "\n")

    # The one-element array binds the lines once.
    cut = F.transform(F.array(F.split(text, "\n")), without_ranges)[0]
    shorter = F.when(F.col("ranges").isNull(), text).otherwise(cut)
    kept = [shorter.alias(name) if name == text_column else F.col(f"row.`{name}`") for name in rows.schema["row"].dataType.names]
    none = F.array().cast("array<struct<first:int,last:int>>")
    return joined.select(*kept, F.coalesce("ranges", none).alias(result))
