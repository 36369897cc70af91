"""The corpus pipeline: stages that each read what the stage before wrote.

Toxic documents go; later copies of repeated line runs go; of near-duplicates the smallest id stays; documents that hold a passage of a test go; what is
left is encoded to pieces and decoded again.

For every stage: NULL and empty texts count as empty, are never toxic by a word, repeat no line, are near each other, and hold no passage. Rows that repeat an id are rows of their own; those equal
in id and text share every answer. An empty table stays empty. Columns beside ``doc_id`` and ``text`` are passed on, whatever their names, by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityloom.llm import phrases, pieces, runs, simhash, toxicity
from cityloom.llm.common import free_name, importable, sized_shuffles
from cityloom.llm.queries import PIECE_MODEL, table, vocabulary_path
from cityloom.session import scratch_dir

#: Not expressible as SQL: trained and iterative stages. Tests hold the rows against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on their labels, scores below one half.

    An id with several labels that differ teaches nothing; without labels of both kinds among the documents every score is that of the one kind, or of none: then all stay.
    """
    importable(spark)
    with sized_shuffles(docs):
        return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of line runs of 50 words or more; ``n_chars``, if there is such a column, follows the text.

    Of equal runs that of the smallest id stays, NULL first, then that of the smallest hash of the text, then the first one. NULL texts stay NULL.
    """
    removed = free_name(docs, "removed_lines")
    with sized_shuffles(docs):
        shorter = runs.without_repeated_runs(docs, result=removed)
    if "n_chars" in docs.columns:
        counted = F.when(F.size(removed) > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        shorter = shorter.withColumn("n_chars", counted)
    return shorter.drop(removed)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; one without an id only where the whole group has none. Rows that repeat the id that stays all stay."""
    importable(spark)
    with sized_shuffles(docs):
        return simhash.one_of_each(docs, shingle=4, distance=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; items without words hold none."""
    with sized_shuffles(docs):
        return phrases.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces, begin and end id included, and the text decoded from them; of a NULL text, as of an empty one, the two ids alone."""
    importable(spark)
    coded = pieces.with_pieces(docs.select("doc_id", "text"), vocabulary_path(PIECE_MODEL))
    return coded.select("doc_id", F.floor(F.octet_length("piece_ids") / 4).alias("n_tokens"), "piece_ids", "piece_text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        path = scratch_dir(spark, name)
        with sized_shuffles(docs):
            apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
