"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A feature is whether a text holds an n-gram of a bucket. Its scale is the log of how much more often toxic than clean training texts hold it, counted over all of
them by the executors. A logistic regression over the scaled features is then fitted on a bounded sample, beginning with weight 1 for all, which is naive
Bayes. Features with a ratio near 0 tell nothing and are left out, so a model is a short list of buckets and weights.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityloom.llm import grams
from cityloom.llm.common import hash_sample, size_guarded, text_of
from cityloom.session import stage

SIZES = (3, 4, 5)
BITS = 20
#: Training texts of each label that the weights are fitted on; the ratios come from all.
SAMPLE = 6_000
#: Least absolute log ratio, and least number of training texts, of a feature.
LEAST_RATIO = 1.5
LEAST_TEXTS = 4
#: Added to the counts of a bucket, shared out in proportion to the labels, so that an unseen one has ratio 0.
SMOOTHING = 2.0
PENALTY = 2e-4
ROUNDS = 120


@dataclass(frozen=True)
class Model:
    """The buckets that are features, their weights, and what is added to the sum of a text's weights."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        """Weights by bucket; 0 where there is no feature."""
        table = np.zeros(1 << BITS, dtype=np.float32)
        table[self.buckets] = self.weights
        return table


def features(text: str, table: np.ndarray) -> np.ndarray:
    """The distinct buckets of a text that are not 0 in ``table``."""
    found = []
    for part in grams.chunks(text.lower(), max(SIZES)):
        held = grams.buckets(part, SIZES, BITS)
        found.append(held[table[held] != 0])
    return np.unique(np.concatenate(found))


def score(text: str, table: np.ndarray, bias: float) -> float:
    """The probability of label 1."""
    margin = float(table[features(text, table)].sum(dtype=np.float64)) + bias
    return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def count_features(texts: DataFrame) -> DataFrame:
    """In how many rows of each label each bucket occurs: (bucket, clean, toxic); bucket -1 counts the rows. Staged.

    ``texts`` has columns text and label. Each task adds up its own rows first.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), dtype=np.int64)
        rows = np.zeros(2, dtype=np.int64)
        distinct = grams.Distinct(BITS)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = [distinct(grams.buckets(part, SIZES, BITS)) for part in grams.chunks(text.lower(), max(SIZES))]
                counts[label, parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))] += 1
                rows[label] += 1
        held = np.flatnonzero(counts.any(axis=0))
        columns = (np.append(held, -1), *(np.append(counts[label, held], rows[label]) for label in (0, 1)))
        for at in range(0, len(held) + 1, 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(column[at : at + (1 << 16)]) for column in columns], ["bucket", "clean", "toxic"])

    counted = texts.select("text", "label").mapInArrow(count, "bucket bigint, clean bigint, toxic bigint")
    return stage(counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "counts")


def log_ratios(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """Buckets that are features, their log ratios, and how many clean and toxic rows there are.

    The ratio is the log of a bucket's share among toxic rows over its share among clean ones. What reaches the driver is bounded by the number of buckets.
    """
    rows = counts.where("bucket = -1").first()
    clean, toxic = (rows["clean"], rows["toxic"]) if rows else (0, 0)
    if not clean or not toxic:
        return np.zeros(0, dtype=np.int64), np.zeros(0), (clean, toxic)
    part = toxic / (clean + toxic)
    shares = ((F.col(name) + SMOOTHING * p) / n for name, p, n in (("toxic", part, toxic), ("clean", 1 - part, clean)))
    found = counts.where((F.col("bucket") >= 0) & (F.col("clean") + F.col("toxic") >= LEAST_TEXTS)).select("bucket", F.log(next(shares) / next(shares)).alias("ratio"))
    kept = found.where(F.abs("ratio") >= LEAST_RATIO).orderBy("bucket").toPandas()
    return kept["bucket"].to_numpy(), kept["ratio"].to_numpy(), (clean, toxic)


def sample_features(texts: DataFrame, buckets: np.ndarray, each: int = SAMPLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of at most ``each`` different texts of each label: those whose hashes are lowest."""
    table = Model(buckets, np.ones(len(buckets), dtype=np.float32), 0.0)

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = table.table()
        for batch in batches:
            held = pa.array([features(text, dense).astype(np.int32) for text in batch.column(0).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([held, batch.column(1), batch.column(2)], ["features", "label", "key"])

    sample = hash_sample(texts.select("text", "label"), "label", each).select("text", "label", "key")
    rows = sample.mapInArrow(extract, "features array<int>, label int, key bigint").toPandas()
    rows = rows.sort_values(["label", "key"])
    return [np.asarray(held, dtype=np.int64) for held in rows["features"]], rows["label"].to_numpy()


def fit_weights(held: list[np.ndarray], labels: np.ndarray, buckets: np.ndarray, ratios: np.ndarray, share: float) -> Model:
    """Logistic regression over the scaled features by accelerated gradient steps, starting from naive Bayes.

    Each label weighs as its ``share`` among all training texts says, however it was sampled.
    """
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), 30.0 if len(labels) and labels[0] else -30.0)
    flat = np.searchsorted(buckets, np.concatenate(held))
    scale = ratios
    lengths = np.fromiter(map(len, held), dtype=np.int64, count=len(held))
    rows = np.repeat(np.arange(len(held)), lengths)
    values = scale[flat]
    importance = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    importance /= importance.sum()
    theta, bias = np.ones(len(buckets)), np.log(share / (1 - share))
    momentum, bias_momentum, squares, bias_squares = np.zeros(len(buckets)), 0.0, np.zeros(len(buckets)), 0.0
    for step in range(1, ROUNDS + 1):
        margin = np.bincount(rows, weights=theta[flat] * values, minlength=len(held)) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels) * importance
        gradient = np.bincount(flat, weights=error[rows] * values, minlength=len(buckets)) + PENALTY * theta
        bias_gradient = error.sum()
        momentum = 0.9 * momentum + 0.1 * gradient
        squares = 0.99 * squares + 0.01 * gradient**2
        bias_momentum = 0.9 * bias_momentum + 0.1 * bias_gradient
        bias_squares = 0.99 * bias_squares + 0.01 * bias_gradient**2
        rate = 0.1 / (1 + step / 40)
        fix = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        theta -= rate * fix * momentum / (np.sqrt(squares) + 1e-9)
        bias -= rate * fix * bias_momentum / (np.sqrt(bias_squares) + 1e-9)
    return Model(buckets, (theta * scale).astype(np.float32), float(bias))


def train(texts: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from columns text and label (0 or 1); rows with a NULL label, or another one, teach nothing, and NULL texts count as empty.

    Ratios come from all rows; weights from ``sample`` different texts of each label. With rows of one label only, every score says that label;
    without rows, label 0.
    """
    known = texts.where("label IN (0, 1)").select(text_of("text").alias("text"), F.col("label").cast("int").alias("label"))
    buckets, ratios, (clean, toxic) = log_ratios(count_features(known))
    if not clean or not toxic:
        return fit_weights([], np.ones(1 if toxic else 0), buckets, ratios, 0.0)
    held, labels = sample_features(known, buckets, sample)
    return fit_weights(held, labels, buckets, ratios, toxic / (clean + toxic))


def toxic_score(model: Model, text: str | Column) -> Column:
    """The probability of label 1 of each whole text; NULL as empty."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.table()
        for series in batches:
            yield pd.Series([score(value, table, model.bias) for value in series], dtype=np.float64)

    return scores(text_of(text))


def labelled(docs: DataFrame, labels: DataFrame, label_column: str = "toxic", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Training rows (text, label): documents with a label whose id's checksum leaves a remainder by 5.

    NULL ids have no label. Labels that repeat for an id count once; an id with different ones teaches nothing. Documents that repeat an id each have its label.
    """
    each = labels.select(F.col(id_column).alias("__id"), F.col(label_column).alias("label")).where("__id IS NOT NULL AND label IS NOT NULL")
    slim = each.groupBy("__id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    slim = size_guarded(stage(slim, "labels"))
    rows = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text")).where(~held_out("__id"))
    return rows.join(slim, "__id").select("text", "label")


def held_out(column: str) -> Column:
    """Whether the checksum of an id, as text, is a multiple of 5: such rows train nothing."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with their columns."""
    return docs.where(toxic_score(train(labelled(docs, labels)), docs["text"]) < 0.5)
