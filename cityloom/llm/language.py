"""Language identification by error-correcting output codes.

Every language has a codeword of bits, far from all others. For each bit a binary classifier over character n-grams says which of its two sides a text is on. The
language whose codeword loses least against all margins wins; how much a bit counts for a language is how often it was right for the language's training texts.
Where the second best loses hardly more, the answer is flagged as ambiguous.
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
from cityloom.llm.common import hash_sample, text_of

SIZES = (1, 2, 3)
BITS = 12
#: Training texts, shared out evenly among the languages; the smallest hashes are taken.
SAMPLE = 4_000
#: Up to so many languages each split of them into two sides is a bit; beyond, random bits are drawn.
EXHAUSTIVE = 6
BITS_PER_LANGUAGE_BIT = 12
DRAWS, DRAWN = 200, 100_000_000
PENALTY = 1e-5
ROUNDS = 150
#: Answers whose share is less than so much above the next one's are ambiguous.
CLEAR = 0.2
UNDETERMINED = "und"


def codewords(languages: int) -> np.ndarray:
    """One row of +1 and -1 for each language; no column is constant or the opposite of another."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (languages - 1))
        return np.where(splits[None, :] >> np.arange(languages)[:, None] & 1, 1.0, -1.0)
    width = int(np.ceil(BITS_PER_LANGUAGE_BIT * np.log2(languages)))
    random = np.random.default_rng(7)
    best, distance = None, -1
    # Fewer draws where each takes long: random words of so many bits are far apart anyway.
    for _ in range(max(1, min(DRAWS, DRAWN // (languages * languages)))):
        words = np.where(random.random((languages, width)) < 0.5, 1.0, -1.0)
        words = words[:, np.abs(words.sum(axis=0)) < languages]
        apart = (words.shape[1] - words @ words.T) / 2 + width * np.eye(languages)
        if apart.min() > distance:
            best, distance = words, apart.min()
    return best


def profile(text: str) -> np.ndarray:
    """Square roots of the shares of a text's n-gram buckets: a vector of length 1."""
    counts = np.zeros(1 << BITS, dtype=np.int64)
    for part in grams.chunks(f" {text.lower()} ", max(SIZES)):
        counts += np.bincount(grams.buckets(_letters(part), SIZES, BITS), minlength=1 << BITS)
    return np.sqrt(counts / max(counts.sum(), 1)).astype(np.float32)


def _letters(points: np.ndarray) -> np.ndarray:
    """Code points of a lower-cased text, ASCII other than letters as one kind of blank."""
    points[(points < 97) | ((points > 122) & (points < 170))] = 32
    return points


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, the bit classifiers, and how much each bit counts for each language."""

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, profiles: np.ndarray) -> np.ndarray:
        """Share of each language, per row: its codeword's weighted logistic loss, against the others'."""
        margins = profiles @ self.weights + self.bias
        losses = np.logaddexp(0, -margins[:, None, :] * self.words[None]) * self.trust[None]
        fit = -losses.sum(axis=2)
        shares = np.exp(fit - fit.max(axis=1, keepdims=True))
        return shares / shares.sum(axis=1, keepdims=True)

    def answer(self, text: str | None) -> tuple[str, float, bool]:
        """Language, share between 0 and 1, and whether the next one is close."""
        if not has_letter(text) or not self.languages:
            return UNDETERMINED, 0.0, True
        shares = self.decode(profile(text)[None])[0]
        order = np.argsort(-shares, kind="stable")
        second = shares[order[1]] if len(order) > 1 else 0.0
        return self.languages[order[0]], float(shares[order[0]]), bool(shares[order[0]] - second < CLEAR)


def fit(profiles: np.ndarray, languages: list[str]) -> Model:
    """Bit classifiers by accelerated gradient steps of logistic regression; each language weighs the same."""
    names = sorted(set(languages))
    words = codewords(len(names))
    owner = np.searchsorted(names, languages) if names else np.zeros(0, dtype=int)
    targets = words[owner] if names else np.zeros((0, 1))
    weights, bias = np.zeros((1 << BITS, words.shape[1] if names else 1), dtype=np.float32), np.zeros(words.shape[1] if names else 1)
    if len(names) > 1:
        importance = (1 / np.bincount(owner))[owner][:, None]
        importance = importance / importance.sum()
        momentum, squares, bias_momentum, bias_squares = np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)
        for step in range(1, ROUNDS + 1):
            margin = (profiles @ weights + bias) * targets
            slope = -targets / (1 + np.exp(np.clip(margin, -40, 40))) * importance
            gradient, bias_gradient = profiles.T @ slope.astype(np.float32) + PENALTY * weights, slope.sum(axis=0)
            momentum, bias_momentum = 0.9 * momentum + 0.1 * gradient, 0.9 * bias_momentum + 0.1 * bias_gradient
            squares, bias_squares = 0.99 * squares + 0.01 * gradient**2, 0.99 * bias_squares + 0.01 * bias_gradient**2
            rate = 0.3 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            weights = weights - rate * momentum / (np.sqrt(squares) + 1e-9)
            bias = bias - rate * bias_momentum / (np.sqrt(bias_squares) + 1e-9)
        right = (profiles @ weights + bias) * targets > 0
        trust = np.stack([right[owner == k].mean(axis=0) for k in range(len(names))])
        trust = trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)
    else:
        trust = np.ones_like(words)
    return Model(names, words, weights.astype(np.float32), bias, trust)


def train(texts: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from columns text and lang; rows without a language or a letter teach nothing.

    At most ``sample`` different texts, as many of each language, are used, but one of each at least: a bounded sample, which the smallest hashes choose. The driver holds it, 8 KB a
    text, and so ``sample`` or the number of languages bounds it; weights and codewords grow with the logarithm of that number. Without rows
    every answer is undetermined; with one language every text with a letter is in it.
    """
    known = texts.where("lang IS NOT NULL").select(text_of("text").alias("text"), "lang")

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = pa.array([has_letter(text) for text in batch.column(0).to_pylist()], pa.bool_())
            batch = batch.filter(lettered)
            profiles = [profile(text).astype("<f2").tobytes() for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(profiles, pa.binary()), batch.column(1), batch.column(2)], ["profile", "lang", "key"])

    languages = max(known.select("lang").distinct().count(), 1)
    chosen = hash_sample(known, "lang", max(sample // languages, 1)).select("text", "lang", "key")
    rows = chosen.mapInArrow(extract, "profile binary, lang string, key bigint").toPandas()
    rows = rows.sort_values(["lang", "key"])
    profiles = np.stack([np.frombuffer(value, dtype="<f2") for value in rows["profile"]]).astype(np.float32) if len(rows) else np.zeros((0, 1 << BITS), dtype=np.float32)
    return fit(profiles, rows["lang"].tolist())


def detect(model: Model, text: str | Column) -> Column:
    """Struct of ``lang_pred``, ``score`` and ``ambiguous`` for each whole text; NULL texts and those without a letter are undetermined."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            yield pd.DataFrame([model.answer(value) for value in series], columns=["lang_pred", "score", "ambiguous"]).astype(
                {"lang_pred": object, "score": float, "ambiguous": bool}
            )

    return answers(text_of(text))
