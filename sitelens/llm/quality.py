"""Positive-unlabelled quality classifier.

A text is described by measures of its whole length: shares of kinds of characters, repetition of
words, lines and bytes, lengths. Trusted positives (labels of quality 1) and unlabelled documents
fit a logistic score that minimises the non-negative unbiased risk: the loss of positives as
positives, weighted by the class prior, plus the loss of unlabelled texts as negatives less the
positives' part of it, never below zero. Negative labels are not used. The class prior is estimated
from the two samples: the smallest ratio of their upper tails along a first score.

Defined results: a null text is an empty one. Rows are scored one by one, whatever their ids. With
no usable positive label every score is the constant 0.5. An empty table gives an empty result.
"""

import operator
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import held_out

#: Positives, and unlabelled documents, at most that fit the score.
FIT_ROWS = 40_000
#: Scores from here on are predicted 1.
KEEP = 0.3
STEPS, RATE, PENALTY = 600, 0.05, 1e-4

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER | np.roll(_UPPER, 32) | (np.arange(256) >= 128)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_SIGN = ~(_LETTER | _DIGIT | _BLANK) & (np.arange(256) > 32)
_STOPS = np.isin(np.arange(256), [ord(x) for x in ".,;:'\"()-?"])


def measures(text: str | None) -> list[float]:
    """What the score sees of one text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words, lines = data.split(), data.split(b"\n")
    size, n = max(1, len(data)), max(1, len(words))
    of = np.bincount(np.frombuffer(data, "uint8"), minlength=256)
    letters = max(1, of[_LETTER].sum())
    counts = Counter(words)
    top = max(counts.values(), default=0)
    again = sum(map(operator.eq, words, words[1:]))
    signs = of[_SIGN & ~_STOPS].sum()
    capital = sum(map(bytes.isupper, words))
    return [
        np.log1p(len(words)),
        np.log1p(len(counts)) / np.log1p(n) if words else 0.0,
        len(counts) / n,
        top / n,
        again / n,
        of[_UPPER].sum() / letters,
        capital / n,
        of[_DIGIT].sum() / size,
        signs / size,
        signs / n,
        of[_STOPS].sum() / n,
        of[_LETTER].sum() / size,
        np.log1p(len(data) / n),
        np.log1p(max(map(len, words), default=0)),
        len(lines) / n,
        len(set(lines)) / len(lines),
        len(zlib.compress(data, 1)) / (size + 16),
        float(not words),
    ]


def _matrix(texts) -> np.ndarray:
    if not len(texts):
        return np.zeros((0, len(measures(""))))
    return np.array([measures(x) for x in texts], dtype="float64")


class Score:
    """A logistic score over standardised measures and their squares."""

    def __init__(self, fit: np.ndarray):
        self.centre, self.scale = fit.mean(axis=0), fit.std(axis=0) + 1e-6
        self.weights: np.ndarray | None = None

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.hstack([z, z * z / 8, np.ones((len(z), 1))])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.inputs(x) @ self.weights

    def chance(self, x: np.ndarray) -> np.ndarray:
        return _chance(self.margin(x))


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def _descend(size: int, slope) -> np.ndarray:
    """Weights after ``STEPS`` steps of Adam along ``slope(weights)``."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, STEPS + 1):
        g = slope(w) + PENALTY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled texts, from a first score of both.

    The upper tail of the unlabelled can hold no smaller share of the tail of positives than the
    prior, whatever the score. Tails of under a tenth of the positives are too noisy to count. The
    smallest of many noisy ratios errs on the low side, and so it should: too high a prior would
    explain junk as positives, while too low a one only moves some scores.
    """
    at = np.quantile(positive, np.linspace(0.0, 0.9, 91))
    tail_p = (positive[:, None] >= at).mean(axis=0)
    tail_u = (unlabelled[:, None] >= at).mean(axis=0)
    noise = 1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled))
    ratio = (tail_u + noise * np.sqrt(tail_u) / 4) / np.maximum(tail_p, 1e-9)
    return float(np.clip(ratio.min(), 0.05, 0.97))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[Score, float]:
    """The score of least non-negative risk, and the class prior that it used."""
    score = Score(np.vstack([positive, unlabelled]))
    p, u = score.inputs(positive), score.inputs(unlabelled)
    first = _descend(
        p.shape[1], lambda w: _chance(u @ w) @ u / len(u) - _chance(-(p @ w)) @ p / len(p)
    )
    prior = class_prior(p @ first, u @ first)

    def slope(w: np.ndarray) -> np.ndarray:
        as_positive = -prior * _chance(-(p @ w)) @ p / len(p)
        pw, uw = p @ w, u @ w
        rest = np.logaddexp(0, uw).mean() - prior * np.logaddexp(0, pw).mean()
        as_negative = _chance(uw) @ u / len(u) - prior * _chance(pw) @ p / len(p)
        return as_positive + as_negative if rest >= 0 else -as_negative

    score.weights = _descend(p.shape[1], slope)
    return score, prior


def _drawn(rows: DataFrame, key: str) -> DataFrame:
    """About ``FIT_ROWS`` rows, or all if there are fewer; the same ones every time."""
    share = min(1.0, FIT_ROWS / max(1, rows.count()))
    ticket = F.pmod(F.xxhash64(F.lit(7), key), F.lit(1 << 30))
    return rows.where(ticket < int(share * (1 << 30)))


def _measured(texts: DataFrame) -> np.ndarray:
    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"x": list(_matrix(part["text"]))})

    found = texts.select("text").mapInPandas(rows, "x array<double>").toPandas()["x"]
    return np.array(found.tolist(), dtype="float64").reshape(len(found), len(measures("")))


def fitted(docs: DataFrame, labels: DataFrame) -> Score | None:
    """A score from ``docs`` and the labels that may be learned from; None without positives."""
    trusted = labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id")))
    chosen = _drawn(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id")
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    positive = _measured(docs.join(F.broadcast(chosen), "doc_id"))
    unlabelled = _measured(_drawn(docs.where(~held_out(F.col("doc_id"))), "doc_id"))
    if not len(positive) or not len(unlabelled):
        return None
    return fit(positive, unlabelled)[0]


def chance_of(score: Score | None):
    """A column function: the score of a text column."""

    @F.pandas_udf("double")
    def chance(texts: pd.Series) -> pd.Series:
        if score is None:
            return pd.Series(np.full(len(texts), 0.5))
        return pd.Series(score.chance(_matrix(texts)))

    return chance


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    chance = chance_of(fitted(docs, labels))
    scored = docs.select(docs["doc_id"], chance(docs["text"]).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= KEEP, 1).otherwise(0).alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with all their columns."""
    return docs.where(chance_of(fitted(docs, labels))(docs["text"]) >= KEEP)
