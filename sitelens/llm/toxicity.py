"""Toxicity of restored text.

Words are restored by ``deobfuscate``; a sparse logistic model over the restored words of a document
and their beginnings gives its score. Those that stand out in toxic documents of the labelled sample
are its vocabulary.

Defined results: a null text is an empty one and gets the score of a text without any such word.
Rows are scored one by one, whatever their ids. A text that is labelled toxic once is toxic, whatever
other labels it or its copies have. Without usable labels every score is 0. An empty
table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import held, held_out, stored
from sitelens.llm.deobfuscate import Restorer, gram_counts, log_chances

#: Labelled documents, and words, at most that fit the model.
FIT_ROWS, VOCABULARY = 40_000, 4096
#: Letters of the beginnings of words that are told apart, besides whole words.
BEGINNINGS = (3, 4, 5, 6, 7)
#: Scores from here on are predicted 1.
REJECT = 0.5
#: Toxic documents that a word must be in, and the least log-likelihood ratio of its share of them.
LEAST_DOCUMENTS, LEAST_RATIO = 3, 25.0
STEPS, PENALTY = 3000, 1e-4
#: Texts whose words a worker holds at a time while it hands them on.
SLICE = 256


def signs(word: str) -> list[str]:
    """The word, and its beginnings marked with a dash."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


class Model:
    """Weights of words, and the score of a text without any of them."""

    def __init__(self, chances: np.ndarray, weights: dict[str, float], base: float):
        self.chances, self.weights, self.base = chances, weights, base

    def scorer(self):
        restorer, weights = Restorer(self.chances), self.weights
        known: dict[str, tuple[str, ...]] = {}

        def telling(words: tuple[str, ...]) -> tuple[str, ...]:
            return tuple([x for word in words for x in signs(word) if x in weights])

        def score(text: str | None) -> float:
            found = restorer.found(text, known, telling)
            margin = self.base + sum(weights[x] for x in sorted(found))
            return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))

        return score


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, text, toxic`` of labelled documents that may be learned from; equal texts count once."""
    usable = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    share = min(1.0, FIT_ROWS / max(1, usable.count()))
    ticket = F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(1 << 30))
    usable = usable.where(ticket < int(share * (1 << 30)))
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    rows = docs.where("text is not null").join(F.broadcast(usable), "doc_id")
    return rows.groupBy(F.xxhash64("text").alias("key")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic")
    )


def _restored(rows: DataFrame, chances) -> DataFrame:
    """``key, toxic, words``: the distinct restored words of each text."""

    def restore(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = held(chances.value, lambda: Restorer(chances.value))
        for part in parts:
            # the words of a few hundred texts at a time
            for at in range(0, len(part), SLICE):
                some = part.iloc[at : at + SLICE]
                words = [sorted(restorer.words(x)) for x in some["text"]]
                yield pd.DataFrame({"key": some["key"], "toxic": some["toxic"], "words": words})

    return rows.mapInPandas(restore, "key long, toxic int, words array<string>")


def _by_sign(restored: DataFrame) -> DataFrame:
    """A row for each text and each of its words and beginnings, as ``signs`` gives them."""
    starts = lambda n: F.transform(
        F.filter("words", lambda x: F.length(x) > n), lambda x: F.concat(F.left(x, F.lit(n)), F.lit("-"))
    )
    every = F.array_distinct(F.concat("words", *(starts(n) for n in BEGINNINGS)))
    return restored.select("key", "toxic", F.explode(every).alias("word"))


def _standing_out(restored: DataFrame, toxic: int, clean: int) -> list[str]:
    """At most ``VOCABULARY`` words that toxic documents hold more often than clean ones."""
    counted = (
        _by_sign(restored)
        .groupBy("word")
        .agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
        .where(F.col("n1") >= LEAST_DOCUMENTS)
    )
    both, share = F.col("n1") + F.col("n0"), toxic / max(1, toxic + clean)
    ratio = 2 * (
        F.col("n1") * F.log(F.col("n1") / (both * share))
        + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / (both * (1 - share)))).otherwise(0)
    )
    best = counted.withColumn("ratio", ratio).where(
        (F.col("ratio") >= LEAST_RATIO) & (F.col("n1") > both * share)
    )
    return [x.word for x in best.orderBy(F.desc("ratio"), "word").limit(VOCABULARY).collect()]


def sparse_logistic(
    rows: np.ndarray, columns: np.ndarray, y: np.ndarray, width: int
) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L1-penalised logistic model over 0/1 features.

    ``rows`` and ``columns`` name the ones.
    """

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=w[columns], minlength=len(y)).astype("float64")

    def back(r: np.ndarray) -> np.ndarray:
        return np.bincount(columns, weights=r[rows], minlength=width).astype("float64")

    v = np.ones(width)
    for _ in range(20):
        v = back(times(v))
        v /= max(np.linalg.norm(v), 1e-12)
    rate = 1 / (0.25 * (np.linalg.norm(back(times(v))) + len(y)) / len(y))
    w = z = np.zeros(width)
    b = c = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    for step in range(STEPS):
        miss = 1 / (1 + np.exp(-np.clip(times(z) + c, -40, 40))) - y
        new = z - rate * back(miss) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * PENALTY, 0)
        new_b = c - rate * miss.mean()
        z, c = new + step / (step + 3) * (new - w), new_b + step / (step + 3) * (new_b - b)
        w, b = new, new_b
    return w, b


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from all texts of ``docs`` and the labels that may be learned from."""
    context = docs.sparkSession.sparkContext
    chances = log_chances(gram_counts(docs))
    restored = stored(_restored(_labelled(docs, labels), context.broadcast(chances)), "restored")
    n = {x["toxic"]: x["count"] for x in restored.groupBy("toxic").count().collect()}
    if not n:
        return Model(chances, {}, -40.0)
    words = _standing_out(restored, n.get(1, 0), n.get(0, 0))
    place = {x: i for i, x in enumerate(words)}
    # at most VOCABULARY rows; a text in the sample has a row for each of these that it holds
    known = docs.sparkSession.createDataFrame([*place.items()], "word string, place int")
    texts = restored.select("key", "toxic").toPandas().sort_values("key", ignore_index=True)
    held = _by_sign(restored).join(F.broadcast(known), "word").select("key", "place").toPandas()
    held = held.sort_values(["key", "place"])
    rows = np.searchsorted(texts["key"].to_numpy(), held["key"].to_numpy())
    columns = held["place"].to_numpy(dtype="int64")
    weights, base = sparse_logistic(
        rows, columns, texts["toxic"].to_numpy(dtype="float64"), len(words)
    )
    return Model(chances, {x: float(weights[i]) for x, i in place.items() if weights[i]}, base)


def chance_of(docs: DataFrame, model: Model):
    """A column function: the score of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def chance(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = held(shared.value, shared.value.scorer)
        for texts in parts:
            yield pd.Series([score(x) for x in texts], dtype="float64")

    return chance


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    chance = chance_of(docs, fitted(docs, labels))
    scored = docs.select(docs["doc_id"], chance(docs["text"]).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= REJECT, 1).otherwise(0).alias("predicted"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted 0, with all their columns."""
    return docs.where(chance_of(docs, fitted(docs, labels))(docs["text"]) < REJECT)
