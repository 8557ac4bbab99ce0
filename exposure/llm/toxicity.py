"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; a sample of all documents is unlabelled text
that holds toxic documents at the class prior's rate. With p the prior, the risk is

    p * E+[loss of 1] + max(0, E_unlabelled[loss of 0] - p * E+[loss of 0])

and where the corrected part falls below zero the step goes back up it, so that the classifier
cannot explain unlabelled toxic documents away. With the logistic loss the score estimates the
probability of label 1. Features are the presence of words and of beginnings of several words (insults
are inflected): every one that is typical of the positives by its count in all documents outside the
held-out fold, made on Spark. The numpy model has one weight for each, so its size is bounded by the
words of the positives.

The weights are fitted on at most POSITIVES confirmed documents and UNLABELLED of all outside the
held-out fold, those with the smallest hash of their doc_id. Null and empty texts hold no words and get the
score of the bias; long texts are read whole. Rows without a doc_id are left out; a repeated one is
scored each time. Without positives every score is 0. An empty table gives an empty result. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposure.llm.frames import documents, smallest_hashes, text_slices
from exposure.llm.quality import fold
from exposure.session import materialize

POSITIVES, UNLABELLED = 4_000, 12_000
BEGINNINGS, TIMES = (4, 6), (1, 2, 4)
SURPRISE = 45.0
PRIOR = 0.1
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
ROUNDS, RATE, RIDGE = 400, 0.1, 1e-4

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    """The words of a text, and beginnings with a star: ``lowe*2`` says that at least two different
    longer words begin with it."""
    words = set(_WORD.findall(text.lower()))
    found = set(words)
    for n in BEGINNINGS:
        for start, times in Counter([w[:n] for w in words if len(w) > n]).items():
            found.update(f"{start}*{least}" for least in TIMES if times >= least)
    return found


class Present:
    """A matrix of zeros and ones, held as the places of the ones."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int]) -> None:
        self.rows, self.columns, self.shape = rows, columns, shape

    def __len__(self) -> int:
        return self.shape[0]

    def times(self, w: np.ndarray) -> np.ndarray:
        """The product with a weight for each column and, last, a bias."""
        return np.bincount(self.rows, w[self.columns], self.shape[0]) + w[-1]

    def back(self, s: np.ndarray) -> np.ndarray:
        """The transposed product: a sum for each column and, last, of all rows."""
        return np.append(np.bincount(self.columns, s[self.rows], self.shape[1]), s.sum())


@dataclass
class Model:
    words: list[str]
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -40, 40)))


def fit(
    positive: np.ndarray | Present, unlabelled: np.ndarray | Present, prior: float, rounds: int = ROUNDS,
    rate: float = RATE, ridge: float = RIDGE,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk (full batches, Adam)."""
    p, u = (x if isinstance(x, Present) else Present(*np.nonzero(x), x.shape)
            for x in (positive, unlabelled))
    w = np.zeros(p.shape[1] + 1)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        sp, su = 1 / (1 + np.exp(-p.times(w))), 1 / (1 + np.exp(-u.times(w)))
        toward = p.back(sp - 1) / len(p) * prior
        as_negative = u.back(su) / len(u) - prior * p.back(sp) / len(p)
        risk = -np.log1p(-su + 1e-12).mean() + prior * np.log1p(-sp + 1e-12).mean()
        gradient = toward + as_negative if risk >= 0 else -as_negative
        gradient[:-1] += ridge * w[:-1]
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _first(ids: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` ids, those with the smallest hash."""
    return smallest_hashes(ids, rows).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            found = [sorted(words_of(t)) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["positive"], pa.array(found, pa.list_(pa.string()))],
                ["doc_id", "positive", "words"])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    texts = documents(docs)
    outside = fold("doc_id", FOLDS) != HELD_OUT
    known = labels.where("doc_id is not null and toxic is not null").where(outside).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    positives = _first(known.where("toxic = 1").select("doc_id"), POSITIVES)
    # Ids only, and at most the two bounds of them.
    chosen = materialize(
        positives.withColumn("positive", F.lit(True)).union(
            _first(texts.where(outside).select("doc_id").distinct(), UNLABELLED)
            .withColumn("positive", F.lit(False))), "toxic-sample")
    found = materialize(
        texts.join(F.broadcast(chosen), "doc_id").mapInArrow(
            _words, "doc_id long, positive boolean, words array<string>"), "toxic-words")
    sizes = {r["positive"]: r["n"] for r in found.groupBy("positive").agg(
        F.count("*").alias("n")).collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    if not n_pos or not n_unl:
        return Model([], np.zeros(0), -40.0)
    prior = min(max(share if share is not None else PRIOR, 0.01), 0.5)

    words = _typical(texts.where(outside), found.where("positive"), n_pos, prior)
    spread = found.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})
    marked = found.select("doc_id", "positive", "words").mapInArrow(
        _places(spread), "doc_id long, positive boolean, at array<int>").orderBy("doc_id").toArrow()
    is_pos = marked["positive"].to_numpy()
    places = [np.array(x, np.int64) for x in marked["at"].to_pylist()]

    def present(chosen: np.ndarray) -> Present:
        held = [places[i] for i in np.flatnonzero(chosen)]
        return Present(np.repeat(np.arange(len(held)), [len(h) for h in held]),
                       np.concatenate(held), (len(held), len(words)))

    weights, bias = fit(present(is_pos), present(~is_pos), prior)
    return Model(words, weights, bias)


def _surprise(p: Column, rest: Column, n_pos: int) -> Column:
    """How surprising a share ``p`` of the positives is at the rate ``rest`` (twice the log of the
    likelihood ratio)."""
    return 2 * n_pos * p * F.ln(p / rest)


def _typical(texts: DataFrame, positives: DataFrame, n_pos: int, prior: float) -> list[str]:
    """All words typical of the positives, by their counts in all ``texts``."""
    n = texts.count()
    least = 0.5 / n
    p = positives.select(F.explode("words").alias("word")).groupBy("word").agg(
        (F.count("*") / n_pos).alias("p"))
    # A word that would not pass even if no text had it need not be counted in them.
    p = materialize(p.where(_surprise(F.col("p"), F.lit(least), n_pos) > SURPRISE), "toxic-candidates")
    spread = texts.sparkSession.sparkContext.broadcast({r["word"] for r in p.select("word").collect()})
    u = texts.select("text").mapInArrow(_count(spread), "word string, n long").groupBy("word").agg(
        (F.sum("n") / n).alias("u"))
    # The rate beyond the texts' share of positives.
    rest = F.greatest((F.col("u") - prior * F.col("p")) / (1 - prior), F.lit(least))
    return [r["word"] for r in p.join(u, "word").where(F.col("p") > 2 * rest)
            .where(_surprise(F.col("p"), rest, n_pos) > SURPRISE).select("word").orderBy("word").collect()]


def _count(spread):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, wanted = Counter(), spread.value
        for batch in batches:
            for text in batch["text"].to_pylist():
                counts.update(words_of(text) & wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"])
    return run


def _places(spread):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = spread.value
        for batch in batches:
            found = [[at[w] for w in words if w in at] for words in batch["words"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["positive"], pa.array(found, pa.list_(pa.int32()))],
                ["doc_id", "positive", "at"])
    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted."""
    bias = model.bias
    spread = docs.sparkSession.sparkContext.broadcast(dict(zip(model.words, model.weights.tolist())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = spread.value
        for batch in batches:
            for part in text_slices(batch):
                logits = np.array([
                    bias + math.fsum(weights[w] for w in words_of(t) & weights.keys())
                    for t in part["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(1 / (1 + np.exp(-np.clip(logits, -40, 40))))],
                    ["doc_id", "score"])
    return documents(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
