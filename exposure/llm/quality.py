"""Document quality by histogram gradient-boosted trees over statistics of the whole text.

Statistics are made once for every document and kept as a narrow table. The trees are fitted in
numpy on at most TRAIN_ROWS labelled rows (those with the smallest hash of their doc_id): features
are cut into quantile bins, each split is chosen from histograms of gradients, and the trees are
stored as flat arrays of a complete binary tree, which numpy walks for a whole batch level by level.

Null and empty texts have statistics zero and get a score like any other. Rows without a doc_id
are left out; a repeated one is scored each time. Long texts are read whole. Without labels of both
kinds every score is the share of label 1 (or one half). An empty table gives an empty result. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposure.llm.frames import documents, keep_documents, smallest_hashes, text_slices
from exposure.session import materialize

TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
BINS, DEPTH, ROUNDS, RATE = 64, 4, 60, 0.15
RIDGE, LEAST_HESSIAN = 1.0, 1.0

STATISTICS = [
    "log_chars", "log_words", "letters", "upper", "digits", "blanks", "line_feeds", "marks",
    "symbols", "bars", "exclamations", "non_ascii", "word_chars", "word_chars_spread", "distinct",
    "top_word", "repeats", "repeated_pairs", "upper_words", "marked_words", "plain_words",
    "short_words", "line_chars", "repeated_lines", "sentence_ends", "longest_word",
]
_WORD = re.compile(r"[^\W\d_]+[.,;:]?")


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SETS = [
    _table(bytes([*range(65, 91), *range(97, 123)])), _table(bytes(range(65, 91))),
    _table(bytes(range(48, 58))), _table(b" \t\n\r\x0b\x0c"), _table(b"\n"),
    _table(b".,;:'\"-()?"), _table(b"#$%&*@^~<>=+/\\_{}[]`"), _table(b"|"), _table(b"!"),
    _table(bytes(range(128, 256))), _table(b".?!"),
]


def statistics(text: str) -> list[float]:
    raw = text.encode()
    if not raw:
        return [0.0] * len(STATISTICS)
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    (letters, upper, digits, blanks, feeds, marks, symbols, bars, exclaims, foreign, ends
     ) = [int(counts[s].sum()) for s in _SETS]
    words = text.split()
    m = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        np.log1p(len(text)), np.log1p(len(words)), (letters + foreign) / n,
        upper / max(1, letters), digits / n, blanks / n, feeds / n, marks / n, symbols / n,
        bars / n, exclaims / n, foreign / n, sizes.mean(), sizes.std(), len(seen) / m,
        max(seen.values(), default=0) / m, sum(map(str.__eq__, words, words[1:])) / m,
        1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        sum(map(str.isupper, words)) / m, sum(w[-1] in "#$%&*!|" for w in words) / m,
        sum(_WORD.fullmatch(w) is not None for w in words) / m, float((sizes <= 2).mean()),
        np.log1p(len(text) / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
        ends / m, np.log1p(sizes.max()),
    ]


def features(docs: DataFrame) -> DataFrame:
    """doc_id and x, its statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                made = [statistics(t) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(made, pa.list_(pa.float32()))], ["doc_id", "x"])
    return documents(docs).mapInArrow(run, "doc_id long, x array<float>")


# --- trees -------------------------------------------------------------------------------------

@dataclass
class Trees:
    """feature, threshold and leaf have one row for each tree, in the order of a complete tree."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, every = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[every, feature[at]] > threshold[at])
            out += leaf[at - (len(leaf) - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def _best_split(binned, rows, gradient, hessian, bins, ridge, least):
    """(gain, feature, bin) of the best cut of ``rows``, from one histogram over all features."""
    width = binned.shape[1]
    slots = (binned[rows] + np.arange(width) * bins).ravel()
    g = np.bincount(slots, np.repeat(gradient[rows], width), width * bins).reshape(width, bins)
    h = np.bincount(slots, np.repeat(hessian[rows], width), width * bins).reshape(width, bins)
    gl, hl = g.cumsum(1), h.cumsum(1)
    gt, ht = gl[:, -1:], hl[:, -1:]
    gr, hr = gt - gl, ht - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - gt**2 / (ht + ridge)
    gain[(hl < least) | (hr < least)] = 0
    best = int(gain.argmax())
    return gain.flat[best], best // bins, best % bins


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = BINS, depth: int = DEPTH, rounds: int = ROUNDS,
    rate: float = RATE, ridge: float = RIDGE, least: float = LEAST_HESSIAN,
) -> Trees:
    """Boost trees on the logistic loss."""
    x, inner = x.astype(np.float64), 2**depth - 1
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    trees = Trees(float(np.log(share / (1 - share))), np.zeros((0, inner), np.int64),
                  np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if len(np.unique(y)) < 2:
        return trees
    edges = _edges(x, bins)
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    margin = np.full(len(y), trees.base)
    made = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        leaf, members = np.zeros(inner + 1), {0: np.arange(len(y))}
        for at in range(inner):
            rows = members.pop(at)
            left, right = rows, rows[:0]
            if len(rows) > 1:
                gain, f, b = _best_split(binned, rows, gradient, hessian, bins, ridge, least)
                if gain > 1e-9 and b < len(edges[f]):
                    feature[at], cut[at] = f, edges[f][b]
                    goes = binned[rows, f] <= b
                    left, right = rows[goes], rows[~goes]
            members[2 * at + 1], members[2 * at + 2] = left, right
        for at in range(inner, 2 * inner + 1):
            rows = members[at]
            if len(rows):
                leaf[at - inner] = -rate * gradient[rows].sum() / (hessian[rows].sum() + ridge)
                margin[rows] += leaf[at - inner]
        made.append((feature, cut, leaf))
    trees.feature, trees.threshold, trees.leaf = (np.stack(c) for c in zip(*made))
    return trees


# --- on Spark ----------------------------------------------------------------------------------

def fold(doc_id: Column | str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def train(made: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled rows outside the held-out fold."""
    known = labels.where("quality is not null and doc_id is not null").where(
        fold("doc_id", FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.max("quality").alias("y"))
    sample = made.join(smallest_hashes(known, rows), "doc_id").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    x = np.array([r["x"] for r in sample], np.float64).reshape(-1, len(STATISTICS))
    return fit(x, np.array([float(r["y"] > 0) for r in sample]))


def score(made: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(-1, len(STATISTICS)).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(trees.score(x))], ["doc_id", "score"])
    return made.select("doc_id", "x").mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    made = materialize(features(docs), "quality-features")
    return score(made, train(made, labels))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    return keep_documents(docs, quality_scores(docs, labels).where("predicted = 1"))
