"""Hard negatives against whole-number brute force, pruning by the tree, and the odd inputs."""

import math

import numpy as np
from pyspark.sql import functions as F

from exposure.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>, row string, windows int, cell int, dims int"
SMALLEST, LARGEST = -(1 << 63), (1 << 63) - 1


def brute_force(rows, is_anchor):
    usable = [
        (i, label, [math.floor(x * 256) if abs(x) < 1e15 else int(x) * 256 for x in v])
        for i, label, v in rows if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (anchor, label, v) in enumerate(usable):
        if not is_anchor(anchor):
            continue
        scored = sorted(
            (-max(SMALLEST, min(LARGEST, sum(a * b for a, b in zip(v, w)))), i, other == label)
            for k, (i, other, w) in enumerate(usable) if k != at and len(w) == len(v))
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            inside = [s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(anchor, positive, rank, i, -p, -s)
                    for rank, (s, i, _) in enumerate(inside[:3], 1)]
    return sorted(out)


def mined(spark, rows, every):
    df = spark.createDataFrame([(*r, "r", 1, 2, 3) for r in rows], SCHEMA)
    found = negatives.hard_negatives(df, F.col("vec_id") % every == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                             "negative_score"]
    return sorted(map(tuple, found.collect()))


def clusters(n, dims, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((6, dims))
    return [(i, i % 3, (middles[rng.integers(6)] + spread * rng.standard_normal(dims)).tolist())
            for i in range(n)]


def test_equal_brute_force(spark, monkeypatch):
    rows = clusters(900, 12, 1)
    # ties, equal vectors in a third of all rows, repeated ids, other lengths, unusable rows
    rows += [(10_000 + i, i % 4, [1.0] * 12) for i in range(450)]
    rows += [(30, 1, [0.5] * 12), (30, 2, [0.25] * 12), (30, 1, [0.5] * 12)]
    rows += [(20_000 + i, i % 2, [float(i), 1.0]) for i in range(40)]
    rows += [(60, 0, []), (61, 0, []), (62, 1, []), (90, 1, [0.0] * 12), (None, 1, [1.0] * 12),
             (120, None, [1.0] * 12), (150, 1, None), (180, 1, [None] + [1.0] * 11),
             (210, 1, [math.nan] * 12), (240, 1, [math.inf] * 12)]
    expected = brute_force(rows, lambda i: i % 30 == 0)
    assert len(expected) > 300
    monkeypatch.setattr(negatives, "ANCHORS_IN_TASK", 7)
    monkeypatch.setattr(negatives, "ROWS_IN_TASK", (50, 200))
    assert mined(spark, rows, 30) == expected


def test_scores_beyond_doubles_and_longs(spark):
    rows = [(i, i % 2, [1e9 + i, 3.0 ** (i % 20), -float(i)]) for i in range(60)]
    rows += [(100 + i, i % 2, [1e200, 10.0 ** i]) for i in range(12)]
    assert mined(spark, rows, 10) == brute_force(rows, lambda i: i % 10 == 0)


def test_nothing_to_find(spark):
    assert mined(spark, [], 1) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [1.0])], 1) == []
    assert mined(spark, [(1, 1, [1.0]), (3, 1, [1.0])], 2) == []


def test_tree_spares_scores():
    """Near anchors: most rows are ruled out by the bounds, and the tree is a spanning tree."""
    rng = np.random.default_rng(3)
    middles = rng.standard_normal((8, 32)) * 4
    points = np.repeat(middles, 20, 0) + 0.02 * rng.standard_normal((160, 32))
    order, parent, edge = negatives.spanning_tree(points)
    assert sorted(order) == list(range(160))
    assert all(parent[i] in order[:i] for i in range(1, 160))
    assert (edge[1:] < 1).sum() >= 152
    rows = {"row": np.arange(3000) + 1000, "vec_id": np.arange(3000),
            "label": np.array(["x"] * 3000, object),
            "v": middles[rng.integers(8, size=3000)] + 0.02 * rng.standard_normal((3000, 32))}
    block = negatives.Block(
        {"row": np.arange(160), "vec_id": np.arange(160), "label": np.array(["a"] * 160, object),
         "v": points, "windows": [[int(1e7)]] * 160}, 3)
    block.meet(rows, same=False)
    assert block.scored < 0.5 * 160 * 3000
