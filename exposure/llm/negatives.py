"""Hard negatives within a score window, found with bounds along a spanning tree of the anchors.

Vectors are scaled to whole numbers, so scores (inner products) are exact. The rows of a task meet a
block of anchors, which are joined by a minimum spanning tree. A row's score at an anchor differs
from its score at the parent by at most the length of the edge times the row's norm: that bounds it
at the child, from the exact score or the bounds at the parent. Only rows whose bounds overlap the
window that is searched are scored; the window closes in as better rows are found.

Two searches: the positives of an anchor (best rows of its label, the window open above), then for
each positive the best rows of other labels between the shares LOW and HIGH of its score. Anchors
meet all rows in blocks: rows of a group (label, number of components) are dealt over g parts, its
anchors over h, and every pair of parts is a task that holds its anchors and streams its rows. Tasks
pass on a few rows for each anchor, which are ranked again.

Rows without a vec_id or label, with a null vector or a null or non-finite component take no part;
vectors of different length do not meet, and empty ones score 0. A repeated vec_id is another row
each time, and another anchor. Equal scores go by vec_id. A positive of negative score has an empty
window, one of score 0 takes negatives of score 0. Scores beyond 64 bits count as the largest or
smallest long. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exposure.llm.frames import lookup
from exposure.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive's score
ANCHORS_IN_TASK = 1024
ROWS_IN_TASK = (1_000, 1_000_000)
ROWS_AT_ONCE = 2048

EXACT = float(1 << 52)  # below it, sums of whole numbers are exact in doubles
SLACK = 1e-9
LONG = (1 << 63) - 1

_FOUND = pa.schema([("anchor", pa.int64()), ("turn", pa.int32()), ("score", pa.int64()),
                    ("vec_id", pa.int64()), ("row", pa.int64())])
FOUND = "anchor long, turn int, score long, vec_id long, row long"


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree by Prim: the nodes as they join, and each one's parent and edge."""
    n = len(points)
    order, parent, edge = np.zeros(n, int), np.zeros(n, int), np.zeros(n)
    near, closest = np.full(n, np.inf), np.zeros(n, int)
    outside, at = np.ones(n, bool), 0
    for turn in range(n):
        order[turn], parent[turn], edge[turn] = at, closest[at], near[at]
        outside[at] = False
        apart = np.linalg.norm(points - points[at], axis=1)
        closer = outside & (apart < near)
        near[closer], closest[closer] = apart[closer], at
        at = int(np.argmin(np.where(outside, near, np.inf))) if turn < n - 1 else 0
        if not outside[at] and turn < n - 1:  # distances that overflow
            at = int(np.flatnonzero(outside)[0])
    return order, parent, edge


def _whole(x: float) -> int:
    return math.floor(x * SCALE) if abs(x) < 2.0 ** 52 else int(x) * SCALE


class Block:
    """The anchors of a task, their tree, and the best rows found for them so far."""

    def __init__(self, rows: dict[str, np.ndarray], take: int) -> None:
        self.rows, self.take = rows, take
        self.points = np.floor(rows["v"] * SCALE)
        self.norms = np.linalg.norm(self.points, axis=1)
        self.order, self.parent, self.edge = spanning_tree(self.points)
        self.children = np.bincount(self.parent[1:], minlength=len(self.order))
        n, windows = len(self.points), rows["windows"]
        # Windows as whole percents of the score, compared as 100 * score.
        self.windows = [[(-math.inf, math.inf)]] * n if windows is None else [
            [(LOW * p, HIGH * p) for p in w] for w in windows]
        self.best = [[[] for _ in w] for w in self.windows]
        self.scored = 0

    def _lowest(self, a: int) -> float:
        """No score below it (times 100) can still count for anchor a."""
        return min((max(w[0], 100 * b[-1][0] if len(b) == self.take else -math.inf)
                    for w, b in zip(self.windows[a], self.best[a])), default=math.inf)

    def _keep(self, a: int, scores, ids, rows) -> None:
        for (low, high), best in zip(self.windows[a], self.best[a]):
            mine = (100 * scores >= low) & (100 * scores <= high)
            if len(best) == self.take:
                mine &= scores >= best[-1][0]
            at = np.flatnonzero(mine)
            if len(at):
                at = at[np.lexsort((ids[at], -scores[at]))[:self.take]]
                best.extend(zip(scores[at].tolist(), ids[at].tolist(), rows[at].tolist()))
                best.sort(key=lambda x: (-x[0], x[1], x[2]))
                del best[self.take:]

    def meet(self, rows: dict[str, np.ndarray], same: bool) -> None:
        """``same``: rows of the anchor's label but not itself; else rows of other labels."""
        points = np.floor(rows["v"] * SCALE)
        norms = np.linalg.norm(points, axis=1)
        if not norms.max() * self.norms.max() < EXACT / 100:
            self._meet_large(rows, same)
            return
        bounds, waiting = {}, self.children.copy()
        for at, parent, edge in zip(self.order, self.parent, self.edge):
            if at == self.order[0]:
                low = high = points @ self.points[at]
            else:
                reach = (edge * norms) * (1 + SLACK) + SLACK
                low, high = bounds[parent]
                low, high = low - reach, high + reach
                waiting[parent] -= 1
                if not waiting[parent]:
                    del bounds[parent]
            most = max((w[1] for w in self.windows[at]), default=-math.inf)
            wanted = self._allowed(at, rows, same)
            wanted &= (100 * high >= self._lowest(at)) & (100 * low <= most)
            hits = np.flatnonzero(wanted)
            if len(hits):
                self.scored += len(hits)
                scores = np.rint(
                    points[hits] @ self.points[at] if 2 * len(hits) < len(points)
                    else (points @ self.points[at])[hits])
                if at != self.order[0] and waiting[at]:
                    low, high = low.copy(), high.copy()
                    low[hits] = high[hits] = scores
                self._keep(at, scores, rows["vec_id"][hits], rows["row"][hits])
            if waiting[at]:
                bounds[at] = low, high

    def _allowed(self, at: int, rows: dict[str, np.ndarray], same: bool) -> np.ndarray:
        if same:
            return rows["row"] != self.rows["row"][at]
        return rows["label"] != self.rows["label"][at]

    def _meet_large(self, rows: dict[str, np.ndarray], same: bool) -> None:
        """Scores that doubles cannot hold: every row, in whole numbers of any size."""
        points = [[_whole(x) for x in v] for v in rows["v"].tolist()]
        for at, anchor in enumerate(self.rows["v"].tolist()):
            anchor = [_whole(x) for x in anchor]
            hits = np.flatnonzero(self._allowed(at, rows, same))
            if len(hits):
                scores = np.array(
                    [max(-LONG - 1, min(LONG, sum(map(int.__mul__, points[i], anchor))))
                     for i in hits], object)
                self._keep(at, scores, rows["vec_id"][hits], rows["row"][hits])

    def found(self) -> pa.RecordBatch:
        out = [(int(self.rows["row"][a]), turn, int(score), vec_id, row)
               for a, windows in enumerate(self.best) for turn, best in enumerate(windows)
               for score, vec_id, row in best]
        columns = list(zip(*out)) or [()] * len(_FOUND)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    n = batch.num_rows
    windows = batch["windows"].to_pylist() if batch["windows"].null_count < n else None
    return {
        "row": batch["row"].to_numpy(), "vec_id": batch["vec_id"].to_numpy(),
        "label": np.array(batch["label"].to_pylist(), object),
        "v": batch["v"].flatten().to_numpy().reshape(n, -1), "windows": windows}


def _search(same: bool, take: int):
    """mapInArrow function over rows sorted by cell, a cell's anchors first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, anchors, block = None, [], None
        for batch in batches:
            cell = batch["cell"].to_numpy()
            kind = batch["is_row"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(cell)]):
                if start == stop:
                    continue
                if cell[start] != now:
                    if block:
                        yield block.found()
                    now, anchors, block = cell[start], [], None
                if not kind[start]:
                    anchors.append(batch.slice(start, stop - start))
                elif anchors or block:
                    if not block:
                        held = pa.Table.from_batches(anchors).combine_chunks().to_batches()[0]
                        block, anchors = Block(_arrays(held), take), []
                    for at in range(start, stop, ROWS_AT_ONCE):
                        block.meet(_arrays(batch.slice(at, min(stop, at + ROWS_AT_ONCE) - at)), same)
        if block:
            yield block.found()
    return run


def _meet(rows: DataFrame, anchors: DataFrame, group: list[str], same: bool, take: int) -> DataFrame:
    """The best ``take`` rows in every window of every anchor: FOUND, ranked as ``rank``."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64(*group).alias("group")
    rows, anchors = rows.withColumn("group", key), anchors.withColumn("group", key)
    parts = F.ceil(F.col("anchors") / ANCHORS_IN_TASK)
    few, many = ROWS_IN_TASK
    sizes = materialize(
        rows.groupBy("group").agg(F.count("*").alias("rows"))
        .join(anchors.groupBy("group").agg(F.count("*").alias("anchors")), "group")
        .select("group", parts.cast("int").alias("h"), F.greatest(
            F.ceil(F.col("rows") / many),
            F.least(F.ceil(F.col("rows") / few), F.ceil(tasks / parts))).cast("int").alias("g")),
        "sizes")
    cells = sizes.agg(F.sum(F.col("g").cast("long") * F.col("h"))).first()[0] or 1
    columns = ["is_row", "row", "vec_id", "label", "v", "windows"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    placed = (
        lookup(rows.withColumn("windows", F.lit(None).cast("array<long>")), sizes, "group", "row",
               how="inner")
        .withColumns({"x": own("g"), "is_row": F.lit(True)}).withColumn("y", every("h"))
        .unionByName(
            lookup(anchors, sizes, "group", "row", how="inner")
            .withColumns({"y": own("h"), "is_row": F.lit(False)}).withColumn("x", every("g")))
        .withColumn("cell", F.pmod("group", F.lit(1 << 40)) + F.col("x").cast("long") * F.col("h")
                    + F.col("y"))
        .select("cell", "group", "x", "y", *columns))
    # Cells of a group follow one another, so that they are dealt evenly.
    several = max(1, min(int(cells), 8 * tasks))
    found = (
        placed.repartitionById(several, F.pmod(F.col("cell"), F.lit(several)).cast("int"))
        .sortWithinPartitions("cell", "group", "x", "y", "is_row")
        .select(F.xxhash64("group", "x", "y").alias("cell"), *columns)
        .mapInArrow(_search(same, take), FOUND))
    ranked = Window.partitionBy("anchor", "turn").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= take)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, label, embedding; ``is_anchor``: which rows are anchors.
    """
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = materialize(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("string").alias("label"),
            F.col("embedding").cast("array<double>").alias("v"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
        .where("vec_id is not null and label is not null and v is not null").where(finite)
        .withColumns({"row": F.monotonically_increasing_id(), "dims": F.size("v")}), "negatives")
    plain = ["row", "vec_id", "label", "dims", "v"]
    anchors = rows.where("is_anchor").select(*plain)
    rows = rows.select(*plain)
    no_window = F.lit(None).cast("array<long>")
    near = materialize(
        _meet(rows, anchors.withColumn("windows", no_window), ["dims", "label"], True, positives)
        .select("anchor", (F.col("rank") - 1).cast("int").alias("turn"),
                F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives")
    # At most ``positives`` rows for each anchor.
    windows = near.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("turn", "positive_score"))).alias("w")).select(
        F.col("anchor").alias("row"), F.col("w.positive_score").alias("windows"))
    far = _meet(rows, anchors.join(windows, "row"), ["dims"], False, negatives).select(
        "anchor", "turn", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return near.join(far, ["anchor", "turn"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
