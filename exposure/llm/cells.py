"""Range joins on a grid: rows written into cells meet the other rows of their cells.

Rows are shuffled by cell and sorted, and each task walks over the runs of equal cells in bounded
pieces. All runs of a piece are tested together: row i against row i + 1, i + 2, ... while both lie
in one cell. A cell with more than RUN_ROWS rows is not tested there: its rows are passed on and
dealt into blocks, every two blocks of a cell meet in a task of their own, and no test is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposure.llm.frames import lookup
from exposure.session import materialize

RUN_ROWS = 1024
FOUND_AT_ONCE = 500_000

#: (payload arrays, i, j) -> which of the pairs of rows i and j to keep.
Test = Callable[[list[np.ndarray], np.ndarray, np.ndarray], np.ndarray]
#: (a, b) -> fewer pairs that say the same.
Fold = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same components with one link for a node: each to its smallest known node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return pairs[0], pairs[1]


def _test_runs(cell, ids, payload, test: Test, fold: Fold) -> Iterator[tuple]:
    """Pairs within runs of equal ``cell``."""
    found_a, found_b, held = [], [], 0
    active, lag = np.arange(len(cell) - 1), 1
    while len(active):
        active = active[active + lag < len(cell)]
        active = active[cell[active] == cell[active + lag]]
        for lo in range(0, len(active), FOUND_AT_ONCE):
            i = active[lo:lo + FOUND_AT_ONCE]
            i = i[ids[i] != ids[i + lag]]
            i = i[test(payload, i, i + lag)]
            found_a.append(ids[i])
            found_b.append(ids[i + lag])
            held += len(i)
            if held > FOUND_AT_ONCE:
                a, b = fold(np.concatenate(found_a), np.concatenate(found_b))
                found_a, found_b, held = [a], [b], len(a)
                if held > FOUND_AT_ONCE // 2:
                    yield a, b
                    found_a, found_b, held = [], [], 0
        lag += 1
    if held:
        yield fold(np.concatenate(found_a), np.concatenate(found_b))


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch[n].to_numpy() for n in names]


def _walk(names: list[str], test: Test, fold: Fold, limit: int | None):
    """mapInArrow function over partitions sorted by cell: pairs (a, b), or rows of large cells."""
    fields = ["cell", "id", *names]

    def rows(kind: str, columns: list, schema: pa.Schema) -> pa.RecordBatch:
        n = len(columns[0])
        given = dict(zip(("a", "b") if kind == "pair" else fields, columns))
        return pa.RecordBatch.from_arrays(
            [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type)
             for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        schema, large = None, None

        def settle(part: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal large
            cell = part[0]
            if limit is not None and len(cell):
                starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
                sizes = np.diff(np.concatenate([starts, [len(cell)]]))
                over = (sizes > limit) | (cell[starts] == large)
                if over.any():
                    mask = np.repeat(over, sizes)
                    yield rows("row", [c[mask] for c in part], schema)
                    part = [c[~mask] for c in part]
            for a, b in _test_runs(part[0], part[1], part[2:], test, fold):
                yield rows("pair", [a, b], schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            if schema is None:
                schema = pa.schema([("a", pa.int64()), ("b", pa.int64()),
                                    *[(n, batch.schema.field(n).type) for n in fields]])
            part = _columns(batch, fields)
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part)]
            last = part[0][-1]
            cut = int(np.searchsorted(part[0], last))
            yield from settle([c[:cut] for c in part])
            held = [c[cut:].copy() for c in part]
            if limit is not None and (len(held[0]) > limit or last == large):
                yield rows("row", held, schema)
                large, held = last, [c[:0] for c in held]
        if held is not None:
            yield from settle(held)
    return run


def pairs_in_cells(
    placed: DataFrame, payload: list[str], test: Test, fold: Fold = distinct_pairs,
    limit: int = RUN_ROWS,
) -> DataFrame:
    """Pairs (a, b) of ids in a common cell that pass ``test``; a pair may come more than once.

    ``placed`` has cell (long), id (long) and the payload columns; the same id may be in many cells.
    """
    fields = ["cell", "id", *payload]
    types = dict(placed.dtypes)
    ddl = "a long, b long, " + ", ".join(f"{n} {types[n]}" for n in fields)
    first = materialize(
        placed.select(*fields).repartition("cell").sortWithinPartitions("cell")
        .mapInArrow(_walk(payload, test, fold, limit), ddl), "cells")
    pairs = first.where("a is not null").select("a", "b")
    large = first.where("cell is not null").select(*fields)
    if large.isEmpty():
        return pairs
    blocks = large.groupBy("cell").count().select(
        "cell", F.ceil(F.col("count") * 2 / limit).cast("int").alias("blocks"))
    # Block i of a cell meets block j in the task of the pair (i, j).
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (
        lookup(large, blocks, "cell", "id").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            "id", *payload))
    return pairs.union(
        dealt.repartition("cell").sortWithinPartitions("cell")
        .mapInArrow(_walk(payload, test, fold, None), ddl)
        .where("a is not null").select("a", "b"))
