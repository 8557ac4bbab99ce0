"""Near-duplicate vectors by a pigeonhole over subspaces.

Unit vectors with cosine c are at squared distance 2 (1 - c). They are turned by a fixed random
rotation, so that no coordinate stands out, and split into blocks of about BLOCK_DIMS coordinates.
Of two vectors within the whole distance, at least one block is within its share of it, in
proportion to its coordinates. In each block a range join finds all such pairs: cells of a grid over
the first GRID_DIMS coordinates, then the block's distance. The union of the blocks' candidates is
verified with the cosine of the vectors as given, in double precision.

Only vectors of one label and one length are compared. Equal vectors of a label are one node with a
count, so copies make no pairs. Vectors that are null, zero, or hold a null or non-finite
component, and vectors without a label, link with nothing and stand for themselves. Rows without a
vec_id are left out; a repeated vec_id is another vector each time, and equal vectors of one label
are equal whatever their ids. Other columns are not read, whatever their names. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposure.llm.cells import distinct_pairs, pairs_in_cells
from exposure.llm.components import connected_components
from exposure.llm.frames import lookup
from exposure.session import materialize

MIN_COSINE = 0.98
BLOCK_DIMS = 8
GRID_DIMS = 4
CELL_WIDTHS = 1.5
SEED = 20240607
ROUNDING = 1e-6

COORDS = [f"c{i}" for i in range(BLOCK_DIMS)]


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int) -> list[np.ndarray]:
    return np.array_split(np.arange(dims), -(-dims // BLOCK_DIMS))


def _stacks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of vector in a list column."""
    lengths = pc.list_value_length(column).to_numpy()
    ends = np.cumsum(lengths)
    flat = column.flatten().to_numpy().astype(np.float64)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, flat[(ends[rows] - n)[:, None] + np.arange(n)]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """By powers of two, so that squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(vectors).max(1))
    return np.ldexp(vectors, -exponent[:, None])


def share(block: np.ndarray, dims: int, min_cosine: float) -> float:
    """The block's part of the squared distance, with room for rounding."""
    return 2 * (1 - min_cosine) * len(block) / dims * (1 + ROUNDING) + ROUNDING


def _place(min_cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, groups = part["id"].to_numpy(), part["label_hash"].to_numpy()
                for rows, vectors in _stacks(part["v"]):
                    dims = vectors.shape[1]
                    vectors = _scaled(vectors)
                    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
                    turned = vectors @ rotation(dims)
                    for b, block in enumerate(blocks_of(dims)):
                        yield from _cells(
                            turned[:, block], share(block, dims, min_cosine), ids[rows],
                            groups[rows], dims * 65_537 + b)
    return run


def _cells(points, budget, ids, groups, salt) -> Iterator[pa.RecordBatch]:
    """Each point in every cell that its box of half the radius touches: two points within the
    radius have boxes that overlap, and the cell of a common place holds both."""
    radius = np.sqrt(budget)
    grid = points[:, :GRID_DIMS]
    low = np.floor((grid - radius / 2) / (CELL_WIDTHS * radius)).astype(np.int64)
    high = np.floor((grid + radius / 2) / (CELL_WIDTHS * radius)).astype(np.int64)
    coords = np.zeros((len(points), BLOCK_DIMS), np.float32)
    coords[:, :points.shape[1]] = points
    base = groups.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)
    for steps in product((0, 1), repeat=grid.shape[1]):
        at = low + np.array(steps)
        inside = (at <= high).all(1)
        cell = base[inside]
        for axis in range(grid.shape[1]):
            cell = (cell ^ at[inside, axis].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
            cell ^= cell >> np.uint64(32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell.view(np.int64)), pa.array(ids[inside]),
             pa.array(groups[inside]), pa.array(np.full(len(cell), budget)),
             *(pa.array(np.ascontiguousarray(coords[inside, i])) for i in range(BLOCK_DIMS))],
            ["cell", "id", "label_hash", "budget", *COORDS])


def _in_range(payload: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    label, budget, coords = payload[0], payload[1], payload[2:]
    near = label[i] == label[j]
    at = np.flatnonzero(near)
    apart = np.zeros(len(at))
    # Rows of a cell are close in the first coordinates, so the others come first.
    for axis in range(BLOCK_DIMS - 1, -1, -1):
        c = coords[axis]
        step = c[i[at]].astype(np.float64) - c[j[at]]
        apart += step * step
        keep = apart <= budget[i[at]]
        at, apart = at[keep], apart[keep]
    near[:] = False
    near[at] = True
    return near


def _verify(min_cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keep = np.zeros(part.num_rows, bool)
                for (rows, x), (_, y) in zip(_stacks(part["va"]), _stacks(part["vb"])):
                    x, y = _scaled(x), _scaled(y)
                    norms = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
                    keep[rows] = np.einsum("ij,ij->i", x, y) / norms >= min_cosine
                yield pa.RecordBatch.from_arrays(
                    [part["a"].filter(pa.array(keep)), part["b"].filter(pa.array(keep))], ["a", "b"])
    return run


def near_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row with a vec_id."""
    given = vectors.where("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
              & F.exists("v", lambda x: x != 0))
    # The class of equal vectors: label and components in full, each in its own field.
    key = F.sha2(F.to_json(F.struct("label", "v")).cast("binary"), 256)
    rows = materialize(given.select(
        "vec_id", "label", "v", F.when(F.coalesce(usable, F.lit(False)), key).alias("key")), "vectors")
    # Nodes have numbers of their own: one vec_id may stand for different vectors.
    nodes = materialize(
        rows.where("key is not null").groupBy("key").agg(
            F.min("vec_id").alias("first_id"), F.count("*").alias("copies"),
            F.first("v").alias("v"), F.first("label").alias("label"))
        .withColumns({"id": F.monotonically_increasing_id(), "label_hash": F.xxhash64("label")}),
        "vector-nodes")

    placed = nodes.select("id", "label_hash", "v").mapInArrow(
        _place(min_cosine),
        "cell long, id long, label_hash long, budget double, "
        + ", ".join(f"{c} float" for c in COORDS))
    candidates = pairs_in_cells(
        placed, ["label_hash", "budget", *COORDS], _in_range, fold=distinct_pairs)
    ends = nodes.select("id", "v", "label")
    links = materialize(
        candidates.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        .join(ends.toDF("a", "va", "la"), "a").join(ends.toDF("b", "vb", "lb"), "b")
        .where("la = lb and size(va) = size(vb)")
        .select("a", "b", "va", "vb").mapInArrow(_verify(min_cosine), "a long, b long"), "vector-links")

    copies = nodes.select("id", "copies")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (
        lookup(both, copies.withColumnRenamed("id", "b"), "b", "a", how="inner")
        .groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "id"))
    roots = connected_components(links).withColumnRenamed("node", "id")
    named = materialize(nodes.join(linked, "id", "left").join(roots, "id", "left").select(
        "key", "first_id", F.coalesce("root", "id").alias("root"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links")), "vector-classes")
    least = named.groupBy("root").agg(F.min("first_id").alias("component"))
    named = lookup(named, least, "root", "key").select("key", "component", "links")
    found = lookup(rows.select("vec_id", "key"), named, "key", "vec_id")
    component = F.coalesce("component", "vec_id")
    return found.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
