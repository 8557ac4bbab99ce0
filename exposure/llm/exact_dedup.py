"""Exact deduplication by a content sort.

Texts are equal when they are the same after deleting space, tab, line feed, vertical tab, form
feed and carriage return. Sampled splitters range-partition the normalised texts, an external
sort puts equal ones next to each other, and every text is compared in full with its neighbour.
A splitter holds the first characters, then the digest, length and doc_id: it stays short however
long the texts are, and copies of one text may fill several partitions. Runs that touch the first
or last row of a partition are joined in a second step on at most two rows for each partition.

Null texts count as empty; empty texts are equal to each other. Rows without a doc_id are left
out. A repeated doc_id counts as a row each time; only one row of a group is kept. An empty table
gives an empty result. Other columns of the input are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exposure.llm.frames import documents, keep_marked
from exposure.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
SPLITTER_CHARS = 32

RUNS = (
    "doc_id long, head_id long, head_chars long, run_size long, first boolean, "
    "text_sha256 string, edge long, edge_text string"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("head_id", pa.int64()), ("head_chars", pa.int64()),
    ("run_size", pa.int64()), ("first", pa.bool_()), ("text_sha256", pa.string()),
    ("edge", pa.int64()), ("edge_text", pa.string()),
])


def _rows(ids, heads, chars, sizes, first, digests, edge, text) -> pa.RecordBatch:
    n = len(ids)
    edges = pa.nulls(n, pa.int64()) if edge is None else pa.array(np.full(n, edge))
    texts = pa.nulls(n, pa.string()) if edge is None else pa.array([text] + [None] * (n - 1), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(heads), pa.array(chars), pa.array(sizes), pa.array(first),
         digests, edges, texts], schema=_ARROW)


class _Run:
    """A run of equal texts that may go on in the next batch: ids only, and one text."""

    def __init__(self, batch: pa.RecordBatch, start: int, at_start: bool) -> None:
        row = batch.slice(start, 1).to_pylist()[0]
        self.text, self.chars, self.head, self.digest = row["norm"], row["chars"], row["doc_id"], row["digest"]
        self.ids, self.at_start = [], at_start

    def rows(self, edge: int | None) -> pa.RecordBatch:
        ids = np.concatenate(self.ids)
        n = len(ids)
        return _rows(ids, np.full(n, self.head), np.full(n, self.chars), np.full(n, n),
                     np.arange(n) == 0, pa.array([self.digest] * n, pa.string()), edge, self.text)


def neighbour_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition."""
    base, run = 2 * TaskContext.get().partitionId(), None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        texts, ids = batch["norm"], batch["doc_id"].to_numpy()
        new = np.ones(n, bool)
        new[1:] = pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
        new[0] = run is None or run.text != texts[0].as_py()
        starts = np.flatnonzero(new)
        until = starts[0] if len(starts) else n
        if until:
            run.ids.append(ids[:until])
        if not len(starts):
            continue
        if run is not None:
            yield run.rows(base if run.at_start else None)
        last = starts[-1]
        at_start = run is None
        if at_start and len(starts) > 1:
            opening = _Run(batch, 0, True)
            opening.ids.append(ids[:starts[1]])
            yield opening.rows(base)
            starts, at_start = starts[1:], False
        if last > starts[0]:
            lo = starts[0]
            inner = starts[:-1] - lo
            sizes = np.diff(starts)
            first = np.zeros(last - lo, bool)
            first[inner] = True
            yield _rows(
                ids[lo:last], np.repeat(ids[starts[:-1]], sizes),
                np.repeat(batch["chars"].to_numpy()[starts[:-1]], sizes), np.repeat(sizes, sizes),
                first, batch["digest"].slice(lo, last - lo), None, None)
        run = _Run(batch, int(last), at_start)
        run.ids.append(ids[last:])
    if run is not None:
        yield run.rows(base if run.at_start else base + 1)


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row with a doc_id.

    Of equal texts the row with the most code points before normalising stays, then the smallest
    doc_id.
    """
    norm = F.translate("text", BLANKS, "")
    keyed = documents(docs).select(
        "doc_id", F.char_length("text").cast("long").alias("chars"), norm.alias("norm"),
    ).withColumn("digest", F.sha2(F.col("norm").cast("binary"), 256))
    order = [F.substring("norm", 1, SPLITTER_CHARS), F.col("digest")]
    rest = [F.col("chars").desc(), F.col("doc_id")]
    runs = materialize(
        keyed.repartitionByRange(*order, *rest)
        .sortWithinPartitions(*order, F.col("norm"), *rest)
        .mapInArrow(neighbour_runs, RUNS),
        "exact-runs")

    # At most two rows for each partition of the sort, so this side has a proven bound.
    same = Window.partitionBy("text_sha256", "edge_text")
    best = F.min(F.struct((-F.col("head_chars")).alias("c"), "head_id", "edge")).over(same)
    edges = runs.where("edge_text is not null").select(
        "edge", best.alias("best"), F.sum("run_size").over(same).alias("total"),
    ).select("edge", F.col("best.head_id").alias("best_id"), "total",
             (F.col("edge") == F.col("best.edge")).alias("leads"))
    return runs.join(F.broadcast(edges), "edge", "left").select(
        "doc_id",
        F.coalesce("best_id", "head_id").alias("keep_id"),
        F.coalesce("total", "run_size").alias("group_size"),
        (F.col("first") & F.coalesce("leads", F.lit(True))).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` with all their columns: one for each different text."""
    digest = F.sha2(F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), BLANKS, "")
                    .cast("binary"), 256)
    return keep_marked(docs, exact_groups(docs).where("kept"), "text_sha256", digest)
