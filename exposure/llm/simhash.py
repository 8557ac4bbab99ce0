"""Near-duplicates by SimHash, joined through counts of bits.

A fingerprint is cut into segments of two bits, and each segment is mapped to its number of set
bits. One differing bit changes one count by one, so the Manhattan distance of two count vectors
never exceeds the number of differing bits. Of two fingerprints with at most four differing bits,
one half differs in at most two: both write that half's vector and every vector at Manhattan
distance one into a unit grid, and so meet in a cell. In a cell the distance over both halves is
tested as the lower bound and then the bits themselves.

Equal fingerprints are one node, named by the fingerprint; cells give trees of links instead of all
pairs, so a large group of near copies makes about as many rows as it has fingerprints.

Null and empty texts and texts of white space only have fingerprint zero and are linked like any
other; long texts are read whole. Rows without a doc_id are left out. A repeated doc_id is a row each
time, and its texts are grouped each by itself. An empty table gives an empty result. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposure.llm.cells import forest, pairs_in_cells
from exposure.llm.components import connected_components
from exposure.llm.frames import documents, keep_marked, lookup, text_slices
from exposure.session import materialize

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42

_LOW = np.uint64(0x5555555555555555)
_HALF_SEGMENTS = 16
_POWERS = 3 ** np.arange(_HALF_SEGMENTS, dtype=np.int64)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """Bit by bit, whether more than half the shingles' hashes have it set."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and space, \t, \n, \v, \f, \r.
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist())),
        np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = hashes[at:at + 4096]
        counts += np.unpackbits(
            part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, words: int = SHINGLE_WORDS, digests: bool = False,
) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long; with ``digests`` the text's SHA-256 too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                texts = part["text"].to_pylist()
                made = np.array([fingerprint(t, words) for t in texts], np.uint64)
                columns = {"doc_id": part["doc_id"], "fp": pa.array(made.view(np.int64))}
                if digests:
                    columns["digest"] = pa.array(
                        [hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
                yield pa.RecordBatch.from_pydict(columns)
    return documents(docs).mapInArrow(
        run, "doc_id long, fp long" + ", digest string" * digests)


def segment_counts(bits: np.ndarray) -> np.ndarray:
    """Set bits of each two-bit segment, packed in the segment's place."""
    bits = bits.view(np.uint64)
    return (bits & _LOW) + ((bits >> np.uint64(1)) & _LOW)


def _vectors(bits: np.ndarray) -> np.ndarray:
    packed = segment_counts(bits)
    shifts = 2 * np.arange(2 * _HALF_SEGMENTS, dtype=np.uint64)
    return ((packed[:, None] >> shifts) & np.uint64(3)).astype(np.int64)


def cells_of(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell): the grid cells at Manhattan distance 0 or 1 of each half's count vector."""
    counts = _vectors(bits)
    rows, cells = [], []
    every = np.arange(len(bits))
    for half in range(2):
        own = counts[:, half * _HALF_SEGMENTS:(half + 1) * _HALF_SEGMENTS]
        code = own @ _POWERS + half * 3 ** _HALF_SEGMENTS
        rows.append(every)
        cells.append(code)
        for segment in range(_HALF_SEGMENTS):
            for step, moved in ((1, own[:, segment] < 2), (-1, own[:, segment] > 0)):
                rows.append(every[moved])
                cells.append(code[moved] + step * _POWERS[segment])
    return np.concatenate(rows), np.concatenate(cells)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            ids, bits = part["id"].to_numpy(), part["fp"].to_numpy()
            row, cell = cells_of(bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), pa.array(ids[row]), pa.array(bits[row])], ["cell", "id", "fp"])


def within_bits(most: int = MAX_BITS):
    low = np.uint64(0x3333333333333333)

    def test(payload: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        bits = payload[0].view(np.uint64)
        a, b = bits[i], bits[j]
        # Lower bound: counts of 0..2 in two-bit places, as sums of absolute differences.
        x, y = segment_counts(a), segment_counts(b)
        apart = np.zeros(len(a), np.int64)
        for shift in (np.uint64(0), np.uint64(2)):
            p, q = (x >> shift) & low, (y >> shift) & low
            apart += np.abs(p.view(np.uint8).astype(np.int8).reshape(-1, 8) // 16
                            - q.view(np.uint8).astype(np.int8).reshape(-1, 8) // 16).sum(1)
            apart += np.abs(p.view(np.uint8).astype(np.int8).reshape(-1, 8) % 16
                            - q.view(np.uint8).astype(np.int8).reshape(-1, 8) % 16).sum(1)
        near = apart <= most
        near[near] = np.bitwise_count(a[near] ^ b[near]) <= most
        return near
    return test


def _grouped(marked: DataFrame) -> DataFrame:
    """``marked`` (doc_id, fp and more) with the root of its component and the smallest doc_id there.

    Fingerprints are the nodes, so a doc_id that stands for two texts does not join their groups.
    """
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    placed = nodes.select(F.col("fp").alias("id"), "fp").mapInArrow(
        _place, "cell long, id long, fp long")
    links = pairs_in_cells(placed, ["fp"], within_bits(), fold=forest)
    roots = connected_components(links).withColumnRenamed("node", "fp")
    named = materialize(nodes.join(roots, "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return lookup(
        marked, lookup(named.drop("first_id"), least, "root", "fp"), "fp", "doc_id")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row with a doc_id."""
    return _grouped(materialize(fingerprints(docs, words), "fingerprints")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each group, that of the smallest doc_id, with all its columns."""
    marked = materialize(fingerprints(docs, words, digests=True), "fingerprints")
    kept = _grouped(marked).where("doc_id = component_id").groupBy("root").agg(
        F.min("digest").alias("digest"), F.first("doc_id").alias("doc_id"))
    whole = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    return keep_marked(docs, kept, "digest", whole)
