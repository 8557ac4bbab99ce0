"""Document fingerprints that add up: a homomorphic hash of the multiset of paragraphs.

A text's paragraphs are its lines, blank ones too. Each paragraph is hashed into a wide vector and a
text's fingerprint is the sum of its paragraphs' vectors, so it does not depend on their order, and
inserting or deleting a paragraph adds or subtracts one vector. The vector has two parts:

* WORDS whole numbers modulo 2^64 from a cryptographic hash of the paragraph: equal exactly when the
  multisets of paragraphs are equal (but for a chance of 2^-256);
* SIGNS numbers modulo 2^16, the sums of +1 and -1 hashed from the paragraph's pieces (SHINGLE words
  each; a shorter paragraph is one piece). Products of such sums estimate how many pieces two texts
  share: likeness is twice the common pieces over the pieces of both, with a standard error of about
  0.09. Equal fingerprints have likeness 1. Above 32,767 repeats of one piece in a text the sums
  wrap: equality holds, the likeness to a text with about as many repeats as well, others may be off.

Null texts count as empty, and an empty text is one blank paragraph without pieces: its likeness is 1
to equal fingerprints and 0 to others. Rows without a doc_id are left out. A repeated doc_id is
another document each time; documents of one doc_id follow one another by a hash of their texts, then
as they were read. A single document is its own next one. Long texts are hashed whole. Other columns
are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exposure.llm.frames import documents, text_slices, way
from exposure.session import materialize

WORDS = 4
SIGNS = 128
SHINGLE = 3
PIECES_AT_ONCE = 100_000

_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)]
_STEPS = [np.uint64(k * int(_MIX[2]) % 2 ** 64) for k in range(1, SIGNS // 64 + 1)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all their bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _pieces(paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pieces, and how many each paragraph has."""
    words = [p.split() for p in paragraphs]
    sizes = np.array([len(w) for w in words], np.int64)
    known: dict[str, int] = {}
    for w in words:
        for word in w:
            if word not in known:
                known[word] = int.from_bytes(
                    hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
    flat = np.fromiter((known[word] for w in words for word in w), np.uint64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    # The paragraph's rest from each word on says how many words a piece there may have.
    left = np.repeat(ends, sizes) - np.arange(len(flat))
    piece, order = np.zeros(len(flat), np.uint64), np.arange(len(flat))
    for step in range(SHINGLE):
        inside = left > step
        follower = flat[np.minimum(order + step, max(len(flat) - 1, 0))]
        piece = np.where(inside, _mixed(piece * _MIX[2] + follower + np.uint64(step + 1)), piece)
    counts = np.where(sizes > 0, np.maximum(sizes - SHINGLE + 1, 1), 0)
    turn = order - np.repeat(ends - sizes, sizes)
    return piece[turn < np.repeat(counts, sizes)], counts


def _signs(piece: np.ndarray) -> np.ndarray:
    """+1 and -1 as SIGNS columns."""
    bits = np.stack([_mixed(piece + step) for step in _STEPS], 1)
    return np.unpackbits(bits.view(np.uint8), axis=1).view(np.int8) * np.int8(2) - np.int8(1)


def paragraph_vectors(paragraphs: list[str]) -> np.ndarray:
    """One row of WORDS + SIGNS numbers for each paragraph; sums of rows are taken by ``total``."""
    out = np.zeros((len(paragraphs), WORDS + SIGNS), np.uint64)
    digests = b"".join(
        hashlib.blake2b(p.encode(), digest_size=8 * WORDS).digest() for p in paragraphs)
    out[:, :WORDS] = np.frombuffer(digests, "<u8").reshape(-1, WORDS)
    piece, counts = _pieces(paragraphs)
    ends = np.cumsum(counts)
    at = 0
    while at < len(paragraphs):
        # Whole paragraphs up to PIECES_AT_ONCE; a longer one alone, in parts.
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + PIECES_AT_ONCE, "right")))
        if stop == at + 1:
            for lo in range(done, ends[at], PIECES_AT_ONCE):
                part = _signs(piece[lo:min(lo + PIECES_AT_ONCE, ends[at])]).sum(0, dtype=np.int64)
                out[at, WORDS:] += part.view(np.uint64)
        else:
            full = at + np.flatnonzero(counts[at:stop])
            if len(full):
                sums = np.add.reduceat(
                    _signs(piece[done:ends[stop - 1]]), ends[full] - counts[full] - done, 0, np.int64)
                out[full, WORDS:] = sums.view(np.uint64)
        at = stop
    return out


def total(vectors: np.ndarray) -> np.ndarray:
    """The sum of rows, each number modulo its power of two."""
    out = vectors.sum(0, dtype=np.uint64)
    out[WORDS:] &= np.uint64(0xFFFF)
    return out


def to_bytes(vector: np.ndarray) -> bytes:
    return vector[:WORDS].astype(">u8").tobytes() + vector[WORDS:].astype(">u2").tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    out = np.zeros(WORDS + SIGNS, np.uint64)
    out[:WORDS] = np.frombuffer(raw, ">u8", WORDS)
    out[WORDS:] = np.frombuffer(raw, ">u2", SIGNS, 8 * WORDS)
    return out


def fingerprint(text: str) -> np.ndarray:
    return total(paragraph_vectors(text.split("\n")))


def with_paragraphs(vector: np.ndarray, paragraphs: list[str]) -> np.ndarray:
    """The fingerprint after inserting ``paragraphs``."""
    return total(np.vstack([vector, paragraph_vectors(paragraphs)]))


def without_paragraphs(vector: np.ndarray, paragraphs: list[str]) -> np.ndarray:
    """The fingerprint after deleting ``paragraphs``."""
    return total(np.vstack([vector, -paragraph_vectors(paragraphs)]))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1; 1 for equal fingerprints."""
    if (a == b).all():
        return 1.0
    x, y = (v[WORDS:].astype(np.uint16).view(np.int16).astype(float) for v in (a, b))
    both = x @ x + y @ y
    return min(1.0, max(0.0, 2 * (x @ y) / both)) if both else 0.0


# --- tables ------------------------------------------------------------------------------------

def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            found = [to_bytes(v) for _, v in _hashed(part["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(found, pa.binary())], ["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as bytes)."""
    return documents(docs).mapInArrow(_hash_texts, "doc_id long, fingerprint binary")


def _sum_by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document and batch: the sum of its fingerprints."""
    for batch in batches:
        sums: dict[tuple, np.ndarray] = {}
        for doc_id, at, raw in zip(*(batch[c].to_pylist() for c in ("doc_id", "_way", "fingerprint"))):
            key, vector = (doc_id, at), from_bytes(raw)
            sums[key] = total(np.stack([sums[key], vector])) if key in sums else vector
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in sums], pa.int64()), pa.array([k[1] for k in sums], pa.int32()),
             pa.array([to_bytes(v) for v in sums.values()], pa.binary())],
            ["doc_id", "_way", "fingerprint"])


def _edit_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = paragraph_vectors(batch["paragraph"].to_pylist())
        gone = batch["deleted"].to_numpy(zero_copy_only=False).astype(bool)
        vectors[gone] = -vectors[gone]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["_way"], pa.array([to_bytes(v) for v in vectors], pa.binary())],
            ["doc_id", "_way", "fingerprint"])


def apply_edits(current: DataFrame, edits: DataFrame) -> DataFrame:
    """Fingerprints (doc_id, fingerprint) after edits (doc_id, paragraph, deleted), texts unseen.

    Edits of a document are summed in every task, then over 64 ways, then in one place, so that a
    document may have a third of all edits. A null paragraph counts as blank, a null ``deleted`` as
    an insertion, and edits of unknown documents start from nothing.
    """
    ddl = "doc_id long, _way int, fingerprint binary"
    rows = edits.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), way("paragraph").alias("_way"),
        F.coalesce("paragraph", F.lit("")).alias("paragraph"),
        F.coalesce("deleted", F.lit(False)).alias("deleted"))
    rows = rows.mapInArrow(_edit_vectors, ddl).mapInArrow(_sum_by_document, ddl).unionByName(
        current.select("doc_id", F.lit(0).alias("_way"), "fingerprint"))
    for keys in (["doc_id", "_way"], ["doc_id"]):
        rows = rows.groupBy(*keys).agg(F.collect_list("fingerprint").alias("all")).select(
            "doc_id", *([F.col("_way")] if "_way" in keys else [F.lit(0).alias("_way")]),
            F.explode("all").alias("fingerprint")).mapInArrow(_sum_by_document, ddl)
    return rows.select("doc_id", "fingerprint")


# --- a document, its edited text and the next document -------------------------------------------

_ROW = pa.schema([
    ("task", pa.int32()), ("kind", pa.string()), ("doc_id", pa.int64()), ("text", pa.string()),
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_DDL = ("task int, kind string, doc_id long, text string, n_chars long, edited_sha256 string, "
        "fingerprint binary, edited_fingerprint binary, near_edited double, near_next double")


class _Text:
    """A text with the sums of its first paragraphs."""

    def __init__(self, doc_id: int, text: str, vectors: np.ndarray) -> None:
        self.doc_id, self.text = doc_id, text
        self.vector = total(vectors)
        sizes = np.array([len(p) + 1 for p in text.split("\n")])
        #: where each paragraph starts, and behind the last one
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.sums = np.zeros((len(vectors) + 1, WORDS + SIGNS), np.uint64)
        np.cumsum(vectors, axis=0, dtype=np.uint64, out=self.sums[1:])


def _hashed(texts: list[str]) -> Iterable[tuple[str, np.ndarray]]:
    """Every text with its fingerprint."""
    paragraphs = [t.split("\n") for t in texts]
    vectors = paragraph_vectors([p for ps in paragraphs for p in ps])
    at = 0
    for text, ps in zip(texts, paragraphs):
        yield text, total(vectors[at:at + len(ps)])
        at += len(ps)


def _texts(ids: list[int], texts: list[str]) -> list[_Text]:
    paragraphs = [t.split("\n") for t in texts]
    vectors = paragraph_vectors([p for ps in paragraphs for p in ps])
    ends = np.cumsum([len(p) for p in paragraphs])
    return [_Text(i, t, vectors[end - len(p):end])
            for i, t, p, end in zip(ids, texts, paragraphs, ends)]


def _edited(docs: list[_Text], nexts: list[_Text]) -> list[tuple]:
    """The result rows of documents and the ones that follow them.

    The edited text keeps a document's beginning and takes the next one's beginning for the rest.
    Whole paragraphs keep their vectors: only those at the seam and at the end are hashed anew.
    """
    sums, new, owner, edited = [], [], [], []
    for a, b in zip(docs, nexts):
        put = len(a.text) // 2
        kept = len(a.text) - put
        text = a.text[:kept] + b.text[:put]
        edited.append(text)
        taken = min(put, len(b.text))
        # whole paragraphs of a before the cut, and of b behind the seam and before the end
        whole = int(np.searchsorted(a.starts, kept, "right")) - 1
        last = int(np.searchsorted(b.starts, taken, "right")) - 1
        if last:
            sums.append(a.sums[whole] + b.sums[last] - b.sums[1])
            news = [a.text[a.starts[whole]:kept] + b.text[:b.starts[1] - 1],
                    b.text[b.starts[last]:taken]]
        else:
            sums.append(a.sums[whole])
            news = [a.text[a.starts[whole]:kept] + b.text[:taken]]
        new += news
        owner += [len(sums) - 1] * len(news)
    sums = np.array(sums)
    np.add.at(sums, owner, paragraph_vectors(new))
    sums[:, WORDS:] &= np.uint64(0xFFFF)
    return [(a.doc_id, None, len(a.text), hashlib.sha256(text.encode()).hexdigest(),
             to_bytes(a.vector), to_bytes(v), likeness(a.vector, v), likeness(a.vector, b.vector))
            for a, b, text, v in zip(docs, nexts, edited, sums)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ROW)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _ROW)], schema=_ROW)


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all documents of a sorted partition but the last; its first and last text as well."""
    task, before = TaskContext.get().partitionId(), None

    def text_row(kind: str, doc: _Text) -> tuple:
        return (task, kind, doc.doc_id, doc.text, *[None] * 6)

    for batch in batches:
        for part in text_slices(batch):
            docs = _texts(part["doc_id"].to_pylist(), part["text"].to_pylist())
            if before is None:
                yield _batch([text_row("first", docs[0])])
            else:
                docs.insert(0, before)
            yield _batch([(task, "row", *row) for row in _edited(docs[:-1], docs[1:])]
                         if len(docs) > 1 else [])
            before = docs[-1]
    if before is not None:
        yield _batch([text_row("last", before)])


def _border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            docs = _texts([row["doc_id"], -1], [row["text"], row["next_text"]])
            yield _batch([(row["task"], "row", *r) for r in _edited(docs[:1], docs[1:])])


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document, its edited text and its next one (by descending doc_id, then the first).

    One sort by doc_id brings each document beside the next. Where a partition ends, the next
    document is the first one of a later partition: two texts for each partition, joined.
    """
    order = [F.desc("doc_id"), F.col("_by"), F.col("_read")]
    texts = documents(docs).withColumns(
        {"_by": F.xxhash64("text"), "_read": F.monotonically_increasing_id()})
    found = materialize(
        texts.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
        .mapInArrow(_follow, _DDL), "fingerprints")
    firsts = found.where("kind = 'first'").select("task")
    # One number for each partition goes through this window; the texts are joined to them.
    every = Window.orderBy("task")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    behind = firsts.select("task", F.coalesce(
        F.lead("task").over(every), F.first("task").over(whole)).alias("next_task"))
    texts_of = found.where("kind <> 'row'").select("task", "kind", "doc_id", "text")
    border = (
        texts_of.where("kind = 'last'").drop("kind").join(behind, "task")
        .join(texts_of.where("kind = 'first'").select(
            F.col("task").alias("next_task"), F.col("text").alias("next_text")), "next_task")
        .select("task", "doc_id", "text", "next_text").mapInArrow(_border, _DDL))
    low_hex = lambda c: F.lower(F.hex(c)).alias(c)
    return found.where("kind = 'row'").unionByName(border).select(
        "doc_id", "n_chars", "edited_sha256", low_hex("fingerprint"), low_hex("edited_fingerprint"),
        "near_edited", "near_next")
