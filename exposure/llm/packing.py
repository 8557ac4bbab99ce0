"""Packing token sequences by reciprocal classes.

A document is cut into whole sequences and a rest, and the rest into pieces of exactly 1/2, 1/3,
1/4, ... of the capacity (rounded down), largest first; what is below SMALLEST_CUT stays in one
piece. All pieces of a class have one size, so a class's sequences take a fixed number of pieces,
and every worker fills its own, class by class, without hearing of the others. Sequences that a
worker can't fill go on, as pieces, to fewer workers, MERGE of them at a time; the last worker puts
what no class could fill one after the other, cutting at the capacity. Only one sequence is short.

Ids are those of a public tokenizer, then the end id. Null texts count as empty (the end id alone);
rows without a doc_id are left out; a repeated doc_id is packed each time, and a text of any length is
cut into as many sequences as it fills. An empty table gives an empty result. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposure.llm.frames import documents, text_slices
from exposure.session import materialize

CAPACITY = 2048
END_ID = 1
SMALLEST_CUT = 32
MERGE = 64
KNOWN_PIECES = 800_000
LONGEST_KNOWN = 64
TOGETHER = 20
TEXT_CHARS = 1_000_000

PACKED = (
    "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids", pa.list_(pa.int32())), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


class WordTokenizer:
    """The tokenizer's ids, asked for once for each of the strings between white space.

    Its normaliser makes white space one blank and its words never hold any, so a text's ids are
    those of its parts in order. It lower-cases, so texts may be lower-cased before (A-Z only, not
    with a special token, and not with accents that are characters of their own: some join with
    small letters only). Marks behind a letter at the end of a part are a word of their own. All
    that makes more parts alike. A part of small Latin letters is one word that no step changes, so
    it goes straight to the library's model. ``known`` has the ids as four bytes each.
    """

    PLAIN = re.compile("[a-zß-öø-ÿ]+")
    MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    ACCENTS = (b"\xcc", b"\xcd")  # how U+0300 to U+036F start

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.in_bytes = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(0xDF, 0x100)}
        self.model = self.tokenizer.model
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.known: dict[bytes, bytes] = {}
        special = self.tokenizer.get_added_tokens_decoder()
        self.mark_id = min(special, default=None)
        self.mark = special[self.mark_id].content if special else None
        self.specials = {t.content[:2].encode() for t in special.values()}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.int32) for e in found]

    def _ask_model(self, pieces: list[bytes]) -> list[bytes]:
        """Ask the model itself for the plain pieces; the others."""
        others = []
        for piece in pieces:
            text = piece.decode()
            if self.PLAIN.fullmatch(text):
                if not piece.isascii():
                    text = text.translate(self.in_bytes)
                self.known[piece] = array("i", [t.id for t in self.model.tokenize(text)]).tobytes()
            else:
                others.append(piece)
        return others

    def _ask(self, pieces: list[bytes]) -> None:
        """Ask for many pieces in one text, with a special token between them.

        The tokenizer takes special tokens out of a text before anything else, so each piece is
        encoded on its own, and one call for each piece would cost far more than the piece.
        """
        groups = [pieces[i:i + TOGETHER] for i in range(0, len(pieces), TOGETHER)]
        between = f" {self.mark} ".encode()
        for group, ids in zip(groups, self._encode([between.join(g).decode() for g in groups])):
            stops = [*(4 * np.flatnonzero(ids == self.mark_id)).tolist(), 4 * len(ids)]
            held, start = ids.tobytes(), 0
            for piece, stop in zip(group, stops, strict=True):
                self.known[piece] = held[start:stop]
                start = stop + 4

    def _learn(self, pieces: list[bytes], special: bool) -> None:
        """``special``: a piece may hold a special token, or there is none to put between them."""
        if special:
            alone = [p for p in pieces if self.mark is None or any(t in p for t in self.specials)]
            self.known.update(zip(alone, (
                ids.tobytes() for ids in self._encode([p.decode() for p in alone]))))
            pieces = [p for p in pieces if p not in self.known]
        cut = [(p, len(stem)) for p in pieces
               if len(stem := p.rstrip(self.MARKS)) < len(p) and stem[-1:].isalpha()]
        wanted = set(pieces).difference(p for p, _ in cut)
        wanted.update(p[:n] for p, n in cut)
        wanted.update(p[n:] for p, n in cut)
        self._ask(self._ask_model(list(wanted.difference(self.known))))
        for piece, n in cut:
            self.known[piece] = self.known[piece[:n]] + self.known[piece[n:]]

    def encode(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text. Each different part is looked up once for all texts."""
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        raw = column.cast(pa.binary())
        held = [pc.match_substring(raw, t) for t in self.specials]
        special = self.mark is None or any(pc.any(m).as_py() for m in held)
        as_given = reduce(pc.or_, [*held, *(pc.match_substring(raw, t) for t in self.ACCENTS)])
        # Both know ASCII only: A-Z, and space, \t, \n, \v, \f, \r.
        words = pc.ascii_split_whitespace(pc.if_else(as_given, column, pc.ascii_lower(column)))
        coded = words.flatten().dictionary_encode()
        parts = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, parts))
        new = [p for p, f in zip(parts, found) if f is None]
        if new:
            self._learn(new, special)
            found = list(map(self.known.__getitem__, parts))
        ids = np.frombuffer(b"".join(found), np.int32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = coded.indices.to_numpy()
        size = sizes[at] if len(at) else np.zeros(0, np.int64)
        ends = np.cumsum(size)
        begin = (np.cumsum(sizes) - sizes)[at] - (ends - size) if len(at) else size
        flat = ids[np.repeat(begin, size) + np.arange(ends[-1] if len(ends) else 0)]
        for piece in new:
            if len(piece) > LONGEST_KNOWN:
                self.known.pop(piece, None)
                self.known.pop(piece.rstrip(self.MARKS), None)
        stops = np.concatenate([[0], ends])[np.cumsum(pc.list_value_length(words).to_numpy())]
        for start, stop in zip([0, *stops[:-1].tolist()], stops.tolist()):
            yield flat[start:stop]


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


@lru_cache(maxsize=1)
def rest_sizes(capacity: int = CAPACITY) -> list[list[int]]:
    """For each rest below the capacity, the sizes it is cut into: reciprocals, largest first."""
    sizes: list[list[int]] = [[]]
    for rest in range(1, capacity):
        size = rest if rest < SMALLEST_CUT else capacity // -(-capacity // rest)
        while size >= SMALLEST_CUT and capacity // (capacity // size) > rest:
            size -= 1
        sizes.append([size, *sizes[rest - size]])
    return sizes


class Filler:
    """One worker's open sequences, a list of pieces for each class."""

    def __init__(self, tier: int, capacity: int = CAPACITY, keep_ids: bool = True) -> None:
        self.capacity, self.keep_ids = capacity, keep_ids
        self.next_id = (tier << 56) + (TaskContext.get().partitionId() << 32)
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self._row(doc_id, start, ids, total, self.next_id, offset)
            offset += len(ids)
        self.next_id += 1

    def _row(self, doc_id, start, ids, total, sequence, offset) -> None:
        crc = zlib.crc32(ids.astype("<i4", copy=False))
        held = ids if self.keep_ids or sequence is None else None
        self.rows.append((doc_id, start, len(ids), held, crc, total, sequence, offset))

    def add(self, doc_id: int, start: int, ids: np.ndarray, total: int) -> None:
        pieces = self.open[len(ids)]
        pieces.append((doc_id, start, ids, total))
        if len(pieces) == self.capacity // len(ids):
            self._close(self.open.pop(len(ids)))

    def pass_on(self) -> None:
        """Pieces of sequences that are not full, without a sequence."""
        for pieces in self.open.values():
            for piece in pieces:
                self._row(*piece, None, None)
        self.open.clear()

    def finish(self) -> None:
        """All remaining pieces one after the other, cut where a sequence is full."""
        held, room = [], self.capacity
        for size in sorted(self.open, reverse=True):
            for doc_id, start, ids, total in self.open[size]:
                while len(ids):
                    part = ids[:room]
                    held.append((doc_id, start, part, total))
                    start, ids, room = start + len(part), ids[room:], room - len(part)
                    if not room:
                        self._close(held)
                        held, room = [], self.capacity
        if held:
            self._close(held)
        self.open.clear()

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) or [()] * len(_ARROW)
        held = [ids for ids in columns[3] if ids is not None]
        none = np.array([ids is None for ids in columns[3]], bool)
        bounds = np.cumsum([0, *(0 if ids is None else len(ids) for ids in columns[3])])
        columns[3] = pa.ListArray.from_arrays(
            bounds.astype(np.int32), np.concatenate(held) if held else np.zeros(0, np.int32),
            mask=pa.array(none))
        return pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _ARROW)],
            schema=_ARROW)


def _fill_documents(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler, sizes = Filler(0, capacity, keep_ids), rest_sizes(capacity)
        tokenizer = word_tokenizer(path)
        for batch in batches:
            for part in text_slices(batch, chars=TEXT_CHARS):
                ids_of = tokenizer.encode(part["text"])
                for doc_id, ids in zip(part["doc_id"].to_pylist(), ids_of):
                    ids = np.append(ids, np.int32(end_id))
                    total, start = len(ids), 0
                    for size in [capacity] * (total // capacity) + sizes[total % capacity]:
                        piece = ids[start:start + size]
                        # What waits for a sequence must not hold its whole document.
                        filler.add(doc_id, start, piece if size == capacity else piece.copy(), total)
                        start += size
                yield filler.take()
        filler.pass_on()
        yield filler.take()
    return run


def _fill_rest(tier: int, capacity: int, last: bool, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler = Filler(tier, capacity, keep_ids)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, bounds = part["ids"].flatten().to_numpy(), np.concatenate(
                    [[0], np.cumsum(pc.list_value_length(part["ids"]).to_numpy())])
                for i, (doc_id, start, total) in enumerate(zip(
                        *(part[c].to_pylist() for c in ("doc_id", "start", "doc_tokens")))):
                    filler.add(doc_id, start, ids[bounds[i]:bounds[i + 1]].copy(), total)
                yield filler.take()
        if last:
            filler.finish()
        else:
            filler.pass_on()
        yield filler.take()
    return run


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """One row for each piece: its document, place there, ids, sequence and place in the sequence.

    Without ``keep_ids`` only pieces that still look for a sequence carry ids between the steps, and
    the result's are null.
    """
    texts = documents(docs)
    filled = materialize(texts.mapInArrow(_fill_documents(path, capacity, end_id, keep_ids), PACKED), "pack")
    packed, tier = [filled.where("sequence_id is not null")], 0
    # A worker passes on a bounded number of pieces, so a merged worker's input is bounded too.
    workers = max(1, texts.rdd.getNumPartitions())
    while True:
        tier, workers = tier + 1, -(-workers // MERGE)
        rest = filled.where("sequence_id is null")
        filled = materialize(
            rest.coalesce(workers).mapInArrow(_fill_rest(tier, capacity, workers == 1, keep_ids), PACKED), "pack")
        packed.append(filled.where("sequence_id is not null"))
        if workers == 1:
            break
    out = packed[0]
    for more in packed[1:]:
        out = out.union(more)
    return out


def without_ids(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequences, tokens, and padded places over all sequences (none at a power of two)."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.bit_count(F.col("used")) == 1
    return used.agg(
        F.count("*").alias("sequences"), F.sum("used").alias("tokens"),
        F.sum(F.when(power, 0).otherwise(capacity - F.col("used"))).alias("padded"))
