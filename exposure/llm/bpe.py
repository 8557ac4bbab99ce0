"""Byte-level BPE encoding and decoding with a public vocabulary.

A word's bytes are parts in one contiguous array beside an array of the ranks of adjacent parts.
The smallest rank (leftmost of equals) is looked for again and again; the boundary it stands for
is deleted and the two ranks beside it are refreshed. That is quadratic, so words of more than
SHORT_WORD bytes take a heap over linked parts with the same merges. Words are cut inside tasks;
the ids of pieces seen before are kept in a bounded dictionary, and a batch is put together with
numpy.

The pattern of words and the alphabet that stands for bytes are fixed values of the vocabulary's
format. Null texts count as empty and give no ids; rows without a doc_id are left out. A repeated
doc_id is encoded each time, texts of any length are encoded whole, and an empty table gives an empty
result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposure.llm.frames import documents, text_slices

SHORT_WORD = 100
KNOWN_PIECES = 300_000
WORDS_AT_ONCE = 4096
LONGEST_KNOWN = 64

# What the vocabulary's pattern takes for white space, and that pattern.
WHITE = r"\t-\r \x85\xa0  -     　"
LETTER, NUMBER = r"\p{L}", r"\p{N}"


def word_pattern(letter: str = LETTER, number: str = NUMBER) -> str:
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+"
        rf"| ?[^{WHITE}{letter}{number}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


# Words never cross these pieces, which a simpler pattern finds.
PIECES = rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def byte_alphabet() -> dict[str, int]:
    """Visible Latin-1 characters stand for their own byte; the others are moved past 255."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class NewerLetters(dict):
    """Character -> whether it is a letter or number here, but not in the library's older tables.

    The library is asked once for each character: a letter it knows joins the one before it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.letter, self.number = regex.compile(LETTER), regex.compile(NUMBER)

    def __missing__(self, c: str) -> bool:
        beside = "a" if self.letter.match(c) else "1" if self.number.match(c) else None
        self[c] = beside is not None and len(self.cut(beside + c)) > 1
        return self[c]

    def of(self, text: str) -> str:
        return "".join(sorted({c for c in text if c > "\x7f" and self[c]}))


@lru_cache(maxsize=256)
def pinned_words(newer: str) -> regex.Pattern:
    """The pattern for texts with ``newer`` letters, which count as neither letters nor numbers."""
    out = "".join(rf"\U{ord(c):08X}" for c in newer)
    return regex.compile(
        word_pattern(f"[{LETTER}--[{out}]]", f"[{NUMBER}--[{out}]]"), regex.V1)


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        vocab, alphabet = saved["model"]["vocab"], byte_alphabet()
        added = {t["content"]: t["id"] for t in saved["added_tokens"]}
        self.byte_ids = [0] * 256
        self.tokens: list[bytes] = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, at in vocab.items():
            self.tokens[at] = bytes(alphabet[c] for c in token)
            if len(token) == 1:
                self.byte_ids[alphabet[token]] = at
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(saved["model"]["merges"]):
            self.ranks[vocab[left], vocab[right]] = rank
            self.merged.append(vocab[left + right])
        self.first_ids = np.array(self.byte_ids, np.int32)
        self.merged_ids = np.array([*self.merged, -1], np.int32)
        pairs = np.array([a * len(self.tokens) + b for a, b in self.ranks], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], order.astype(np.int32)
        self.added = added
        for token, at in added.items():
            self.tokens[at] = token.encode()
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.token_lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        longest_first = sorted(added, key=len, reverse=True)
        self.split_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None
        self.words, self.pieces = regex.compile(word_pattern()), re.compile(PIECES)
        self.newer = NewerLetters(path)
        self.forget()

    def forget(self) -> None:
        self.known_words: dict[str, np.ndarray] = {
            t: np.array([i], np.int32) for t, i in self.added.items()}
        self.slots: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    # --- words ---------------------------------------------------------------------------

    def word_ids(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word; short words of about one length go together."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, word in enumerate(words):
            if len(word) > SHORT_WORD:
                out[i] = np.array(self._heap(word), np.int32)
            else:
                by_length[(len(word) + 3) // 4].append(i)
        for rows in by_length.values():
            for at in range(0, len(rows), WORDS_AT_ONCE):
                part = rows[at:at + WORDS_AT_ONCE]
                for i, ids in zip(part, self._scan([words[i] for i in part])):
                    out[i] = ids
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of adjacent parts; len(merged) where they don't merge or one is missing (-1)."""
        pair = left.astype(np.int64) * len(self.tokens) + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        found = (self.pairs[at] == pair) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[at], len(self.merged)).astype(np.int32)

    def _scan(self, words: list[bytes]) -> list[np.ndarray]:
        """A row for each word: its parts (-1 behind the last) beside the ranks of neighbours."""
        n, width = len(words), max(map(len, words), default=0) + 1
        parts = np.full((n, width), -1, np.int32)
        for row, word in zip(parts, words):
            row[:len(word)] = self.first_ids[np.frombuffer(word, np.uint8)]
        ranks = np.full((n, width), len(self.merged), np.int32)
        ranks[:, :-1] = self._rank(parts[:, :-1], parts[:, 1:])
        out: list[np.ndarray] = [parts[0, :0]] * n
        index, columns = np.arange(n), np.arange(width)
        while len(index):
            at = ranks.argmin(1)
            best = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
            done = best == len(self.merged)
            if done.any():
                for i, row, size in zip(index[done], parts[done], (parts[done] >= 0).sum(1)):
                    out[i] = row[:size]
                left = ~done
                index, parts, ranks, at, best = (
                    index[left], parts[left], ranks[left], at[left], best[left])
            every, after = np.arange(len(index)), np.minimum(at + 1, width - 1)
            parts[every, at] = self.merged_ids[best]
            behind = np.minimum(columns + (columns > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, behind, 1)
            ranks = np.take_along_axis(
                ranks, np.minimum(columns + (columns >= at[:, None]), width - 1), 1)
            ranks[every, at] = self._rank(parts[every, at], parts[every, after])
            inner = np.flatnonzero(at > 0)
            before = at[inner] - 1
            ranks[inner, before] = self._rank(parts[inner, before], parts[inner, at[inner]])
        return out

    def _heap(self, word: bytes) -> list[int]:
        """The same merges for a long word, in n log n."""
        parts = [self.byte_ids[b] for b in word]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.ranks[pair], i, pair) for i, pair in enumerate(zip(parts, parts[1:]))
                if pair in self.ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j], after[i] = self.merged[rank], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    pair = parts[left], parts[after[left]]
                    if pair in self.ranks:
                        heapq.heappush(heap, (self.ranks[pair], left, pair))
        return [p for p in parts if p >= 0]

    # --- texts ---------------------------------------------------------------------------

    def _words_of(self, piece: str) -> list[str]:
        newer = "" if piece.isascii() else self.newer.of(piece)
        return (pinned_words(newer) if newer else self.words).findall(piece)

    def _learn(self, pieces: list[str]) -> None:
        """Cut unseen pieces into words; ``word``, ``word.`` and ``word,`` share a word's ids."""
        cut = [[p] if p in self.added else self._words_of(p) for p in pieces]
        new = list(set(chain.from_iterable(cut)).difference(self.known_words, self.added))
        self.known_words.update(zip(new, self.word_ids([w.encode() for w in new])))
        found = [self.known_words[w] for words in cut for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, cut)])]
        self.slots.update(zip(pieces, range(len(self.starts), len(self.starts) + len(pieces))))
        self.starts = np.concatenate([self.starts, len(self.flat) + ends[:-1]])
        self.lengths = np.concatenate([self.lengths, np.diff(ends)])
        self.flat = np.concatenate([self.flat, *found])
        for word in new:
            if len(word) > LONGEST_KNOWN:
                del self.known_words[word]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text starts (and the last ends)."""
        if len(self.slots) > KNOWN_PIECES or len(self.flat) > 10 * KNOWN_PIECES:
            self.forget()
        pieces: list[str] = []
        counts = []
        for text in texts:
            held = len(pieces)
            if self.split_added and any(t in text for t in self.added):
                for i, part in enumerate(self.split_added.split(text)):
                    pieces.extend([part] if i % 2 else self.pieces.findall(part))
            else:
                pieces.extend(self.pieces.findall(text))
            counts.append(len(pieces) - held)
        new = list(set(pieces).difference(self.slots))
        self._learn(new)
        slots = np.fromiter(map(self.slots.__getitem__, pieces), np.int64, len(pieces))
        starts, lengths = self.starts[slots], self.lengths[slots]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(starts - ends + lengths, lengths) + np.arange(total)
        ids = self.flat[at]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        for piece in new:
            if len(piece) > LONGEST_KNOWN:
                del self.slots[piece]
        return ids, bounds.astype(np.int64)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of ids that lie one after the other, text i from bounds[i] to bounds[i + 1]."""
        lengths = self.token_lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.token_starts[ids] - ends + lengths, lengths) + np.arange(total)
        held = self.token_bytes[at].tobytes()
        cuts = np.concatenate([[0], ends])[bounds].tolist()
        return [held[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every text; ``path`` is the vocabulary file, readable on every executor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for part in text_slices(batch):
                ids, bounds = words.encode(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.ListArray.from_arrays(bounds.astype(np.int32), ids)],
                    ["doc_id", "ids"])
    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text beside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(part["ids"]).to_numpy())])
                texts = words.decode(part["ids"].flatten().to_numpy(), bounds)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["ids"], pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"])
    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
