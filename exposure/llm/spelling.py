"""Grouping spelling variants by permuterm rotations.

A word gets an end mark and is written in all its rotations, each once whole and once without its
last character. Behind a rotation's first part, the last character is the one that an edit would
touch: words that agree in all but one replaced character share the shortened rotation, and a word
with one character more shares, shortened, the whole rotation of the word without it. So sorted by
rotation, all near words of one edited place lie side by side, and a group has one member for each
letter that fits there: never more than the alphabet has. The scan of a group tells each member how
many neighbours it has there and which is the most frequent; pairs are never written. A character
deleted from a run of equal ones counts at the first place of the run only, so a pair of words meets
in exactly one group.

Words over LONG_WORD characters would take the square of their length that way. Their rotations
(and the whole ones of words that are just shorter) travel as rolling hashes, and only the rotations
that meet another one are written out and compared.

Words hold no U+0000. Null texts have no words; rows without a doc_id are left out; a repeated
doc_id counts each time; equal counts go by code-point order. Other columns of the documents are
not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exposure.llm.frames import lookup
from exposure.session import materialize

RUN = r"[A-Za-zÀ-ÿ]+"
MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
END = "\x00"
LONG_WORD = 64

_PRIME = (1 << 61) - 1
_BASES = (1_000_003, 0x9E3779B97F4A7C1)
_RAW = "key string, word string, n long, at int, whole boolean, first boolean"


def runs_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, run): every run of letters of the whole texts, only A-Z lower-cased."""
    lowered = F.translate(
        F.col(text).cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))


def dropped_letter(doc_id: Column, run: Column, every: int) -> Column:
    """The run, without one letter where a checksum of document and run is a multiple of ``every``."""
    check = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (check % F.char_length(run)).cast("int")
    return F.when(check % every == 0, F.concat(
        F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def count_words(
    words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (
        words.where(F.char_length("word") >= min_chars)
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _rotation(word: Column, at: Column, whole: Column) -> Column:
    """The rotation that ends before character ``at`` if whole, else the one that would end with it."""
    behind = F.substring(word, at + F.when(whole, 1).otherwise(2), F.char_length(word))
    return F.concat(behind, F.lit(END), F.substring(word, F.lit(1), at))


def _short_rotations(words: DataFrame) -> DataFrame:
    size = F.char_length("word")
    rows = (
        words.where(size <= LONG_WORD)
        .withColumn("at", F.explode(F.sequence(F.lit(0), size)))
        .withColumn("whole", F.explode(F.array(F.lit(True), F.lit(False))))
        .where(F.when(F.col("whole"), size < LONG_WORD).otherwise(F.col("at") < size)))
    at = F.col("at")
    first = (at == 0) | (F.substring("word", at, F.lit(1)) != F.substring("word", at + 1, F.lit(1)))
    return rows.select(
        _rotation(F.col("word"), at, F.col("whole")).alias("key"), "word", "n", "whole",
        first.alias("first"))


def _sums(word: str, base: int) -> tuple[list[int], list[int]]:
    """Hashes of all beginnings and of all endings."""
    before, after = [0], [0]
    for c in word:
        before.append((before[-1] * base + ord(c)) % _PRIME)
    for c in reversed(word):
        after.append((after[-1] * base + ord(c)) % _PRIME)
    return before, after[::-1]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, word, n in zip(*(batch[c].to_pylist() for c in ("name", "word", "n"))):
            sums = [_sums(word, base) for base in _BASES]
            size = len(word)
            for start in range(0, size + 1, 10_000):
                rows = []
                for at in range(start, min(start + 10_000, size + 1)):
                    for whole in (True, False) if LONG_WORD < size and at < size else (True,):
                        parts = [x for b, a in sums for x in (b[at], a[at + (not whole)])]
                        rows.append((":".join(map(str, [at, size - (not whole), *parts])), name, n,
                                     at, whole, at == 0 or at == size or word[at - 1] != word[at]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()))],
                    ["key", "word", "n", "at", "whole", "first"])


def _long_rotations(words: DataFrame) -> DataFrame:
    """As _short_rotations, but only those whose hash another word has as well."""
    long = words.where(F.char_length("word") >= LONG_WORD).withColumn("name", F.sha2("word", 256))
    rows = long.select("name", "word", "n").mapInArrow(_hashed, _RAW)
    met = rows.withColumn("others", F.count("*").over(Window.partitionBy("key"))).where("others > 1")
    named = met.withColumnRenamed("word", "name").join(long.select("name", "word"), "name")
    return named.select(
        _rotation(F.col("word"), F.col("at"), F.col("whole")).alias("key"), "word", "n", "whole",
        "first")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): how many near words, and the most frequent of them.

    ``words``: (word, n), each word once. Words without a near word are not returned.
    """
    rows = _short_rotations(words).unionByName(_long_rotations(words))
    this = F.struct((-F.col("n")).alias("less"), F.col("word"))
    rows = rows.select("key", "whole", "first", this.alias("this"))
    group = Window.partitionBy("key").orderBy("whole", "this")
    everyone = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut, whole = ~F.col("whole"), F.col("whole")
    seen = rows.select(
        "key", "whole", "first", "this",
        F.row_number().over(group).alias("turn"),
        F.lead(F.when(cut, F.col("this"))).over(group).alias("following"),
        F.first("this").over(everyone).alias("best"),
        F.count("*").over(everyone).alias("members"),
        F.count_if(cut).over(everyone).alias("cuts"),
        F.count_if(cut & F.col("first")).over(everyone).alias("firsts"),
        F.min(F.when(cut & F.col("first"), F.col("this"))).over(everyone).alias("longer"),
        F.min(F.when(whole, F.col("this"))).over(everyone).alias("shorter"),
    ).where("members > 1")
    replaced = F.when(F.col("turn") == 1, F.col("following")).otherwise(F.col("best"))
    shorter = F.when(F.col("first"), F.col("shorter"))
    found = seen.select(
        F.col("this.word").alias("word"),
        F.when(whole, F.col("firsts")).otherwise(
            F.col("cuts") - 1 + shorter.isNotNull().cast("long")).alias("near"),
        F.when(whole, F.col("longer")).otherwise(F.least(replaced, shorter)).alias("form"))
    return (
        found.where("near > 0").groupBy("word")
        .agg(F.sum("near").alias("n_near"), F.min("form").alias("_form"))
        .select("word", "n_near", (-F.col("_form.less")).alias("form_n"),
                F.col("_form.word").alias("form")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), where every form is more frequent than its words.

    Each round doubles the way that is followed. Counts at least double from form to form, so the
    ways are short and the rounds few.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if now.join(ahead, "root", "left_semi").isEmpty():
            return now
        now = materialize(
            lookup(now, ahead, "root", "word")
            .select("word", F.coalesce("further", "root").alias("root")), "forms")


def spelling_forms(counted: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for (word, n)."""
    words = materialize(counted.select("word", F.col("n").cast("long").alias("n")), "words")
    near = near_words(words)
    enough = F.col("form_n") >= ratio * F.col("n")
    named = materialize(
        words.join(near, "word", "left").select(
            "word", F.when(enough, F.col("form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("form_n")).alias("form_n")), "near-words")
    ends = roots(named.where("form is not null"))
    return named.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, drop_every: int) -> DataFrame:
    """The words of all documents, with a letter dropped in one of ``drop_every`` (document, run)."""
    runs = runs_of(docs)
    words = runs.select(dropped_letter(F.col("doc_id"), F.col("run"), drop_every).alias("word"))
    return spelling_forms(count_words(words))
