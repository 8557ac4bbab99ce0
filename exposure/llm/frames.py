"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WAYS = 64
SLICE_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and text alone, null texts as empty ones; rows without a doc_id are left out."""
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        .where(F.col("doc_id").isNotNull())
    )


def way(*spread_by: Column | str, ways: int = WAYS) -> Column:
    return F.pmod(F.xxhash64(*spread_by), F.lit(ways)).cast("int")


def lookup(
    df: DataFrame, facts: DataFrame, key: str, spread_by: str, ways: int = WAYS, how: str = "left",
) -> DataFrame:
    """Join ``facts`` (one row for each key) to ``df`` when one key may hold a third of ``df``.

    The rows of a key are dealt over ``ways`` tasks by ``spread_by``. Every key first finds out
    which ways it uses (combined before the shuffle), so a key with few rows is not copied.
    """
    dealt = df.withColumn("_way", way(spread_by, ways=ways))
    used = dealt.select(key, "_way").distinct()
    copies = used.join(facts, key).select(key, "_way", *[c for c in facts.columns if c != key])
    return dealt.join(copies, [key, "_way"], how).drop("_way")


def keep_documents(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a doc_id in ``ids``, columns as they were."""
    return docs.join(ids.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)


def keep_marked(docs: DataFrame, kept: DataFrame, mark: str, of: Column) -> DataFrame:
    """One row of ``docs`` for each (doc_id, mark) in ``kept``: the longest text, columns as they were.

    ``of`` computes a row's mark from its text, so where a doc_id stands for several texts, each is
    kept or dropped by itself. The window needs no shuffle of its own.
    """
    at, turn = mark, "_turn"
    while at in docs.columns:
        at = f"_{at}"
    while turn in docs.columns:
        turn = f"_{turn}"
    wanted = kept.select(F.col("doc_id"), F.col(mark).alias(at)).distinct()
    longest = Window.partitionBy("doc_id", at).orderBy(F.char_length("text").desc(), "text")
    return (
        docs.withColumn(at, of).join(wanted, ["doc_id", at], "left_semi")
        .withColumn(turn, F.row_number().over(longest)).where(F.col(turn) == 1)
        .select(*docs.columns))


def smallest_hashes(ids: DataFrame, rows: int) -> DataFrame:
    """About the ``rows`` ids (doc_id) of smallest hash, a few more rather than fewer.

    The share of hashes that holds them follows from one count, so tasks pass on what is chosen only.
    """
    many = ids.count()
    share = min(1.0, (rows + 6 * rows ** 0.5 + 10) / max(many, 1))
    limit = int(-2 ** 63 + share * 2 ** 64) - 1 if share < 1 else 2 ** 63 - 1
    return ids.where(F.xxhash64("doc_id") <= F.lit(limit))


def text_slices(batch: pa.RecordBatch, column: str = "text", chars: int = SLICE_CHARS):
    """Parts of a batch with about ``chars`` bytes of text each (at least one row)."""
    lengths = pc.binary_length(batch[column]).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < len(lengths):
        yield batch.slice(start)
