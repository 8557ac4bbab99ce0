"""From raw documents to packed sequences: each stage is written, and the next one reads it.

Every stage takes tables with nulls in any column, empty and very long texts, repeated rows and
further columns, and gives an empty table for an empty one. Rows without a doc_id end at the first
stage.

* Language: keeps the rows whose text is surely in a learnt language; null, empty and letterless
  texts go.
* Quality: keeps the rows that reach the threshold; without labels, those of the learnt share.
* Exact dedup: of equal texts the longest original stays, then the smallest doc_id. A doc_id with
  several texts keeps each that stays by itself.
* Near dedup: of each group the row of the smallest doc_id stays, decided for each text.
* Packing: one row for each piece with its ids, all rows of the stage before, whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from exposure.llm import exact_dedup, language, packing, quality, simhash
from exposure.llm.frames import table
from exposure.llm.queries import WORD_VOCABULARY
from exposure.session import materialize


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted_documents(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, WORD_VOCABULARY)


STAGES = [
    ("language", told_language),
    ("quality", good_quality),
    ("exact_dedup", no_copies),
    ("near_dedup", no_near_copies),
    ("packing", packed),
]

#: Classifiers, fingerprints and tokenizers have no SQL; tests/llm compares run() stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
