"""Cached results as a log of JSON lines whose loads merge by size.

Every append writes one numbered load, as a batch of the host store does (``hoststore``): where the
number completes a group of FAN loads, of FAN squared and so on, they are written as one, and of
several writes of a key only the last is kept. So the log holds few loads, an append rewrites little,
and an append that is repeated under its number replaces itself. Loads are sorted by a hash of the
key: a file holds one range of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposure.functions.documents import epoch_micros
from exposure.sources import hoststore
from exposure.sources.readers import read_cache

LOG = "cache"
ENTRIES = "cache_key string, ts timestamp_ntz, seq bigint, result string"


def latest_entries(entries: DataFrame) -> DataFrame:
    """The last write of each key."""
    row = F.struct("ts", "seq", "result")
    return entries.groupBy("cache_key").agg(
        F.max_by(row, F.struct("ts", "seq")).alias("_r")).select("cache_key", "_r.*")


def _read(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], ENTRIES)
    return read_cache(spark, *[f"{path}/load={n}" for n in names])


def read_cache_log(spark: SparkSession, path: str) -> DataFrame:
    """(cache_key, ts, seq, result): of each key at most one entry a load, all to be looked up."""
    return _read(spark, path, hoststore.live_loads(hoststore.load_names(spark, path)))


def append_cache(entries: DataFrame, path: str, number: int, fan: int = hoststore.FAN) -> None:
    """Append entries (cache_key, ts, seq, result) under ``number``, counted from 0 without gaps.

    A null time counts as 1970. Entries without a key are left out.
    """
    spark = entries.sparkSession
    hoststore.drop_dead_loads(spark, path, LOG, number)
    names = hoststore.earlier_loads(hoststore.load_names(spark, path), LOG, number)
    merged = _read(spark, path, hoststore.merged_loads(names, LOG, number, fan))
    fresh = entries.where("cache_key is not null").select(
        "cache_key", F.coalesce("ts", F.lit("1970-01-01").cast("timestamp_ntz")).alias("ts"),
        F.coalesce("seq", F.lit(0)).cast("bigint").alias("seq"), "result")
    spread = F.xxhash64("cache_key")
    latest_entries(fresh.unionByName(merged)).select(
        "cache_key", epoch_micros(F.col("ts")).alias("ts_us"), "seq", "result"
    ).repartitionByRange(spread).sortWithinPartitions(spread).write.mode("overwrite").json(
        f"{path}/load={hoststore.load_name(LOG, number, fan)}")
