"""Text, JSON and raw-byte readers.

Scan folders may be laid out as ``scan_id=<n>/...``; partition values become columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposure.functions import text
from exposure.functions.documents import body_of, from_epoch
from exposure.schemas import SCAN_STATE, STATUS_ALIASES

# Names of result and template files.
RESULT_FILES = "*results_*"
TEMPLATE_FILES = "*.yaml"

PARTITIONS_TOGETHER = 64


def read_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Lines of all text files below ``path`` as (partition columns, path, line)."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return reader.text(path).select(
        "*", F.col("_metadata.file_path").alias("path")
    ).withColumnRenamed("value", "line")


def load_findings_glob(
    spark: SparkSession, path: str, pattern: str = RESULT_FILES
) -> DataFrame:
    """Non-blank, trimmed lines of every non-empty batch result file below ``path``."""
    reader = spark.read.option("pathGlobFilter", pattern)
    return (
        reader.text(path).filter("_metadata.file_size > 0")
        .filter(text.not_blank(F.col("value")))
        .select("*", F.col("_metadata.file_path").alias("path"))
        .withColumn("line", text.stripped(F.col("value"))).drop("value")
    )


def read_documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """One row per JSON file: (partition columns, path, doc)."""
    return (
        spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
        .select("*", F.col("_metadata.file_path").alias("path"))
        .withColumnRenamed("value", "doc")
    )


def load_scan_state(documents: DataFrame) -> DataFrame:
    """Scan-state JSON (scan_id, doc) as columns, with a default for every absent key.

    ``is_readable`` is false for broken JSON, whose other columns hold the defaults.
    """
    state = F.from_json("doc", SCAN_STATE)
    aliases = F.create_map(*[F.lit(part) for pair in STATUS_ALIASES.items() for part in pair])
    status = F.coalesce(F.col("_s.status"), F.lit("unknown"))
    counts = ("subdomains", "alive_subdomains", "vulnerabilities")
    return (
        documents.select("scan_id", body_of(F.col("doc")).isNotNull().alias("is_readable"),
                         state.alias("_s"))
        .select(
            "scan_id", "is_readable", status.alias("status"),
            F.coalesce(F.try_element_at(aliases, status), status).alias("display_status"),
            F.col("_s.start_time").alias("start_time"),
            F.coalesce("_s.duration", F.lit(0.0)).alias("duration"),
            *[F.coalesce(f"_s.{c}", F.lit(0)).alias(c) for c in counts],
            F.col("_s.error").alias("error"),
        )
    )


def read_cache(spark: SparkSession, *paths: str) -> DataFrame:
    """Cached results as (cache_key, ts, seq, result): a JSON file for each key, or lines with keys.

    An entry without a time counts as written in 1970, so it is stale.
    """
    return (
        spark.read.schema(
            "cache_key string, timestamp double, ts_us bigint, seq bigint, result string")
        .option("pathGlobFilter", "*.json").json(list(paths))
        .select(
            F.coalesce("cache_key", F.regexp_extract(
                F.col("_metadata.file_name"), r"^(.*)\.json$", 1)).alias("cache_key"),
            F.coalesce(
                F.timestamp_add("MICROSECOND", F.col("ts_us"), from_epoch(F.lit(0.0))),
                from_epoch(F.coalesce("timestamp", F.lit(0.0)))).alias("ts"),
            F.coalesce("seq", F.lit(0)).cast("bigint").alias("seq"), "result",
        )
    )


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, length and modification time; file contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(path)
        .select("path", "length", F.unix_timestamp("modificationTime").alias("mtime_s"))
    )


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Template files at any depth: path, length, content. Empty files are passed over by Spark.

    Spark counts the opening of a file as 4 MB, so 32 small files make a partition. Many of those are
    put together for a task: what it writes is then as few files.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", TEMPLATE_FILES)
        .option("recursiveFileLookup", "true").load(path)
        .select("path", "length", "content")
    )
    together = files.rdd.getNumPartitions() // PARTITIONS_TOGETHER
    return files.coalesce(max(together, 4 * spark.sparkContext.defaultParallelism))
