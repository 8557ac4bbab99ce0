"""Sinks. Part files are written by many tasks; nothing is gathered into one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposure.operators.inventory import bulk_load_hosts

HOST_BUCKETS = 512
COPIES_PER_ROW = 10_000


def sorted_lines(
    lines: DataFrame, column: str = "line", dedupe: bool = True,
    copies_per_row: int = COPIES_PER_ROW,
) -> DataFrame:
    """(scan_id, line) rows, range-partitioned and sorted: part files concatenate in order.

    Copies are counted before they are shuffled. When they have to stay, they travel as counts in
    bounded chunks and are only repeated in the task that writes them, so that a line that makes
    up a third of all rows is spread over several tasks.
    """
    counted = lines.select("scan_id", F.col(column).alias("line")).groupBy("scan_id", "line").agg(
        F.count(F.lit(1)).alias("_copies")
    )
    if dedupe:
        order = ["scan_id", "line"]
        return (
            counted.drop("_copies").repartitionByRange(*order).sortWithinPartitions(*order)
        )
    order = ["scan_id", "line", "_chunk"]
    chunked = counted.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_copies") / copies_per_row)))
    )
    here = F.least(
        F.lit(copies_per_row), F.col("_copies") - (F.col("_chunk") - 1) * copies_per_row
    ).cast("int")
    return (
        chunked.repartitionByRange(*order)
        .select("scan_id", F.explode(F.array_repeat("line", here)).alias("line"))
        .sortWithinPartitions("scan_id", "line")
    )


def write_tagged_findings(tagged: DataFrame, path: str) -> None:
    """Findings with their severity as a partition, so that a severity filter skips files.

    The rebalance hint splits a level that dominates over several tasks and files.
    """
    tagged.hint("rebalance", "severity").write.partitionBy("severity").mode("overwrite").parquet(
        path
    )


def write_json(df: DataFrame, path: str, *partition_columns: str) -> None:
    """JSON rows: scan state, memory documents, payloads."""
    writer = df.write.mode("overwrite")
    if partition_columns:
        writer = writer.partitionBy(*partition_columns).option(
            "partitionOverwriteMode", "dynamic"
        )
    writer.json(path)


def write_snapshots(snapshots: DataFrame, path: str) -> None:
    """Backups under ``snapshot=<time label>``; writing the same label again replaces it."""
    (
        snapshots.write.partitionBy("snapshot").option("partitionOverwriteMode", "dynamic")
        .mode("overwrite").parquet(path)
    )


# --- host table ------------------------------------------------------------------------------

def create_host_table(hosts: DataFrame, table: str, buckets: int = HOST_BUCKETS) -> None:
    """A store bucketed by its key: later anti-joins read the stored side without a shuffle."""
    (
        bulk_load_hosts(hosts).repartition(buckets, "scan_id", "host")
        .write.bucketBy(buckets, "scan_id", "host").mode("overwrite").saveAsTable(table)
    )


def append_host_table(fresh: DataFrame, table: str, buckets: int = HOST_BUCKETS) -> None:
    (
        fresh.select("scan_id", "host").repartition(buckets, "scan_id", "host")
        .write.bucketBy(buckets, "scan_id", "host").mode("append").saveAsTable(table)
    )
