"""A store of sorted lines of many scans in files that follow the bytes, not the scans.

Lines are range-partitioned and sorted by (scan_id, line), so a file holds many small scans or a part
of a large one. An index has one row for each scan and file: the first and last line there and how
many. Writing scans again replaces them: the files that hold any of their lines are found in the
index, what else these files hold is written anew with the new lines, and all other files stay. A
write is complete with its version of the index; readers take the newest complete one, so a write
that fails or is repeated changes nothing that anybody reads. One writer at a time.

Paths of the files read or rewritten are held on the driver: one for about 64 MB of lines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposure.sources.writers import sorted_lines

LINES = "scan_id bigint, line string"
INDEX = "scan_id bigint, file string, first_line string, last_line string, lines bigint"


def _folder(spark: SparkSession, path: str):
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    return top, top.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    top, files = _folder(spark, f"{path}/index")
    if not files.exists(top):
        return []
    found = [s.getPath() for s in files.listStatus(top)]
    return sorted(int(p.getName().partition("=")[2]) for p in found
                  if p.getName().startswith("version=") and files.exists(p.suffix("/_SUCCESS")))


def read_index(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Where each scan's lines are; an empty store has none."""
    known = _versions(spark, path)
    if not known:
        return spark.createDataFrame([], INDEX)
    version = known[-1] if version is None else version
    return spark.read.schema(INDEX).parquet(f"{path}/index/version={version}")


def _read_files(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    names = [r["file"] for r in index.select("file").distinct().collect()]
    if not names:
        return spark.createDataFrame([], LINES)
    return spark.read.schema(LINES).parquet(*[f"{path}/files/{name}" for name in names])


def read_stored_lines(spark: SparkSession, path: str, scans: DataFrame | None = None) -> DataFrame:
    """(scan_id, line) of the store, or of some scans (scan_id): only files with their lines are read."""
    index = read_index(spark, path)
    if scans is None:
        return _read_files(spark, path, index)
    wanted = scans.select("scan_id").distinct()
    found = _read_files(spark, path, index.join(wanted, "scan_id", "left_semi"))
    return found.join(wanted, "scan_id", "left_semi")


def write_stored_lines(
    lines: DataFrame, path: str, column: str = "line", dedupe: bool = False,
) -> None:
    """Replace the scans that ``lines`` (scan_id and ``column``) holds; scans without lines stay.

    ``lines`` has to give the same rows whenever it is computed.
    """
    spark = lines.sparkSession
    known = _versions(spark, path)
    given = lines.select(F.col("scan_id").cast("bigint").alias("scan_id"), F.col(column).alias("line"))
    if dedupe:
        given = given.distinct()
    kept_index = None
    if known:
        index = read_index(spark, path, known[-1])
        scans = given.select("scan_id").distinct()
        touched = index.join(scans, "scan_id", "left_semi").select("file").distinct()
        beside = _read_files(spark, path, touched).join(scans, "scan_id", "left_anti")
        given = given.unionByName(beside)
        kept_index = index.join(touched, "file", "left_anti").select(*index.columns)
    load = f"load={uuid.uuid4().hex}"
    sorted_lines(given, dedupe=False).write.parquet(f"{path}/files/{load}")
    written = spark.read.schema(LINES).parquet(f"{path}/files/{load}").groupBy(
        "scan_id", F.concat(F.lit(f"{load}/"), F.col("_metadata.file_name")).alias("file")).agg(
        F.min("line").alias("first_line"), F.max("line").alias("last_line"),
        F.count("*").alias("lines"))
    whole = written if kept_index is None else kept_index.unionByName(written)
    whole.hint("rebalance").write.mode("overwrite").parquet(
        f"{path}/index/version={known[-1] + 1 if known else 0}")


def export_text(spark: SparkSession, path: str, target: str, scans: DataFrame) -> None:
    """Some scans as sorted text, a folder for each: for the few whose files somebody wants."""
    read_stored_lines(spark, path, scans).repartitionByRange("scan_id", "line").sortWithinPartitions(
        "scan_id", "line").write.partitionBy("scan_id").mode("overwrite").text(target)


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete earlier versions of the index, and loads of which the newest version uses no file."""
    known = _versions(spark, path)
    if not known:
        return
    loads = F.substring_index("file", "/", 1)
    used = {r["load"] for r in read_index(spark, path).select(loads.alias("load")).distinct().collect()}
    for part, keep in (("files", used), ("index", {f"version={known[-1]}"})):
        top, files = _folder(spark, f"{path}/{part}")
        for status in files.listStatus(top):
            if status.getPath().getName() not in keep:
                files.delete(status.getPath(), True)
