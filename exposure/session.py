"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "exposure", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Joins carry no broadcast hints: Catalyst broadcasts a side when its measured size is under
    the threshold, and otherwise adaptive execution splits skewed shuffle partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's shared checkpoint folder.

    A single-machine session without that setting gets a temporary folder; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="exposure-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard_older(spark: SparkSession, folder: str, keep: set[str]) -> None:
    """Delete the folders ``load=...`` inside ``folder`` except those in ``keep``."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(top):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("load=") and name[5:] not in keep:
            files.delete(status.getPath(), True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, cutting its lineage."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
