"""Status transitions in the order of event time.

Rows wait in a table until the watermark (the largest time seen, less the allowed delay) has passed
them. What it has passed can get no earlier neighbour any more: it is put in order behind the last
status of its scan, and the changes are recorded. Rows that come behind the watermark are listed as
late, with the watermark they missed, and change nothing. At the end of a log ``release`` records
what still waits.

Every batch reads the one version of the waiting rows, last statuses and watermark that the batch
before it wrote, and writes its own: a repeated batch replaces itself. What waits is bounded by the
delay. Ordering goes through ``ordered.running``, so a scan with a third of all rows is dealt over
many tasks, which a state keyed by scan could not do.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from exposure.operators.ordered import MAX_GROUP_ROWS
from exposure.operators.progress import status_transitions
from exposure.schemas import TRANSITIONS
from exposure.session import discard_older
from exposure.streaming import jobs

POLLED = "scan_id bigint, seq bigint, ts timestamp_ntz, status string"
LATE = f"{POLLED}, watermark timestamp_ntz"
CLOCK = "watermark timestamp_ntz"
_ROW = ["scan_id", "seq", "ts", "status"]
_VERSIONS = {"waiting": POLLED, "last": POLLED, "clock": CLOCK}


def _version(batch_id: int) -> str:
    return f"{batch_id:012d}"


def _write(df: DataFrame, out: str, part: str, load: str) -> None:
    df.write.mode("overwrite").parquet(f"{out}/{part}/load={load}")


def _before(spark: SparkSession, out: str, part: str, load: str) -> DataFrame:
    return spark.read.schema(_VERSIONS[part]).parquet(f"{out}/{part}/load={load}")


def _at(moment: datetime.datetime | None) -> Column:
    return F.lit(None if moment is None else str(moment)).cast("timestamp_ntz")


def _advance(
    spark: SparkSession, out: str, came: DataFrame, before: str, load: str, delay: str | None,
    max_group_rows: int,
) -> None:
    """Record what the watermark passes and write the next version; no delay: everything passes."""
    clock = _before(spark, out, "clock", before).first()
    reached = clock["watermark"] if clock else None
    newest = came.agg(F.max("ts").alias("ts")).select(
        F.expr(f"ts - interval '{delay or '0 seconds'}'").alias("ts")).first()["ts"]
    watermark = max((t for t in (reached, newest) if t is not None), default=None)

    # A row without a time has no place in the order.
    missed = F.col("ts").isNull() if reached is None else (
        F.col("ts").isNull() | (F.col("ts") < _at(reached)))
    _write(came.where(missed).withColumn(
        "watermark", _at(reached)), out, "late", load)

    waiting = _before(spark, out, "waiting", before).unionByName(came.where(~missed))
    passed = F.lit(delay is None) if watermark is None else (
        F.lit(delay is None) | (F.col("ts") < _at(watermark)))
    last = _before(spark, out, "last", before)
    ready = waiting.where(passed & (F.length("status") > 0))
    rows = (
        lookup_last(last, ready).withColumn("_new", F.lit(0))
        .unionByName(ready.withColumn("_new", F.lit(1))))
    changed = status_transitions(rows, ["_new", "ts", "seq"], max_group_rows)
    _write(changed.where("_new = 1").select(
        "scan_id", "seq", "ts", "previous_status", "status"), out, "transitions", load)
    record = F.struct(*_ROW)
    newest_rows = last.withColumn("_new", F.lit(0)).unionByName(ready.withColumn("_new", F.lit(1)))
    _write(newest_rows.groupBy("scan_id").agg(
        F.max_by(record, F.struct("_new", "ts", "seq")).alias("_r")).select("_r.*"),
        out, "last", load)
    _write(waiting.where(~passed), out, "waiting", load)
    _write(spark.range(1).select(
        _at(watermark).alias("watermark")), out, "clock", load)


def lookup_last(last: DataFrame, rows: DataFrame) -> DataFrame:
    """The last status of the scans that have rows."""
    return last.join(rows.select("scan_id").distinct(), "scan_id", "left_semi")


def stream_transitions_in_order(
    log: DataFrame, out: str, checkpoint: str, delay: str, trigger: dict | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> StreamingQuery:
    """Record the status changes of a log (scan_id, seq, ts, status) that comes in any order.

    Rows may come up to ``delay`` (an interval) behind the newest one. Order is by (ts, seq). ``out``
    belongs to this checkpoint.
    """
    spark = log.sparkSession
    for part, schema in _VERSIONS.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(
            f"{out}/{part}/load={_version(0)}")
    for part, schema in (("late", LATE), ("transitions", TRANSITIONS)):
        jobs._ensure(spark, f"{out}/{part}", schema)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session, before, load = batch.sparkSession, _version(batch_id), _version(batch_id + 1)
        came = batch.select(*_ROW).persist()
        _advance(session, out, came, before, load, delay, max_group_rows)
        came.unpersist()
        for part in _VERSIONS:
            discard_older(session, f"{out}/{part}", {before, load})

    return jobs._start(log, handle, checkpoint, trigger)


def _newest_version(spark: SparkSession, out: str) -> str:
    """The version whose last part is complete."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/clock")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath() for s in files.listStatus(top)]
    done = [p.getName()[5:] for p in names if files.exists(p.suffix("/_SUCCESS"))]
    return max(done)


def release(spark: SparkSession, out: str, max_group_rows: int = MAX_GROUP_ROWS) -> None:
    """Record everything that waits: the log has ended, and the stream does not run.

    Should the stream go on after all, its next batch takes this back and waits again.
    """
    none = spark.createDataFrame([], POLLED)
    before = _newest_version(spark, out)
    load = _version(int(before) + 1)
    _advance(spark, out, none, before, load, None, max_group_rows)


def transitions(spark: SparkSession, out: str) -> DataFrame:
    return jobs._read(spark, f"{out}/transitions", TRANSITIONS).drop("load")


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """(scan_id, seq, ts, status, watermark): rows behind the watermark, and rows without a time."""
    return jobs._read(spark, f"{out}/late", LATE).drop("load")
