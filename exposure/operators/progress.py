"""Batches, progress, status changes and memory over the course of a scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposure.functions import text
from exposure.functions.documents import epoch_micros
from exposure.operators.ordered import (
    MAX_GROUP_ROWS, PEAK, PEAK_BEFORE, PREVIOUS, ROW_NUMBER, SUM, running,
)
from exposure.operators.joins import lookup_join
from exposure.schemas import MEMORY_THRESHOLD_MB, MEMORY_WARNING_RATIO

LOG_ORDER = ["ts", "seq"]


def assign_batches(
    hosts: DataFrame, size: int, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Cut each scan's sorted hosts into batches of ``size`` rows, numbered from 0."""
    numbered = running(
        hosts, ["scan_id"], ["host"], {"_row": (ROW_NUMBER, None)}, max_group_rows
    )
    return numbered.withColumn(
        "batch_id", F.floor((F.col("_row") - 1) / size)
    ).drop("_row")


def batch_totals(hosts: DataFrame, size: int) -> DataFrame:
    """Targets and batches per scan, without numbering any row."""
    return hosts.groupBy("scan_id").agg(F.count(F.lit(1)).alias("targets")).withColumn(
        "batches", F.ceil(F.col("targets") / size)
    )


def batch_progress(
    batches: DataFrame, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Running results and percent done around each batch of (scan_id, batch_id, n).

    Percent divides before it multiplies: 29 of 100 is 28, as the reported figure is.
    """
    totals = batches.groupBy("scan_id").agg((F.max("batch_id") + 1).alias("total_batches"))
    done = running(
        batches, ["scan_id"], ["batch_id"], {"results_count": (SUM, F.col("n"))}, max_group_rows
    )

    def percent(finished: Column) -> Column:
        return (finished / F.col("total_batches") * 100).cast("int")

    return lookup_join(done, totals, ["scan_id"]).withColumns({
        "progress_before": percent(F.col("batch_id")),
        "progress_after": percent(F.col("batch_id") + 1),
    })


def status_transitions(
    log: DataFrame, order: list[str] = LOG_ORDER, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Rows whose status differs from the row before; the first row of a scan counts.

    Rows with an empty status are not looked at.
    """
    seen = log.filter(F.length("status") > 0)
    return running(
        seen, ["scan_id"], order, {"previous_status": (PREVIOUS, F.col("status"))},
        max_group_rows,
    ).filter(~F.col("status").eqNullSafe(F.col("previous_status")))


def progress_increments(
    polls: DataFrame, value: str, order: list[str] = LOG_ORDER,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """What each poll adds to the largest value shown so far, never less than nothing."""
    return running(
        polls, ["scan_id"], order, {"_shown": (PEAK_BEFORE, F.col(value))}, max_group_rows
    ).withColumn(
        "increment",
        F.greatest(
            F.col(value) - F.greatest(F.coalesce("_shown", F.lit(0)), F.lit(0)), F.lit(0)
        ),
    ).drop("_shown")


def memory_profile(
    samples: DataFrame, threshold_mb: float = MEMORY_THRESHOLD_MB,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Running peak and a flag for samples above the warning level."""
    return running(
        samples, ["scan_id"], LOG_ORDER, {"peak_mb": (PEAK, F.col("memory_mb"))}, max_group_rows
    ).withColumn("is_high", F.col("memory_mb") > threshold_mb * MEMORY_WARNING_RATIO)


def memory_peaks(samples: DataFrame, threshold_mb: float = MEMORY_THRESHOLD_MB) -> DataFrame:
    high = F.col("memory_mb") > threshold_mb * MEMORY_WARNING_RATIO
    return samples.groupBy("scan_id").agg(
        F.max("memory_mb").alias("peak_mb"),
        F.count(F.lit(1)).alias("samples"),
        F.count_if(high).alias("high_samples"),
    )


def memory_documents(
    samples: DataFrame, per_document: int = 1_000, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Measurement arrays for JSON output, in time order, a bounded number per document.

    Every part names the peak of the whole scan.
    """
    peaks = samples.groupBy("scan_id").agg(F.max("memory_mb").alias("peak_usage"))
    numbered = running(
        samples, ["scan_id"], LOG_ORDER, {"_row": (ROW_NUMBER, None)}, max_group_rows
    )
    sample = F.struct(
        F.col("_row"), (epoch_micros(F.col("ts")) / 1e6).alias("timestamp"), "label", "memory_mb",
    )
    return (
        numbered.groupBy("scan_id", F.floor((F.col("_row") - 1) / per_document).alias("part"))
        .agg(F.sort_array(F.collect_list(sample)).alias("_samples"))
        .join(peaks, "scan_id", "left")
        .select(
            "scan_id", "part", "peak_usage",
            F.transform("_samples", lambda s: s.dropFields("_row")).alias("measurements"),
        )
    )


def latest_phase_status(events: DataFrame) -> DataFrame:
    """The last written record of every scan and phase (later ts, then later seq)."""
    record = F.struct("status", "progress", "results_count", "ts", "seq")
    return (
        events.groupBy("scan_id", "phase")
        .agg(F.max_by(record, F.struct("ts", "seq")).alias("_last"))
        .select("scan_id", "phase", "_last.*")
    )


def scan_durations(state: DataFrame, as_of_epoch: float) -> DataFrame:
    """Seconds since the start, and the same as text: seconds below a minute, else minutes."""
    duration = F.lit(as_of_epoch) - F.col("start_time")
    return state.withColumn("duration", duration).withColumn(
        "duration_text", duration_text(F.col("duration"))
    )


def duration_text(seconds: Column) -> Column:
    return F.when(seconds < 60, F.concat(text.one_decimal(seconds), F.lit("s"))).otherwise(
        F.concat(text.one_decimal(seconds / 60), F.lit("m"))
    )
