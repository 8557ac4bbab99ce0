"""Streams that keep host stores, phase state and status transitions up to date.

Each micro-batch writes its own ``load=<query>-<batch>`` folder in overwrite mode and reads only
the others. A batch that is repeated after a failure therefore replaces what its first attempt
wrote, and a stopped query continues from its checkpoint without repeating finished batches. The
query part of the name is the identity Spark keeps in the checkpoint, so that a query with a new
checkpoint can never replace the loads of an older one.

State does not grow with the number of batches: every ``MERGE_EVERY`` batches a batch writes the
whole state as its load, and once that batch is committed, the next one deletes the loads before it.
A state folder holds at most about twice as many loads as that, so what a batch lists and reads is
bounded by the state. A host store merges its loads by size (``sources.hoststore``). Recorded
transitions are results and only grow by new rows. A ``compact_*`` job, run while the stream is stopped, writes them into a new folder, with which the
stream then continues from the same checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from exposure.operators.checkpoints import latest_documents
from exposure.operators.inventory import append_new_hosts
from exposure.operators.ordered import MAX_GROUP_ROWS
from exposure.operators.progress import latest_phase_status, status_transitions
from exposure.schemas import DOCUMENT_STATE, LAST_STATUS, PHASE_STATE, PHASES, TRANSITIONS
from exposure.session import discard_older
from exposure.sources.hoststore import (
    FAN, drop_dead_loads, earlier_loads, load_name, load_names, merged_loads, read_loads,
    write_host_load,
)

MERGE_EVERY = 16


def _query_name(spark: SparkSession, checkpoint: str) -> str:
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def _load_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    return f"{_query_name(spark, checkpoint)}-{batch_id:012d}"


def _start(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _ensure(spark: SparkSession, path: str, schema: str) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/load=empty")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, load string").parquet(path)


def _write_state(
    state: DataFrame, path: str, schema: str, checkpoint: str, batch_id: int, merge_every: int,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Write a batch's state as its load; ``merge`` puts all earlier state below it when due."""
    spark = state.sparkSession
    load = _load_name(spark, checkpoint, batch_id)
    if batch_id % merge_every == 0:
        earlier = _read(spark, path, schema).filter(F.col("load") != load).drop("load")
        state = merge(earlier, state)
    state.write.mode("overwrite").parquet(f"{path}/load={load}")
    if batch_id % merge_every == 1:
        # This batch runs, so the merged one before it is committed.
        discard_older(spark, path, {load, _load_name(spark, checkpoint, batch_id - 1)})


def stream_new_hosts(
    hosts: DataFrame, store: str, checkpoint: str, trigger: dict | None = None, fan: int = FAN,
    on_written: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Add hosts (scan_id, host) that the store at ``store`` does not hold yet.

    The store's loads merge by size, so a batch lists and reads few of them however many there were.
    ``on_written`` is told the batch once its load is written; the batch is committed after that.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = _query_name(spark, checkpoint)
        drop_dead_loads(spark, store, query, batch_id)
        names = earlier_loads(load_names(spark, store), query, batch_id)
        fresh = append_new_hosts(read_loads(spark, store, names), batch)
        merged = merged_loads(names, query, batch_id, fan)
        if merged:
            fresh = fresh.unionByName(read_loads(spark, store, merged))
        write_host_load(fresh, store, load_name(query, batch_id, fan))
        if on_written:
            on_written(batch_id)

    return _start(hosts, handle, checkpoint, trigger)


def new_hosts_within(hosts: DataFrame, ts: str, delay: str) -> DataFrame:
    """Unique hosts with bounded state: a host may come again once ``delay`` has passed."""
    return hosts.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["scan_id", "host"])


def stream_phase_state(
    events: DataFrame, state: str, checkpoint: str, trigger: dict | None = None,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Keep the latest record per scan and phase; read it with ``current_phase_state``."""
    _ensure(events.sparkSession, state, PHASE_STATE)

    def handle(batch: DataFrame, batch_id: int) -> None:
        latest = latest_phase_status(batch.filter(F.col("phase").isin(*PHASES)))
        _write_state(
            latest, state, PHASE_STATE, checkpoint, batch_id, merge_every,
            lambda earlier, new: latest_phase_status(earlier.unionByName(new)),
        )

    return _start(events, handle, checkpoint, trigger)


def current_phase_state(spark: SparkSession, state: str) -> DataFrame:
    """Each load holds one row per scan and phase it touched; the last written one counts."""
    return latest_phase_status(_read(spark, state, PHASE_STATE))


def stream_checkpoints(
    updates: DataFrame, state: str, checkpoint: str, trigger: dict | None = None,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Keep the last written document per scan; updates are (scan_id, ts, seq, doc)."""
    _ensure(updates.sparkSession, state, DOCUMENT_STATE)

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_state(
            latest_documents(batch), state, DOCUMENT_STATE, checkpoint, batch_id, merge_every,
            lambda earlier, new: latest_documents(earlier.unionByName(new)),
        )

    return _start(updates, handle, checkpoint, trigger)


def current_checkpoints(spark: SparkSession, state: str) -> DataFrame:
    return latest_documents(_read(spark, state, DOCUMENT_STATE))


def compact_checkpoints(spark: SparkSession, state: str, target: str) -> None:
    current_checkpoints(spark, state).write.mode("overwrite").parquet(f"{target}/load=compacted")


def compact_phase_state(spark: SparkSession, state: str, target: str) -> None:
    current_phase_state(spark, state).write.mode("overwrite").parquet(f"{target}/load=compacted")


def stream_status_transitions(
    log: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
    max_group_rows: int = MAX_GROUP_ROWS, merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Record status changes in the order they arrive; the last status of a scan carries over.

    A batch's rows follow all earlier batches, also where their time is before; within the batch,
    (ts, seq) counts.
    """
    spark = log.sparkSession
    transitions, carried = f"{out}/transitions", f"{out}/last_status"
    _ensure(spark, transitions, TRANSITIONS)
    _ensure(spark, carried, LAST_STATUS)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        load = _load_name(session, checkpoint, batch_id)
        record = F.struct("seq", "ts", "status")
        polled = (
            batch.filter(F.length("status") > 0).select("scan_id", record.alias("_r")).persist()
        )
        before = (
            _read(session, carried, LAST_STATUS).filter(F.col("load") != load)
            .join(polled.select("scan_id").dropDuplicates(), "scan_id", "left_semi")
            .groupBy("scan_id").agg(F.max_by(record, "arrived").alias("_r"))
        )
        rows = (
            before.withColumn("_arrived", F.lit(0))
            .unionByName(polled.withColumn("_arrived", F.lit(1)))
            .select("scan_id", "_arrived", "_r.*")
        )
        changed = status_transitions(rows, ["_arrived", "ts", "seq"], max_group_rows)
        (
            changed.filter("_arrived = 1")
            .select("scan_id", "seq", "ts", "previous_status", "status")
            .write.mode("overwrite").parquet(f"{transitions}/load={load}")
        )
        last = (
            polled.groupBy("scan_id")
            .agg(F.max_by("_r", F.struct("_r.ts", "_r.seq")).alias("_r"))
            .select("scan_id", "_r.*", F.lit(batch_id).cast("bigint").alias("arrived"))
        )
        _write_state(
            last, carried, LAST_STATUS, checkpoint, batch_id, merge_every,
            lambda earlier, new: last_arrived(
                # What an earlier query left has its own numbers: it comes before all of these.
                (last_arrived(earlier).withColumn("arrived", F.lit(-1).cast("bigint"))
                 if batch_id == 0 else earlier).unionByName(new)
            ),
        )
        polled.unpersist()

    return _start(log, handle, checkpoint, trigger)


def last_arrived(carried: DataFrame) -> DataFrame:
    """One last status for each scan."""
    row = F.struct("seq", "ts", "status", "arrived")
    return carried.groupBy("scan_id").agg(F.max_by(row, "arrived").alias("_r")).select(
        "scan_id", "_r.*"
    )


def compact_transitions(spark: SparkSession, out: str, target: str) -> None:
    """All recorded transitions, and one last status per scan."""
    recorded_transitions(spark, out).write.mode("overwrite").parquet(
        f"{target}/transitions/load=compacted"
    )
    last_arrived(_read(spark, f"{out}/last_status", LAST_STATUS).drop("load")).write.mode(
        "overwrite"
    ).parquet(f"{target}/last_status/load=compacted")


def recorded_transitions(spark: SparkSession, out: str) -> DataFrame:
    return _read(spark, f"{out}/transitions", TRANSITIONS).drop("load")


def transition_counts(transitions: DataFrame) -> DataFrame:
    return transitions.groupBy("scan_id").agg(F.count(F.lit(1)).alias("transitions"))
