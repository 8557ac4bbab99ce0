"""Update events folded into stored scan documents while they arrive.

Events of four kinds name a phase, a phase's position, a statistic or a whole-scan field. They are
brought to one form, slots: (kind, name, field) of a document and the JSON value written there. Every
task keeps only the last write of a slot among its rows, so a scan with a third of all events sends a
few rows on. What a document does not hold is rejected before the state, by a join with the names
that the documents hold; rejects go to a sink of their own. The state of a scan is its document and,
for each slot, when it was last written: events may come in any order, in any batch, and after a
restart, and the last written one counts. Finished scans leave the state after a while; what comes for
them later is rejected too.

The state is a table of loads below the checkpoint, as the state of the other streams is, and a batch
meets it in one join. A scan enters it with its first update: until then its document only lies in the
table of documents that the first start wrote. A keyed state of Spark's takes several calls
between Python and the JVM for every scan, also for the many that no update names.

Documents are the JSON texts themselves. Keys that nobody updates stay (numbers as Python reads
them). Only documents that load are updated; others stay as they are.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from exposure.functions.documents import epoch_micros
from exposure.operators.checkpoints import POSITION, load_checkpoints
from exposure.operators.joins import lookup_join
from exposure.schemas import DOCUMENT_STATE
from exposure.session import materialize
from exposure.streaming import jobs

UPDATE = ("scan_id bigint, ts timestamp_ntz, seq bigint, kind string, name string, field string, "
          "value string")
PHASE, POSITION_KIND, STATISTIC, FIELD, TIME = "phase", "position", "statistic", "field", "time"
FINISHED = ("completed", "cancelled", "error", "failed")
# The state of a scan: the time of its last update, how often it changed, its document, when each slot
# was written (JSON), and when it leaves (milliseconds). One that has left has no document.
FOLDED = "scan_id bigint, us bigint, seq bigint, doc string, written string, expires bigint"
HELD_ROWS = 100_000
FOLDED_ROWS = 1_000

_EPOCH = datetime.datetime(1970, 1, 1)
_TICK = datetime.timedelta(microseconds=1)


# --- events as slots ----------------------------------------------------------------------------

def _slots(events: DataFrame, kind: str, name: Column, field: Column, value: Column) -> DataFrame:
    return events.select(
        F.col("scan_id").cast("bigint").alias("scan_id"), F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("seq").cast("bigint").alias("seq"), F.lit(kind).alias("kind"), name.alias("name"),
        field.alias("field"), value.alias("value"))


def phase_updates(events: DataFrame) -> DataFrame:
    """(scan_id, ts, seq, phase, status, progress, results_count): a phase's whole record."""
    record = F.struct(
        "status", F.col("progress").alias("progress_percentage"), "results_count")
    return _slots(events, PHASE, F.col("phase"), F.lit("record"),
                  F.to_json(record, {"ignoreNullFields": "false"}))


def position_updates(events: DataFrame) -> DataFrame:
    """(scan_id, ts, seq, phase, batch_index, batch_size, progress): a null is not written."""
    named = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in POSITION]))
    return _slots(events.withColumn("_p", named), POSITION_KIND, F.col("phase"), F.col("_p.field"),
                  F.col("_p.value")).where("value is not null")


def statistic_updates(events: DataFrame) -> DataFrame:
    """(scan_id, ts, seq, name, value): counters."""
    return _named(events, STATISTIC)


def field_updates(events: DataFrame) -> DataFrame:
    """(scan_id, ts, seq, name, value): status and templates_hash."""
    return _named(events, FIELD)


def _named(events: DataFrame, kind: str) -> DataFrame:
    value = F.to_json(F.struct("value"), {"ignoreNullFields": "false"})
    return _slots(events, kind, F.col("name"), F.lit("value"), value)


# --- which updates a document takes --------------------------------------------------------------

def document_names(documents: DataFrame) -> DataFrame:
    """What every loaded document takes: (scan_id, phases, statistics, fields)."""
    return _loaded(_with_status(documents)).drop("doc")


def _with_status(documents: DataFrame) -> DataFrame:
    """(scan_id, doc, load_status, phases, statistics, fields), not only of loaded documents.

    Many rows of documents fill a small file that few tasks would read: they are dealt out first.
    """
    fields = F.when(F.col("has_environment"), F.array(F.lit("status"), F.lit("templates_hash")))
    return load_checkpoints(documents.select("scan_id", "doc").repartition("scan_id", "doc")).select(
        "scan_id", "doc", "load_status", F.col("held_phases").alias("phases"),
        F.col("held_statistics").alias("statistics"),
        F.coalesce(fields, F.array(F.lit("status"))).alias("fields"))


def _loaded(documents: DataFrame) -> DataFrame:
    return documents.where("load_status = 'loaded'").drop("load_status")


def _stored_names(documents: DataFrame) -> DataFrame:
    """``document_names`` as a table. The status is tested on what was written: before that, the
    test would go below the columns and read every document a second time."""
    return _loaded(materialize(_with_status(documents).drop("doc"), "names"))


def _with_names(updates: DataFrame, names: DataFrame) -> DataFrame:
    """Updates with ``_held`` (the document takes it) and ``_loaded`` (there is a document).

    Many scans' names fill a small file, so that by its size it would be broadcast: the join is a
    merge, in which no scan's names are held by more than the tasks of its updates. Adaptive
    execution splits a hot scan's updates.
    """
    met = updates.join(
        names.withColumnRenamed("scan_id", "_scan").hint("merge"),
        F.col("scan_id") == F.col("_scan"), "left")
    kind, name = F.col("kind"), F.col("name")
    held = (
        F.when(kind.isin(PHASE, POSITION_KIND), F.array_contains("phases", name))
        .when(kind == STATISTIC, F.array_contains("statistics", name))
        .when(kind == FIELD, F.array_contains("fields", name)))
    return met.select(
        *updates.columns, F.coalesce(held, F.lit(False)).alias("_held"),
        F.col("_scan").isNotNull().alias("_loaded"))


def accepted_updates(updates: DataFrame, names: DataFrame) -> DataFrame:
    """Updates that a document takes, and the times of the other statistics of its scan."""
    time_only = (F.col("kind") == STATISTIC) & F.col("_loaded")
    return _with_names(updates, names).where(F.col("_held") | time_only).withColumns({
        "kind": F.when(F.col("_held"), F.col("kind")).otherwise(TIME),
        "value": F.when(F.col("_held"), F.col("value")).otherwise("null"),
    }).drop("_held", "_loaded")


def _last_written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last write of every slot among a task's rows, or among many of them: rows are held until
    half of ``HELD_ROWS`` are different slots."""
    held, rows = [], 0
    for frame in frames:
        held.append(frame)
        rows += len(frame)
        if rows >= HELD_ROWS:
            last = _last_of(held)
            held, rows = [last], len(last)
            if rows > HELD_ROWS // 2:
                yield last
                held, rows = [], 0
    if rows:
        yield _last_of(held)


def _last_of(frames: list[pd.DataFrame]) -> pd.DataFrame:
    frame = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
    return frame.sort_values(["ts", "seq"], kind="stable").drop_duplicates(
        ["scan_id", "kind", "name", "field"], keep="last")


def _by_scan(updates: DataFrame) -> DataFrame:
    """(scan_id, updates): a scan's last write of each slot as one JSON list."""
    def named(part: str) -> Column:  # of the times only the last one counts
        return F.when(F.col("kind") != TIME, F.col(part)).alias(part)

    write = F.struct(epoch_micros(F.col("ts")).alias("us"), "seq", "value")
    last = updates.select("scan_id", "kind", named("name"), named("field"), write.alias("_w")).groupBy(
        "scan_id", "kind", "name", "field").agg(F.max("_w").alias("_w"))
    listed = F.collect_list(F.struct("kind", "name", "field", "_w.us", "_w.seq", "_w.value"))
    return last.groupBy("scan_id").agg(F.to_json(listed).alias("updates"))


# --- the state of a scan -------------------------------------------------------------------------

def _time_of(text) -> datetime.datetime | None:
    try:
        time = datetime.datetime.fromisoformat(text)
    except (TypeError, ValueError):
        return None
    return time if time.tzinfo is None else time.astimezone(datetime.UTC).replace(tzinfo=None)


def _object(parent: dict, key: str) -> dict:
    if not isinstance(parent.get(key), dict):
        parent[key] = {}
    return parent[key]


def write_slot(document: dict, kind: str, name: str, field: str, value) -> None:
    """Put ``value`` where a reader of the document finds it."""
    if kind == PHASE:
        document["phases"][name].update(value)
    elif kind == POSITION_KIND:
        position = _object(document["phases"][name], "checkpoint")
        deeper = position.get("checkpoint")
        # A saved position may sit one level too deep; what is read there goes first.
        (deeper if isinstance(deeper, dict) and field in deeper else position)[field] = value
    elif kind == STATISTIC:
        document["statistics"][name] = value["value"]
    elif kind == FIELD and name == "templates_hash":
        document["environment"][name] = value["value"]
    elif kind == FIELD:
        document[name] = value["value"]


def _folded(doc: str, changes: int, written: str | None, updates: str) -> tuple[str, int, str, int]:
    """A document with its updates: (document, changes, written, time of its last update)."""
    document = json.loads(doc)
    times = {tuple(slot): tuple(when) for slot, when in json.loads(written or "[]")}
    latest = None
    for update in sorted(json.loads(updates), key=lambda update: (update["us"], update["seq"])):
        when = (update["us"], update["seq"])
        slot = (update["kind"], update.get("name"), update.get("field"))
        if slot[0] != TIME and when >= times.get(slot, when):
            write_slot(document, *slot, json.loads(update["value"]))
            times[slot] = when
        latest = update["us"]
    now, before = _EPOCH + latest * _TICK, _time_of(document.get("last_update"))
    if before is None or now > before:
        document["last_update"] = now.isoformat()
    else:
        now = before  # so that a later version of the document never seems older
    return (json.dumps(document, ensure_ascii=False), changes + 1,
            json.dumps(list(times.items()), ensure_ascii=False), (now - _EPOCH) // _TICK)


def _fold(now_ms: int, keep_finished_ms: int | None):
    """Fold rows (scan_id, seq, doc, written, updates) into rows of FOLDED. A scan that has left, or
    that the first start did not know, stays without document."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, FOLDED_ROWS) for whole in batches
                      for at in range(0, whole.num_rows, FOLDED_ROWS)):
            found = {name: [] for name in _FOLDED.names}
            for scan, seq, doc, written, listed in zip(*(
                    batch.column(name).to_pylist()
                    for name in ("scan_id", "seq", "doc", "written", "updates"))):
                us = expires = None
                if doc is not None:
                    doc, seq, written, us = _folded(doc, seq, written, listed)
                    if keep_finished_ms is not None and json.loads(doc).get("status") in FINISHED:
                        expires = now_ms + keep_finished_ms
                for name, value in zip(_FOLDED.names, (scan, us, seq, doc, written, expires)):
                    found[name].append(value)
            yield pa.RecordBatch.from_pydict(found, schema=_FOLDED)
    return fold


_FOLDED = pa.schema([
    ("scan_id", pa.int64()), ("us", pa.int64()), ("seq", pa.int64()), ("doc", pa.string()),
    ("written", pa.string()), ("expires", pa.int64())])


def _latest_folded(folded: DataFrame) -> DataFrame:
    row = F.struct("seq", "us", "doc", "written", "expires")
    return folded.groupBy("scan_id").agg(F.max(row).alias("_r")).select("scan_id", "_r.*")


def _without_left(folded: DataFrame, left: Column) -> DataFrame:
    """Nothing but the name and the time is kept of scans that have left."""
    return folded.withColumns({
        part: F.when(~F.coalesce(left, F.lit(False)), F.col(part)) for part in ("doc", "written")})


def _batch_ms(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """When a batch was planned, the same for every run of it."""
    ms = F.get_json_object("value", "$.batchTimestampMs").cast("bigint").alias("ms")
    return spark.read.text(f"{checkpoint}/offsets/{batch_id}").select(ms).where(
        "ms is not null").first()["ms"]


def _has_begun(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a batch is committed; a long stream has deleted the first commits."""
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(commits) and any(
        status.getPath().getName().isdigit() for status in files.listStatus(commits))


def stream_document_updates(
    updates: DataFrame, documents: DataFrame, out: str, checkpoint: str,
    trigger: dict | None = None, keep_finished_ms: int | None = None,
    merge_every: int = jobs.MERGE_EVERY,
) -> StreamingQuery:
    """Fold a stream of UPDATE rows into ``documents`` (scan_id, doc).

    ``documents`` are what the first start begins with; a restart goes on with the state of its
    checkpoint. Read with ``updated_documents``; updates of scans that have left the state are
    listed by ``closed_updates``. Rows without time or number are for ``stream_rejected_updates``.
    With ``keep_finished_ms`` a scan leaves that long after the batch that finished it or, finished,
    was its last.
    """
    spark = updates.sparkSession
    begun, turn, folded = f"{checkpoint}/documents", f"{checkpoint}/turn", f"{checkpoint}/folded"
    if _has_begun(spark, checkpoint):
        names = _stored_names(documents)
    else:
        stored = _with_status(documents).withColumn("scan_id", F.col("scan_id").cast("bigint"))
        stored.write.mode("overwrite").parquet(begun)
        names = _loaded(spark.read.schema(stored.schema).parquet(begun)).drop("doc")
    state, closed = f"{out}/documents", f"{out}/closed"
    jobs._ensure(spark, state, DOCUMENT_STATE)
    jobs._ensure(spark, closed, UPDATE)
    jobs._ensure(spark, folded, FOLDED)
    last = updates.where("scan_id is not null and ts is not null and seq is not null").mapInPandas(
        _last_written, UPDATE)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        load = jobs._load_name(session, checkpoint, batch_id)
        now = _batch_ms(session, checkpoint, batch_id)
        left = F.col("expires") <= now
        first = _loaded(session.read.schema(
            "scan_id bigint, doc string, load_status string").parquet(begun))
        nothing = F.lit(None)
        before = first.select(
            "scan_id", nothing.cast("bigint").alias("us"), F.lit(0).cast("bigint").alias("seq"),
            "doc", nothing.cast("string").alias("written"), nothing.cast("bigint").alias("expires"),
        ).unionByName(jobs._read(session, folded, FOLDED).where(F.col("load") != load).drop("load"))
        # By a merge, as the names are; one row for each scan of the batch comes out of it.
        met = _by_scan(batch).join(
            before.withColumnRenamed("scan_id", "_scan").hint("merge"),
            F.col("scan_id") == F.col("_scan"), "left")
        held = F.struct("seq", "us", "doc", "written", "expires")
        rows = met.groupBy("scan_id").agg(
            F.max(held).alias("_r"), F.first("updates").alias("updates")).select(
            "scan_id", "_r.*", "updates")
        _without_left(rows, left).select("scan_id", "seq", "doc", "written", "updates").mapInArrow(
            _fold(now, keep_finished_ms), FOLDED).write.mode("overwrite").parquet(turn)

        done = session.read.schema(FOLDED).parquet(turn)
        refused = done.where("doc is null").select("scan_id")
        if not refused.isEmpty():
            batch.join(refused.hint("merge"), "scan_id", "left_semi").select(*batch.columns).write.mode(
                "overwrite").parquet(f"{closed}/load={load}")
        done = done.where("doc is not null")
        jobs._write_state(
            done, folded, FOLDED, checkpoint, batch_id, merge_every,
            lambda earlier, new: _without_left(_latest_folded(earlier.unionByName(new)), left))
        ts = F.timestamp_add("MICROSECOND", F.col("us"), F.lit("1970-01-01").cast("timestamp_ntz"))
        jobs._write_state(
            done.select("scan_id", ts.alias("ts"), "seq", "doc"), state,
            DOCUMENT_STATE, checkpoint, batch_id, merge_every,
            lambda earlier, new: jobs.latest_documents(earlier.unionByName(new)))

    return (
        accepted_updates(last, names).writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ({"availableNow": True} if keep_finished_ms is None
                                else {"once": True}))).start())


def stream_rejected_updates(
    updates: DataFrame, documents: DataFrame, path: str, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """List every UPDATE row that no document takes, those without time or number too."""
    names = _stored_names(documents)
    untimed = F.col("ts").isNull() | F.col("seq").isNull()
    refused = _with_names(updates, names).where(~F.col("_held") | untimed)
    return (
        refused.drop("_held", "_loaded").writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start())


def updated_documents(documents: DataFrame, out: str) -> DataFrame:
    """(scan_id, doc) with the updates so far."""
    spark = documents.sparkSession
    now = jobs.current_checkpoints(spark, f"{out}/documents").select(
        "scan_id", F.col("doc").alias("_now"))
    return lookup_join(documents.repartition("scan_id", "doc"), now, ["scan_id"], "left").withColumn(
        "doc", F.coalesce("_now", "doc")).drop("_now")


def closed_updates(spark: SparkSession, out: str) -> DataFrame:
    """Updates that came after their finished scan had left the state."""
    return jobs._read(spark, f"{out}/closed", UPDATE).drop("load")
