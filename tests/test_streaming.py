"""Micro-batches, restarts and repeated batches give what one batch run gives."""

import datetime

import pytest

from exposure.operators import progress
from exposure.sources import hoststore
from exposure.streaming import jobs

T0 = datetime.datetime(2024, 1, 1)
LOG = "scan_id bigint, seq bigint, ts timestamp_ntz, status string"
EVENTS = (
    "scan_id bigint, seq bigint, ts timestamp_ntz, phase string, status string, progress int, "
    "results_count bigint"
)


def feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def source(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(query):
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"] > 0]


def test_hosts_three_batches_then_none(spark, tmp_path):
    schema, path = "scan_id bigint, host string", str(tmp_path / "in")
    for rows in ([(1, "a"), (1, "a"), (2, "a")], [(1, "a"), (1, "b")], [(2, "c"), (1, "b")]):
        feed(spark, path, rows, schema)
    store, progress_dir = str(tmp_path / "store"), str(tmp_path / "progress")

    def run():
        return finish(jobs.stream_new_hosts(source(spark, path, schema), store, progress_dir))

    assert len(run()) == 3
    assert len(run()) == 0
    stored = hoststore.read_host_store(spark, store)
    assert sorted(map(tuple, stored.collect())) == [(1, "a"), (1, "b"), (2, "a"), (2, "c")]
    feed(spark, path, [(1, "a"), (3, "z")], schema)
    assert len(run()) == 1
    assert hoststore.read_host_store(spark, store).count() == 5


def test_repeated_batch_replaces_itself(spark, tmp_path, monkeypatch):
    """A batch that failed after it wrote is run again and does not add its hosts twice."""
    schema, path, store = "scan_id bigint, host string", str(tmp_path / "in"), str(tmp_path / "store")
    feed(spark, path, [(1, "a"), (1, "b")], schema)
    write = jobs.write_host_load

    def write_and_fail(*args):
        write(*args)
        raise RuntimeError("lost after writing")

    monkeypatch.setattr(jobs, "write_host_load", write_and_fail)
    with pytest.raises(Exception, match="lost after writing"):
        jobs.stream_new_hosts(
            source(spark, path, schema), store, str(tmp_path / "p")).awaitTermination()
    assert hoststore.read_host_store(spark, store).count() == 2
    monkeypatch.setattr(jobs, "write_host_load", write)
    assert len(finish(jobs.stream_new_hosts(
        source(spark, path, schema), store, str(tmp_path / "p")))) == 1
    assert hoststore.read_host_store(spark, store).count() == 2


def test_new_checkpoint_keeps_older_loads(spark, tmp_path):
    schema, store = "scan_id bigint, host string", str(tmp_path / "store")
    for name in ("a", "b", "a"):
        path = str(tmp_path / f"in-{name}")
        feed(spark, path, [(1, name)], schema)
        finish(jobs.stream_new_hosts(
            source(spark, path, schema), store, str(tmp_path / f"p-{name}")))
    finish(jobs.stream_new_hosts(
        source(spark, str(tmp_path / "in-a"), schema), store, str(tmp_path / "p-again")))
    stored = hoststore.read_host_store(spark, store).collect()
    assert sorted(map(tuple, stored)) == [(1, "a"), (1, "b")]


def test_host_loads_merge_over_batches(spark, tmp_path):
    schema, path, store = "scan_id bigint, host string", str(tmp_path / "in"), tmp_path / "store"
    for i in range(9):
        feed(spark, path, [(1, f"h{i}"), (1, f"h{i // 2}"), (2, "same")], schema)
    batches = finish(jobs.stream_new_hosts(
        source(spark, path, schema), str(store), str(tmp_path / "p"), fan=2))
    assert len(batches) == 9
    rows = [tuple(r) for r in hoststore.read_host_store(spark, str(store)).collect()]
    assert sorted(rows) == sorted([(1, f"h{i}") for i in range(9)] + [(2, "same")])
    assert len([p for p in store.iterdir() if p.name.startswith("load=")]) <= 2


def test_phase_state_interrupted_equals_uninterrupted(spark, tmp_path):
    loads = [
        [(1, 1, T0, "alive_check", "pending", 0, 0), (1, 2, T0, "bad", "failed", 1, 1)],
        [(1, 3, T0, "alive_check", "completed", 100, 5), (2, 4, T0, "alive_check", "failed", 1, 0)],
        [(1, 0, T0, "alive_check", "in_progress", 7, 1)],
    ]
    expected = [(1, "alive_check", "completed", 100, 5), (2, "alive_check", "failed", 1, 0)]

    def state(folder):
        rows = jobs.current_phase_state(spark, folder).collect()
        return sorted((r["scan_id"], r["phase"], r["status"], r["progress"], r["results_count"]) for r in rows)

    whole, stepwise = str(tmp_path / "whole"), str(tmp_path / "stepwise")
    for rows in loads:
        feed(spark, str(tmp_path / "in"), rows, EVENTS)
    finish(jobs.stream_phase_state(source(spark, str(tmp_path / "in"), EVENTS), whole, str(tmp_path / "p1")))
    for rows in loads:
        feed(spark, str(tmp_path / "in2"), rows, EVENTS)
        finish(jobs.stream_phase_state(
            source(spark, str(tmp_path / "in2"), EVENTS), stepwise, str(tmp_path / "p2")))
    assert state(whole) == state(stepwise) == expected
    jobs.compact_phase_state(spark, whole, str(tmp_path / "compact"))
    assert state(str(tmp_path / "compact")) == expected


def test_transitions_carry_the_last_status_over_batches(spark, tmp_path):
    statuses = ["a", "a", "", "b", "b", "b", "a", "c", "c", "c"]
    rows = [
        (scan, i, T0 + datetime.timedelta(minutes=i), status)
        for i, status in enumerate(statuses) for scan in (1, 2)
    ]
    for start in range(0, len(rows), 7):
        feed(spark, str(tmp_path / "in"), rows[start:start + 7], LOG)
    out = str(tmp_path / "out")
    stream = source(spark, str(tmp_path / "in"), LOG)
    assert len(finish(jobs.stream_status_transitions(stream, out, str(tmp_path / "p")))) == 3
    batch = progress.status_transitions(spark.createDataFrame(rows, LOG))
    columns = ["scan_id", "seq", "previous_status", "status"]
    found = jobs.recorded_transitions(spark, out)
    assert sorted(found.select(columns).collect(), key=str) == sorted(
        batch.select(columns).collect(), key=str
    )
    counts = jobs.transition_counts(found).collect()
    assert {r["scan_id"]: r["transitions"] for r in counts} == {1: 4, 2: 4}

    # after compaction the stream goes on in the new folder, from the same checkpoint
    compact = str(tmp_path / "compact")
    jobs.compact_transitions(spark, out, compact)
    feed(spark, str(tmp_path / "in"), [
        (1, 90, T0 + datetime.timedelta(hours=1), "c"), (2, 91, T0 + datetime.timedelta(hours=1), "d"),
    ], LOG)
    finish(jobs.stream_status_transitions(stream, compact, str(tmp_path / "p")))
    added = jobs.recorded_transitions(spark, compact).filter("seq >= 90").select(columns).collect()
    assert [tuple(r) for r in added] == [(2, 91, "c", "d")]
    assert jobs.recorded_transitions(spark, compact).count() == 9


def test_documents_keep_the_last_write(spark, tmp_path):
    schema = "scan_id bigint, ts timestamp_ntz, seq bigint, doc string"
    for seq, doc in ((1, "a"), (3, "c"), (2, "b")):
        feed(spark, str(tmp_path / "in"), [(1, T0, seq, doc), (seq, T0, seq, doc)], schema)
    state = str(tmp_path / "state")
    finish(jobs.stream_checkpoints(source(spark, str(tmp_path / "in"), schema), state, str(tmp_path / "p")))
    expected = [(1, "c"), (2, "b"), (3, "c")]
    jobs.compact_checkpoints(spark, state, str(tmp_path / "compact"))
    for folder in (state, str(tmp_path / "compact")):
        rows = jobs.current_checkpoints(spark, folder).select("scan_id", "doc").collect()
        assert sorted(map(tuple, rows)) == expected


def test_hot_scan_in_a_stream(spark, tmp_path):
    rows = [
        (0, i, T0 + datetime.timedelta(seconds=i), "ab"[i // 3 % 2]) for i in range(300)
    ]
    for start in (0, 100, 200):
        feed(spark, str(tmp_path / "in"), rows[start:start + 100], LOG)
    out = str(tmp_path / "out")
    finish(jobs.stream_status_transitions(
        source(spark, str(tmp_path / "in"), LOG), out, str(tmp_path / "p"), max_group_rows=20))
    assert jobs.recorded_transitions(spark, out).count() == 100


def test_bounded_host_stream(spark, tmp_path):
    schema = "scan_id bigint, host string, ts timestamp"
    for day in (1, 2, 3):
        ts = datetime.datetime(2024, 1, day)
        feed(spark, str(tmp_path / "in"), [(1, "a", ts), (1, f"h{day}", ts)], schema)
    unique = jobs.new_hosts_within(source(spark, str(tmp_path / "in"), schema), "ts", "10 days")
    query = (
        unique.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "p")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["host"] for r in rows) == ["a", "h1", "h2", "h3"]


def test_late_rows_follow_what_arrived_before(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for seq, (minute, status) in enumerate([(10, "A"), (5, "B"), (11, "B"), (3, "B"), (12, "A")]):
        feed(spark, path, [(1, seq, T0 + datetime.timedelta(minutes=minute), status)], LOG)
    finish(jobs.stream_status_transitions(
        source(spark, path, LOG), out, str(tmp_path / "p"), merge_every=2))
    rows = jobs.recorded_transitions(spark, out).orderBy("seq").collect()
    assert [(r["seq"], r["previous_status"], r["status"]) for r in rows] == [
        (0, None, "A"), (1, "A", "B"), (4, "B", "A")]


def test_state_folders_do_not_grow_with_batches(spark, tmp_path):
    path, state = str(tmp_path / "in"), tmp_path / "state"
    for seq in range(7):
        feed(spark, path, [
            (seq % 3, seq, T0 + datetime.timedelta(minutes=seq), "alive_check", f"s{seq}", seq, seq)
        ], EVENTS)
    batches = finish(jobs.stream_phase_state(
        source(spark, path, EVENTS), str(state), str(tmp_path / "p"), merge_every=2))
    assert len(batches) == 7
    assert len([p for p in state.iterdir() if p.name.startswith("load=")]) <= 3
    rows = jobs.current_phase_state(spark, str(state)).orderBy("scan_id").collect()
    assert [(r["scan_id"], r["status"]) for r in rows] == [(0, "s6"), (1, "s4"), (2, "s5")]
