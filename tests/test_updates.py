"""Streams that fold updates into documents, and that put a log in the order of its times."""

import datetime
import json
import random

from pyspark.sql import functions as F

from exposure.operators import progress
from exposure.streaming import event_time, jobs, updates

T0 = datetime.datetime(2024, 1, 1)
LOG = "scan_id bigint, seq bigint, ts timestamp_ntz, status string"


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


def feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


DOCUMENT = {
    "scan_id": "s", "extra": {"kept": [1.5, None, "ü"]}, "last_update": "2024-01-01T00:10:00",
    "status": "new", "phases": {
        "alive_check": {"status": "pending", "progress_percentage": 0, "results_count": 0, "note": 1,
                        "checkpoint": {"batch_index": 1, "checkpoint": {"batch_index": 2}}},
        "odd": 5},
    "statistics": {"subdomains_found": 1}}


def phase(scan, minute, seq, name, status):
    return (scan, at(minute), seq, "phase", name, "record",
            json.dumps({"status": status, "progress_percentage": 7, "results_count": None}))


def position(scan, minute, seq, field, value):
    return (scan, at(minute), seq, "position", "alive_check", field, str(value))


def named(scan, minute, seq, kind, name, value):
    return (scan, at(minute), seq, kind, name, "value", json.dumps({"value": value}))


LOADS = [
    [phase(1, 5, 1, "alive_check", "late"), phase(1, 30, 3, "alive_check", "last"),
     position(1, 6, 2, "batch_index", 9), named(1, 90, 9, "statistic", "unknown", 3)],
    [phase(1, 20, 2, "alive_check", "older"), position(1, 5, 1, "batch_index", 8),
     position(1, 5, 1, "batch_size", 10), named(2, 1, 1, "field", "status", "x"),
     phase(1, 99, 9, "odd", "x"), named(1, 99, 9, "field", "templates_hash", "x")],
    [named(1, 40, 1, "field", "status", "b"), named(1, 40, 2, "field", "status", "a"),
     named(1, 3, 1, "statistic", "subdomains_found", 4), (1, None, 1, "field", "status", "value", "{}")],
    [named(1, 2, 1, "statistic", "subdomains_found", 5), phase(3, 1, 1, "alive_check", "x")],
]


def documents(spark):
    return spark.createDataFrame(
        [(1, json.dumps(DOCUMENT)), (2, "{broken"), (4, json.dumps(DOCUMENT))],
        "scan_id bigint, doc string")


def test_updates_in_any_order_over_a_restart(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, rows in enumerate(LOADS):
        feed(spark, path, rows, updates.UPDATE)
        if i % 2:
            stream = spark.readStream.schema(updates.UPDATE).parquet(path)
            updates.stream_document_updates(
                stream, documents(spark), out, str(tmp_path / "p")).awaitTermination()
            updates.stream_rejected_updates(
                stream, documents(spark), str(tmp_path / "no"), str(tmp_path / "q")).awaitTermination()
    found = {r["scan_id"]: r["doc"] for r in updates.updated_documents(documents(spark), out).collect()}
    assert found[2] == "{broken" and json.loads(found[4]) == DOCUMENT
    expected = json.loads(json.dumps(DOCUMENT))
    expected |= {"status": "a", "last_update": "2024-01-01T01:30:00"}
    expected["statistics"]["subdomains_found"] = 4
    expected["phases"]["alive_check"] |= {
        "status": "last", "progress_percentage": 7, "results_count": None}
    expected["phases"]["alive_check"]["checkpoint"] |= {
        "batch_size": 10, "checkpoint": {"batch_index": 9}}
    assert json.loads(found[1]) == expected
    refused = spark.read.schema(updates.UPDATE).parquet(str(tmp_path / "no")).collect()
    assert sorted((r["scan_id"], r["kind"], r["name"], r["seq"]) for r in refused) == [
        (1, "field", "status", 1), (1, "field", "templates_hash", 9), (1, "phase", "odd", 9),
        (1, "statistic", "unknown", 9), (2, "field", "status", 1), (3, "phase", "alive_check", 1)]


def plan_of(query, capsys):
    query.awaitTermination()
    capsys.readouterr()
    query.explain()
    return capsys.readouterr().out


def test_rejects_do_not_broadcast_the_names(spark, tmp_path, capsys):
    path = str(tmp_path / "in")
    feed(spark, path, LOADS[0], updates.UPDATE)
    text = plan_of(updates.stream_rejected_updates(
        spark.readStream.schema(updates.UPDATE).parquet(path), documents(spark),
        str(tmp_path / "no"), str(tmp_path / "q")), capsys)
    assert "Broadcast" not in text and "SortMergeJoin" in text and "Generate" not in text
    assert "AdaptiveSparkPlan" in text  # which splits a hot scan's rows


def test_updates_do_not_broadcast_the_names(spark, tmp_path, capsys):
    path = str(tmp_path / "in")
    feed(spark, path, LOADS[0], updates.UPDATE)
    text = plan_of(updates.stream_document_updates(
        spark.readStream.schema(updates.UPDATE).parquet(path), documents(spark),
        str(tmp_path / "out"), str(tmp_path / "p")), capsys)
    assert "Broadcast" not in text and "SortMergeJoin" in text and "Generate" not in text
    # A scan's rows are few before they meet its names.
    assert text.index("SortMergeJoin") < text.index("MapInPandas")


def test_finished_scans_leave_the_state(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(rows):
        feed(spark, path, rows, updates.UPDATE)
        updates.stream_document_updates(
            spark.readStream.schema(updates.UPDATE).parquet(path), documents(spark), out,
            str(tmp_path / "p"), keep_finished_ms=1).awaitTermination()

    run([named(1, 50, 1, "field", "status", "completed"), named(4, 50, 1, "field", "status", "on")])
    run([named(4, 51, 2, "field", "status", "more")])  # the timer of scan 1 is due
    run([named(1, 60, 3, "field", "status", "again"), named(4, 60, 3, "field", "status", "end")])
    found = updates.updated_documents(documents(spark), out).where("scan_id <> 2").collect()
    assert {r["scan_id"]: json.loads(r["doc"])["status"] for r in found} == {1: "completed", 4: "end"}
    assert [(r["scan_id"], r["seq"]) for r in updates.closed_updates(spark, out).collect()] == [(1, 3)]


def test_every_task_sends_one_row_for_a_slot():
    import pandas as pd
    rows = pd.DataFrame(
        [named(1, i % 50, i, "statistic", "a", i) for i in range(1000)],
        columns=["scan_id", "ts", "seq", "kind", "name", "field", "value"])
    (last,) = updates._last_written(iter([rows]))
    assert len(last) == 1 and last["seq"].iloc[0] == 999


def test_a_task_holds_many_frames_of_one_slot_and_sends_on_many_slots(monkeypatch):
    import pandas as pd
    monkeypatch.setattr(updates, "HELD_ROWS", 1000)
    columns = ["scan_id", "ts", "seq", "kind", "name", "field", "value"]

    def frames(scans):
        return (pd.DataFrame([named(n % scans, n // 7, n, "statistic", "a", n)
                              for n in range(at, at + 100)], columns=columns)
                for at in range(0, 5000, 100))

    (last,) = updates._last_written(frames(3))
    assert sorted(last["seq"]) == [4997, 4998, 4999]
    several = list(updates._last_written(frames(4000)))
    assert len(several) > 1 and max(map(len, several)) <= 1000
    assert {n for frame in several for n in frame["seq"]} >= set(range(1000, 5000))


def run_updates(spark, tmp_path, rows, docs=None, **options):
    path = str(tmp_path / "in")
    feed(spark, path, rows, updates.UPDATE)
    query = updates.stream_document_updates(
        spark.readStream.schema(updates.UPDATE).parquet(path), docs or documents(spark),
        str(tmp_path / "out"), str(tmp_path / "p"), **options)
    query.awaitTermination()
    return query


def folded(spark, tmp_path):
    return jobs._read(spark, str(tmp_path / "p" / "folded"), updates.FOLDED)


def test_only_scans_with_updates_enter_the_state(spark, tmp_path, capsys):
    text = plan_of(run_updates(spark, tmp_path, [
        named(1, 40, 1, "field", "status", "b"),
        *[named(1, 50, n, "statistic", f"unknown{n}", 1) for n in range(20)]]), capsys)
    assert "TransformWithState" not in text
    row, = folded(spark, tmp_path).collect()
    assert row["scan_id"] == 1 and [slot for slot, _ in json.loads(row["written"])] == [
        ["field", "status", "value"]]
    assert json.loads(row["doc"])["last_update"] == "2024-01-01T00:50:00"


def test_a_restart_goes_on_with_the_documents_of_the_first_start(spark, tmp_path):
    run_updates(spark, tmp_path, [named(1, 40, 1, "field", "status", "b")])
    other = spark.createDataFrame(
        [(n, json.dumps(DOCUMENT | {"extra": 0})) for n in (1, 4, 5)], "scan_id bigint, doc string")
    run_updates(spark, tmp_path, [named(n, 50, n, "field", "status", "c") for n in (1, 4, 5)], other)
    out = str(tmp_path / "out")
    docs = {r["scan_id"]: json.loads(r["doc"]) for r in updates.updated_documents(other, out).collect()}
    assert [docs[n]["extra"] for n in (1, 4, 5)] == [DOCUMENT["extra"], DOCUMENT["extra"], 0]
    assert [docs[n]["status"] for n in (1, 4, 5)] == ["c", "c", "new"]
    assert [(r["scan_id"], r["seq"]) for r in updates.closed_updates(spark, out).collect()] == [(5, 5)]


def test_a_repeated_batch_folds_its_updates_once(spark, tmp_path, monkeypatch):
    write, failures = jobs._write_state, ["folded", "documents"]

    def write_and_fail(state, path, *rest):
        write(state, path, *rest)
        if path.rsplit("/", 1)[-1] in failures:
            failures.remove(path.rsplit("/", 1)[-1])
            raise RuntimeError("lost after writing")

    monkeypatch.setattr(jobs, "_write_state", write_and_fail)
    rows = [named(1, 40, 1, "field", "status", "b")]
    for _ in range(3):
        try:
            run_updates(spark, tmp_path, rows)
        except Exception as error:
            assert "lost after writing" in str(error)
        rows = []
    assert not failures
    run_updates(spark, tmp_path, [named(1, 30, 2, "field", "status", "a")])
    changes = folded(spark, tmp_path).where("doc is not null").select("seq").collect()
    assert sorted(r["seq"] for r in changes) == [1, 2]
    now = updates.updated_documents(documents(spark), str(tmp_path / "out")).where("scan_id = 1")
    assert json.loads(now.first()["doc"])["status"] == "b"


def test_a_merge_keeps_the_state_and_forgets_what_has_left(spark, tmp_path):
    options = {"keep_finished_ms": 1, "merge_every": 2}
    run_updates(spark, tmp_path, [
        named(1, 50, 1, "field", "status", "completed"), named(4, 50, 1, "field", "status", "on")], **options)
    for n in (2, 3, 4):
        run_updates(spark, tmp_path, [named(4, 50 - n, n, "field", "status", "older"),
                                      named(1, 60, n, "field", "status", "again")], **options)
    rows = {r["scan_id"]: r for r in folded(spark, tmp_path).where("load not like '%3'").collect()}
    assert rows[1]["doc"] is None and rows[1]["written"] is None and rows[4]["seq"] == 3
    out = str(tmp_path / "out")
    docs = updates.updated_documents(documents(spark), out).where("scan_id <> 2").collect()
    assert {r["scan_id"]: json.loads(r["doc"])["status"] for r in docs} == {1: "completed", 4: "on"}
    assert sorted((r["scan_id"], r["seq"]) for r in updates.closed_updates(spark, out).collect()) == [
        (1, 2), (1, 3), (1, 4)]


# --- order of event time -------------------------------------------------------------------------

def test_shuffled_rows_give_the_batch_result(spark, tmp_path):
    rng = random.Random(3)
    log = [(scan, i, at(i), rng.choice(["", "a", "b"])) for i in range(200) for scan in (0, 0, 1)]
    log = [(scan, n, ts, status) for n, (scan, _, ts, status) in enumerate(log)]
    loads = [[] for _ in range(6)]
    for row in log:
        minute = (row[2] - T0).total_seconds() / 60
        loads[min(5, int((minute + rng.random() * 30) / 40))].append(row)
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in loads:
        feed(spark, path, rows, LOG)
        event_time.stream_transitions_in_order(
            spark.readStream.schema(LOG).parquet(path), out, str(tmp_path / "p"), "75 minutes",
            max_group_rows=20).awaitTermination()
    waiting = event_time.transitions(spark, out).count()
    event_time.release(spark, out)
    batch = progress.status_transitions(spark.createDataFrame(log, LOG))
    columns = ["scan_id", "seq", "ts", "previous_status", "status"]
    found = event_time.transitions(spark, out).select(columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, batch.select(columns).collect()))
    assert 0 < waiting < found.count()
    assert event_time.late_rows(spark, out).count() == 0
    assert len([p for p in (tmp_path / "out" / "waiting").iterdir() if "load=" in p.name]) <= 3


def test_late_rows_are_listed_and_a_released_log_goes_on(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(*rows):
        feed(spark, path, rows, LOG)
        event_time.stream_transitions_in_order(
            spark.readStream.schema(LOG).parquet(path), out, str(tmp_path / "p"), "10 minutes",
        ).awaitTermination()

    run((1, 1, at(0), "a"), (1, 2, at(30), "b"), (2, 3, None, "a"))
    run((1, 4, at(19), "x"), (1, 5, at(20), "c"), (1, 6, at(31), "b"))
    event_time.release(spark, out)
    assert sorted(r["seq"] for r in event_time.transitions(spark, out).collect()) == [1, 2, 5]
    late = event_time.late_rows(spark, out).collect()
    assert sorted((r["seq"], r["watermark"]) for r in late) == [(3, None), (4, at(20))]
    run((1, 7, at(25), "d"), (1, 8, at(60), "e"))
    event_time.release(spark, out)
    found = event_time.transitions(spark, out).orderBy("ts").collect()
    assert [(r["seq"], r["previous_status"], r["status"]) for r in found] == [
        (1, None, "a"), (5, "a", "c"), (7, "c", "d"), (2, "d", "b"), (8, "b", "e")]


def test_a_repeated_batch_replaces_itself(spark, tmp_path, monkeypatch):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, path, [(1, i, at(i), "ab"[i % 2]) for i in range(30)], LOG)
    stream = spark.readStream.schema(LOG).parquet(path)
    write, failures = event_time._write, ["clock", "last", "transitions"]

    def write_and_fail(df, folder, part, load):
        write(df, folder, part, load)
        if part in failures:
            failures.remove(part)
            raise RuntimeError("lost after writing")

    monkeypatch.setattr(event_time, "_write", write_and_fail)
    for _ in range(4):
        try:
            event_time.stream_transitions_in_order(
                stream, out, str(tmp_path / "p"), "5 minutes").awaitTermination()
        except Exception as error:
            assert "lost after writing" in str(error)
    assert not failures
    event_time.release(spark, out)
    assert event_time.transitions(spark, out).count() == 30
    assert jobs.transition_counts(event_time.transitions(spark, out)).select(
        F.max("transitions")).first()[0] == 30
