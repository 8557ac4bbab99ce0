"""Small hand-written rows, one group per semantic trap."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from exposure.functions import severity as sev
from exposure.functions import text, versions
from exposure.functions.documents import epoch_seconds, scan_identity
from exposure.operators import (
    checkpoints, findings, fleet, hygiene, inventory, notify, progress,
)
from exposure.sources import readers

T0 = datetime.datetime(2024, 1, 31)


def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


def values(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("t"))).collect()]


def table(df):
    return sorted(tuple(r) for r in df.collect())


# --- text ------------------------------------------------------------------------------------

@pytest.mark.parametrize("host, valid", [
    ("a.example.com", True), ("-a.com", False), ("a-.com", False), ("localhost", False),
    ("a.b.c1", False), ("a_b.com", False), ("a.example.com:8443", False),
    ("https://a.example.com/x", True), ("HTTP://a.example.com", False),
    ("a" * 64 + ".com", False), ("a" * 63 + ".com", True), ("x." + "a" * 70, True),
    ("a..com", False), (".a.com", False), ("a.com.", False), ("", False), ("a.com\n", False),
    ("https://user@a.com/", False), ("http://a.com?x=1", True), ("a--b.co", True),
    (".".join(["a"] * 20_000) + ".com", True),
])
def test_valid_host(spark, host, valid):
    assert values(spark, [host], text.valid_host) == [valid]


def test_ansi_removal(spark):
    assert values(spark, ["\x1b[31;1mred\x1b[0m x\x1bM[200]"], text.without_ansi) == ["red x[200]"]


def test_trim_strips_every_white_space(spark):
    assert values(spark, ["\t a b\r\n ", " x\x1c", "  "], text.stripped) == ["a b", "x", ""]
    assert values(spark, ["\t ", "", " x", "x"], text.not_blank) == [False, False, True, True]


def test_severity_goes_by_precedence(spark):
    lines = ["x [info] y [Critical]", "no tag", "[highest]", "[LOW]", "[medium][high]"]
    assert values(spark, lines, sev.severity_of) == ["critical", None, None, "low", "high"]


def test_version_texts(spark):
    outputs = [
        "Current Version: v2.9.1", "tool 1.2.3", "dev build", "current version: 1.0.0 v9.9.9",
        "v0.1.2 then Current Version: v2.0.0", " first line \nsecond",
    ]
    assert values(spark, outputs, versions.version_from_text) == [
        "2.9.1", "1.2.3", "dev build", "1.0.0", "2.0.0", "first line",
    ]
    assert values(spark, ["v1.2", "vv3", "x"], versions.version_of_tag) == ["1.2", "3", "x"]


def test_labels(spark):
    assert values(spark, ["alive_check"], text.title_label) == ["Alive Check"]
    assert values(spark, ["in_progress", "failed"], text.title_status) == ["In_Progress", "Failed"]


def test_sizes_in_megabytes(spark):
    sizes = values(spark, ["1572864"], lambda c: text.megabytes(c.cast("bigint")))
    assert sizes == [1.5]


def test_scan_identity(spark):
    import hashlib
    expected = "d.com-1706659200-" + hashlib.md5(b"d.com-1706659200").hexdigest()[:8]
    assert values(spark, ["d.com"], lambda c: scan_identity(c, now())) == [expected]
    assert values(spark, ["x"], lambda c: epoch_seconds(now())) == [1706659200]


# --- findings --------------------------------------------------------------------------------

def tagged(spark):
    rows = [(1, "a [high]"), (1, "b"), (2, "c [info]")]
    return findings.tag_severity(spark.createDataFrame(rows, "scan_id bigint, line string"))


def test_empty_severity_request_keeps_all(spark):
    assert findings.filter_severity(tagged(spark), []).count() == 3
    requests = spark.createDataFrame(
        [(1, ["high"]), (2, [])], "scan_id bigint, severities array<string>"
    )
    assert table(findings.filter_severity_requests(tagged(spark), requests).select("line")) == [
        ("a [high]",), ("c [info]",),
    ]
    none = spark.createDataFrame([(1, None)], "scan_id bigint, severities array<string>")
    assert findings.filter_severity_requests(tagged(spark), none).count() == 3


def test_severity_requests_are_checked_case_sensitively(spark):
    requests = spark.createDataFrame(
        [(1, ["high", "low"]), (2, ["High"]), (3, [])], "scan_id bigint, severities array<string>"
    )
    checked = findings.check_severity_requests(requests)
    assert table(checked.select("scan_id", "is_valid")) == [(1, True), (2, False), (3, True)]


def test_shared_output_file_counts_once(spark):
    records = spark.createDataFrame(
        [(1, 0, "f1", None), (1, 1, "f1", None), (1, 2, None, "boom"), (1, 3, "gone", None)],
        "scan_id bigint, batch_id int, path string, error string",
    )
    inventory_rows = spark.createDataFrame([("f1", 9), ("empty", 0)], "path string, length bigint")
    lines = spark.createDataFrame(
        [("f1", 1, "x [low]"), ("f1", 2, " "), ("f1", 3, "y"), ("gone", 1, "z")],
        "path string, seq bigint, line string",
    )
    kept = findings.consolidate_findings(records, inventory_rows, lines)
    assert table(kept) == [(1, 0, "f1", 1, "x [low]"), (1, 0, "f1", 3, "y")]
    totals = findings.consolidation_totals(records, inventory_rows, lines).collect()[0]
    assert totals.asDict() == {
        "scan_id": 1, "batches": 4, "batch_errors": 1, "files": 1, "findings": 2,
    }


def test_rebuild_only_reported_but_empty_scans_and_only_once(spark):
    state = spark.createDataFrame([(1, 2), (2, 1), (3, 0)], "scan_id bigint, vulnerabilities bigint")
    results = spark.createDataFrame([(2, "kept [low]")], "scan_id bigint, line string")
    batches = spark.createDataFrame(
        [(1, "a [high]"), (1, "  "), (1, "b"), (2, "other"), (3, "c")], "scan_id bigint, line string"
    )
    rebuilt = findings.rebuild_empty_results(state, results, batches)
    assert table(rebuilt) == [(1, "a [high]"), (1, "b")]
    again = findings.rebuild_empty_results(state, results.unionByName(rebuilt), batches)
    assert again.count() == 0


def test_preview_counts_the_rest(spark):
    lines = spark.range(13).select(F.lit(1).alias("scan_id"), "id", F.col("id").cast("string").alias("line"))
    rows = findings.finding_preview(lines, ["id"]).orderBy("position").collect()
    assert [r["line"] for r in rows] == [str(i) for i in range(10)]
    assert {r["more_findings"] for r in rows} == {3}


# --- inventory -------------------------------------------------------------------------------

def test_worklist_ignores_order(spark):
    def hosts(names):
        return spark.createDataFrame([(1, n) for n in names], "scan_id bigint, host string")
    for order in ("abcd", "dcba"):
        left = inventory.resume_worklist(hosts(order), hosts("bb"))
        assert table(left) == [(1, "a"), (1, "c"), (1, "d")]


def test_bulk_load_then_append(spark):
    schema = "scan_id bigint, host string"
    store = inventory.bulk_load_hosts(spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], schema))
    incoming = spark.createDataFrame([(1, "b"), (1, "c"), (1, "c")], schema)
    fresh = inventory.append_new_hosts(store, incoming)
    assert table(fresh) == [(1, "c")]
    both = store.unionByName(fresh)
    assert table(both) == [(1, "a"), (1, "b"), (1, "c")]
    assert inventory.append_new_hosts(both, incoming).count() == 0


def test_alive_by_host_not_by_text(spark):
    hosts = spark.createDataFrame(
        [(1, "a.com"), (1, "http://b.com/x"), (1, "c.com")], "scan_id bigint, host string"
    )
    probes = spark.createDataFrame(
        [(1, "https://a.com [200]"), (1, "https://b.com:8443 [301]"), (2, "https://c.com [200]")],
        "scan_id bigint, line string",
    )
    assert table(inventory.alive_hosts(hosts, probes)) == [(1, "a.com"), (1, "http://b.com/x")]
    assert table(inventory.dead_hosts(hosts, probes)) == [(1, "c.com")]


def test_cache_freshness_and_empty_results(spark):
    ages = {"a": 86_399, "b": 86_400, "c": None, "d": 10}
    key = inventory.cache_key(F.array(F.lit("run"), F.col("name")))
    cache = spark.createDataFrame(
        [(n, None if age is None else T0 - datetime.timedelta(seconds=age), 1,
          "" if n == "d" else "x") for n, age in ages.items()],
        "name string, ts timestamp_ntz, seq bigint, result string",
    ).withColumn("cache_key", key).drop("name")
    requests = spark.createDataFrame([(n,) for n in [*ages, "e"]], "name string").select(
        "name", F.array(F.lit("run"), F.col("name")).alias("argv")
    )
    hits = inventory.cache_lookup(requests, cache, now())
    assert table(hits.select("name", "is_hit", "result")) == [
        ("a", True, "x"), ("b", False, None), ("c", False, None), ("d", False, None),
        ("e", False, None),
    ]
    assert not any(r["is_hit"] for r in inventory.cache_lookup(
        requests, cache, now(), use_cache=False).collect())
    assert inventory.cache_misses(requests, cache, now()).count() == 4


# --- progress --------------------------------------------------------------------------------

def test_batches_of_three(spark):
    hosts = spark.createDataFrame([(1, c) for c in "gfedcba"], "scan_id bigint, host string")
    rows = progress.assign_batches(hosts, 3).orderBy("host").collect()
    assert [r["batch_id"] for r in rows] == [0, 0, 0, 1, 1, 1, 2]


def log(spark, rows, columns):
    return spark.createDataFrame(
        [(1, i, T0 + datetime.timedelta(seconds=i), v) for i, v in enumerate(rows)],
        f"scan_id bigint, seq bigint, ts timestamp_ntz, {columns}",
    )


def test_increments(spark):
    rows = progress.progress_increments(log(spark, [3, 2, 7, 7], "n bigint"), "n")
    assert [r["increment"] for r in rows.orderBy("seq").collect()] == [3, 0, 4, 0]
    negative = progress.progress_increments(log(spark, [-5, 2], "n bigint"), "n")
    assert [r["increment"] for r in negative.orderBy("seq").collect()] == [0, 2]


def test_transitions_skip_empty_status(spark):
    rows = progress.status_transitions(log(spark, ["a", "", "a", "b", "b", "a"], "status string"))
    assert [(r["seq"], r["previous_status"], r["status"]) for r in rows.orderBy("seq").collect()] == [
        (0, None, "a"), (3, "a", "b"), (5, "b", "a"),
    ]


def test_percent_divides_first(spark):
    batches = spark.range(100).select(
        F.lit(1).alias("scan_id"), F.col("id").alias("batch_id"), F.lit(2).alias("n")
    )
    row = progress.batch_progress(batches).filter("batch_id = 28").first()
    assert (row["progress_after"], row["progress_before"], row["results_count"]) == (
        int(29 / 100 * 100), int(28 / 100 * 100), 58,
    )


def test_duration_texts(spark):
    state = spark.createDataFrame([(1, 59.96), (2, 60.0), (3, 12.34)], "scan_id bigint, s double")
    state = state.select("scan_id", (F.lit(1000.0) - F.col("s")).alias("start_time"))
    rows = progress.scan_durations(state, 1000.0).orderBy("scan_id").collect()
    assert [r["duration_text"] for r in rows] == ["60.0s", "1.0m", "12.3s"]


def test_memory_documents_are_bounded_and_whole(spark):
    samples = spark.range(25).select(
        F.lit(1).alias("scan_id"), F.col("id").alias("seq"), now().alias("ts"),
        F.col("id").cast("string").alias("label"), F.col("id").cast("double").alias("memory_mb"),
    )
    rows = progress.memory_documents(samples, 10).orderBy("part").collect()
    assert [len(r["measurements"]) for r in rows] == [10, 10, 5]
    assert [m["label"] for r in rows for m in r["measurements"]] == [str(i) for i in range(25)]
    assert {r["peak_usage"] for r in rows} == {24.0}
    assert rows[0]["measurements"][0]["timestamp"] == 1706659200.0


# --- documents -------------------------------------------------------------------------------

PHASE = {"status": "pending", "progress_percentage": 0, "results_count": 0}
FULL = {
    "scan_id": "s", "domain": "d.com", "start_time": "t", "last_update": "t",
    "status": "in_progress",
    "phases": {"subdomain_enumeration": PHASE, "alive_check": PHASE, "vulnerability_scan": PHASE},
    "statistics": {"subdomains_found": 0, "alive_subdomains": 0, "vulnerabilities_found": 0},
    "environment": {"tool_versions": {}, "templates_hash": ""},
}


def docs(spark, *documents):
    rows = [(i, d if isinstance(d, str) else json.dumps(d), "d.com") for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "scan_id bigint, doc string, expected_domain string")


def without(document, *path):
    copy = json.loads(json.dumps(document))
    inner = copy
    for key in path[:-1]:
        inner = inner[key]
    del inner[path[-1]]
    return copy


def issues(spark, *documents):
    rows = checkpoints.checkpoint_issues(docs(spark, *documents)).orderBy("scan_id").collect()
    return [r["issues"] for r in rows]


def test_position_is_read_at_both_depths(spark):
    deep = {**FULL, "phases": {"alive_check": {**PHASE, "checkpoint": {"checkpoint": {"batch_index": 4}}}}}
    flat = {**FULL, "phases": {"alive_check": {**PHASE, "checkpoint": {"batch_index": 4}}}}
    rows = checkpoints.phase_record(
        checkpoints.load_checkpoints(docs(spark, deep, flat)), "alive_check"
    ).collect()
    assert [r["checkpoint"]["batch_index"] for r in rows] == [4, 4]


def test_load_status(spark):
    loaded = checkpoints.load_checkpoints(
        docs(spark, FULL, '{"scan_id": "broken', without(FULL, "scan_id"), "[1]")
        .unionByName(spark.createDataFrame(
            [(9, None, "d.com")], "scan_id bigint, doc string, expected_domain string"))
    )
    assert [r["load_status"] for r in loaded.orderBy("scan_id").collect()] == [
        "loaded", "corrupt", "no_scan_id", "corrupt", "missing",
    ]


def test_issues_stop_at_the_top_level(spark):
    broken_twice = without(without(FULL, "domain"), "phases", "alive_check")
    assert issues(
        spark, FULL, broken_twice, without(FULL, "phases", "alive_check", "results_count"),
        {**FULL, "domain": "other.com"}, "{", {**FULL, "domain": None},
        {**FULL, "statistics": {}, "environment": {}},
    ) == [
        [], ["Missing required field: domain"],
        ["Missing results count in phase: alive_check"],
        ["Domain mismatch: other.com (checkpoint) vs d.com (current)"],
        ["Checkpoint not initialized"],
        ["Domain mismatch: None (checkpoint) vs d.com (current)"],
        ["Missing statistic: subdomains_found", "Missing statistic: alive_subdomains",
         "Missing statistic: vulnerabilities_found", "Missing tool versions in environment"],
    ]


def repaired(spark, *documents):
    rows = checkpoints.repair_checkpoints(docs(spark, *documents), now()).orderBy("scan_id")
    return rows.collect()


def test_repair_keeps_present_phases_and_unknown_keys(spark):
    damaged = {
        "scan_id": "s", "extra": {"deep": [1, 2.5, None]}, "domain": None,
        "phases": {"alive_check": {"status": "failed", "note": "x"}},
    }
    row = repaired(spark, damaged)[0]
    fixed = json.loads(row["doc"])
    assert row["is_repaired"]
    assert fixed["phases"]["alive_check"] == {"status": "failed", "note": "x"}
    assert fixed["phases"]["subdomain_enumeration"] == PHASE == fixed["phases"]["vulnerability_scan"]
    assert fixed["extra"] == {"deep": [1, 2.5, None]}
    assert fixed["domain"] is None
    assert fixed["start_time"] == fixed["last_update"] == "2024-01-31T00:00:00"
    assert fixed["status"] == "in_progress"
    assert fixed["statistics"] == FULL["statistics"]
    assert fixed["environment"] == FULL["environment"]
    assert row["added"] == [
        "start_time", "last_update", "status", "statistics", "environment",
        "subdomain_enumeration", "vulnerability_scan",
    ]


def test_repair_fills_identity_and_leaves_unreadable_documents(spark):
    rows = repaired(spark, {"other": 1}, "{", {**FULL, "phases": [1]})
    assert json.loads(rows[0]["doc"])["scan_id"].startswith("d.com-1706659200-")
    assert json.loads(rows[0]["doc"])["domain"] == "d.com"
    assert (rows[1]["is_repaired"], rows[1]["doc"], rows[1]["added"]) == (False, "{", [])
    assert (rows[2]["is_repaired"], json.loads(rows[2]["doc"])["phases"]) == (False, [1])


def test_repair_is_idempotent_and_does_not_fix_everything(spark):
    inner = without(without(FULL, "phases", "alive_check", "status"), "statistics", "alive_subdomains")
    once = checkpoints.repair_checkpoints(docs(spark, inner, {"other": 1}), now())
    twice = checkpoints.repair_checkpoints(once, now())
    assert [json.loads(r["doc"]) for r in once.orderBy("scan_id").collect()] == [
        json.loads(r["doc"]) for r in twice.orderBy("scan_id").collect()
    ]
    left = checkpoints.checkpoint_issues(once).orderBy("scan_id").collect()
    assert left[0]["issues"] == [
        "Missing status in phase: alive_check", "Missing statistic: alive_subdomains",
    ]
    assert left[1]["issues"] == []


def test_compaction_drops_positions_of_completed_phases_only(spark):
    document = {**FULL, "phases": {
        "subdomain_enumeration": {**PHASE, "status": "completed", "checkpoint": {"batch_index": 1}},
        "alive_check": {**PHASE, "checkpoint": {"batch_index": 2}},
        "other": 5,
    }}
    row = checkpoints.compact_checkpoints(docs(spark, document)).first()
    phases = json.loads(row["doc"])["phases"]
    assert phases["subdomain_enumeration"] == {**PHASE, "status": "completed"}
    assert phases["alive_check"] == {**PHASE, "checkpoint": {"batch_index": 2}}
    assert phases["other"] == 5
    assert row["size_kb"] == f"{len(row['doc']) / 1024:.1f}"


def test_untouched_documents_keep_their_text(spark):
    texts = [json.dumps(FULL, indent=2), "{", json.dumps({**FULL, "phases": {"x": 1}}, indent=1)]
    rows = docs(spark, *texts)
    compacted = checkpoints.compact_checkpoints(rows).orderBy("scan_id").collect()
    assert [r["doc"] for r in compacted] == texts
    fixed = checkpoints.repair_checkpoints(rows, now()).orderBy("scan_id").collect()
    assert [r["doc"] == t for r, t in zip(fixed, texts)] == [True, True, False]
    assert [r["is_repaired"] for r in fixed] == [True, False, True]


def test_null_position_of_a_completed_phase_is_dropped(spark):
    document = {**FULL, "phases": {"alive_check": {**PHASE, "status": "completed", "checkpoint": None}}}
    row = checkpoints.compact_checkpoints(docs(spark, document)).first()
    assert json.loads(row["doc"])["phases"] == {"alive_check": {**PHASE, "status": "completed"}}


def test_pending_phases(spark):
    document = {**FULL, "phases": {"subdomain_enumeration": {**PHASE, "status": "completed"}}}
    loaded = checkpoints.load_checkpoints(docs(spark, document))
    rows = checkpoints.pending_phases(loaded).orderBy("position").collect()
    assert [(r["phase"], r["status"]) for r in rows] == [
        ("alive_check", None), ("vulnerability_scan", None),
    ]
    assert checkpoints.pending_phases(loaded, resuming=False).count() == 3


BROKEN = [
    '{"scan_id":"a","domain":"d"} trailing', '{"scan_id":"a"}}', '{"scan_id":"a"}]',
    '{"scan_id":"a","scan_id":"b"}', '{"scan_id":"a"},{}', "[1]", "", "5",
]


def test_broken_documents_stay_as_they_are(spark):
    rows = spark.createDataFrame(
        [(i, d, "d.com") for i, d in enumerate([*BROKEN, "{}", ' {"scan_id":"a"} '])],
        "scan_id bigint, doc string, expected_domain string")
    status = [r["load_status"] for r in checkpoints.load_checkpoints(rows).orderBy("scan_id").collect()]
    assert status == ["corrupt"] * len(BROKEN) + ["no_scan_id", "loaded"]
    issues = [r["issues"] for r in checkpoints.checkpoint_issues(rows).orderBy("scan_id").collect()]
    assert issues[:-1] == [["Checkpoint not initialized"]] * (len(BROKEN) + 1)
    fixed = checkpoints.repair_checkpoints(rows, now()).orderBy("scan_id").collect()
    assert [r["doc"] for r in fixed[:-1]] == [*BROKEN, "{}"]
    assert [r["is_repaired"] for r in fixed] == [False] * (len(BROKEN) + 1) + [True]


def test_one_odd_phase_leaves_the_others(spark):
    document = {**FULL, "phases": {
        "alive_check": {**PHASE, "status": "completed", "progress_percentage": "90"},
        "vulnerability_scan": 5,
    }}
    row = checkpoints.load_checkpoints(docs(spark, document)).first()
    assert row["phases"]["alive_check"]["status"] == "completed"
    assert row["phases"]["alive_check"]["progress_percentage"] == 90
    assert row["phases"]["vulnerability_scan"]["status"] is None
    assert row["held_phases"] == ["alive_check"]
    pending = checkpoints.pending_phases(checkpoints.load_checkpoints(docs(spark, document)))
    assert {r["phase"] for r in pending.collect()} == {"subdomain_enumeration", "vulnerability_scan"}


EVENT = "scan_id bigint, seq bigint, ts timestamp_ntz, "


def test_updates_touch_only_what_a_loaded_document_holds(spark):
    early = "2024-01-01T00:00:00"
    held = {**FULL, "last_update": early, "statistics": {"subdomains_found": 3}, "phases": {
        "alive_check": {**PHASE, "checkpoint": {"batch_index": 3, "batch_size": 10, "progress": 5}},
        "extra_phase": PHASE,
    }}
    bare = {"scan_id": "x", "last_update": early, "phases": {}, "statistics": {}}
    rows = spark.createDataFrame(
        [(0, json.dumps(held)), (1, json.dumps(bare)), (2, json.dumps(held)[:-3])],
        "scan_id bigint, doc string")
    base = checkpoints.load_checkpoints(rows).withColumns({
        "last_update": F.col("last_update").cast("timestamp_ntz"),
        "templates_hash": F.col("environment.templates_hash"),
    })
    def by_scan(df):
        return {r["scan_id"]: r for r in df.collect()}

    before = by_scan(base)
    phases = spark.createDataFrame(
        [(i, 1, T0, p, "completed", 100, 7) for i in range(3) for p in ("vulnerability_scan", "extra_phase")],
        EVENT + "phase string, status string, progress int, results_count bigint")
    after = by_scan(checkpoints.apply_phase_events(base, phases))
    assert after[0]["phases"]["extra_phase"]["status"] == "completed"
    assert after[0]["last_update"] == T0 and "vulnerability_scan" not in after[0]["phases"]
    assert after[1] == before[1] and after[2] == before[2]
    _, rejected = checkpoints.split_phase_events(phases, base)
    assert rejected.count() == 5

    positions = spark.createDataFrame(
        [(i, 1, T0, "alive_check", 4, None, None) for i in range(3)],
        EVENT + "phase string, batch_index int, batch_size int, progress int")
    after = by_scan(checkpoints.apply_position_events(base, positions))
    assert tuple(after[0]["phases"]["alive_check"]["checkpoint"]) == (4, 10, 5)
    assert after[1] == before[1] and after[2] == before[2]

    counters = spark.createDataFrame(
        [(i, 1, T0, n, 7) for i in range(3) for n in ("subdomains_found", "alive_subdomains")],
        EVENT + "name string, value bigint")
    after = by_scan(checkpoints.apply_statistic_events(base, counters))
    assert tuple(after[0]["statistics"]) == (7, None, None)
    assert tuple(after[1]["statistics"]) == (None, None, None) and after[1]["last_update"] == T0
    assert after[2] == before[2]

    fields = spark.createDataFrame(
        [(i, 1, T0, "templates_hash", "new") for i in range(3)], EVENT + "name string, value string")
    after = by_scan(checkpoints.apply_field_events(base, fields))
    assert after[0]["templates_hash"] == "new" and after[0]["last_update"] == T0
    assert after[1] == before[1] and after[2] == before[2]


def test_phase_events_fold_to_the_last_and_ignore_unknown_phases(spark):
    base = checkpoints.load_checkpoints(docs(spark, {**FULL, "last_update": "2024-01-01T00:00:00"}))
    base = base.withColumn("last_update", F.col("last_update").cast("timestamp_ntz"))
    events = spark.createDataFrame(
        [(0, 1, T0, "alive_check", "in_progress", 10, 1), (0, 2, T0, "alive_check", "completed", 100, 7),
         (0, 3, T0, "nonsense", "failed", 1, 1)],
        "scan_id bigint, seq bigint, ts timestamp_ntz, phase string, status string, progress int, "
        "results_count bigint",
    )
    row = checkpoints.apply_phase_events(base, events).first()
    assert set(row["phases"]) == set(FULL["phases"])
    assert row["phases"]["alive_check"]["status"] == "completed"
    assert row["phases"]["alive_check"]["results_count"] == 7
    assert row["phases"]["subdomain_enumeration"]["status"] == "pending"
    assert row["last_update"] == T0
    _, rejected = checkpoints.split_phase_events(events, base)
    assert [r["phase"] for r in rejected.collect()] == ["nonsense"]


def test_scan_state_defaults_and_aliases(spark):
    state = readers.load_scan_state(docs(spark, {}, {"status": "checking_alive_domains", "duration": 3}, "{"))
    rows = state.orderBy("scan_id").collect()
    assert [(r["status"], r["display_status"], r["duration"], r["vulnerabilities"], r["is_readable"])
            for r in rows] == [
        ("unknown", "unknown", 0.0, 0, True),
        ("checking_alive_domains", "probing_subdomains", 3.0, 0, True),
        ("unknown", "unknown", 0.0, 0, False),
    ]


def test_snapshots(spark):
    row = checkpoints.snapshot_checkpoints(docs(spark, FULL), now()).first()
    assert (row["snapshot"], row["file_name"]) == ("20240131_000000", "scan_state_20240131_000000.json")


def test_expired_snapshots_break_ties_by_path(spark):
    files = spark.createDataFrame(
        [(1, f"f{i}", 5) for i in range(7)] + [(2, "only", 1)], "scan_id bigint, path string, mtime_s bigint"
    )
    assert [r["path"] for r in checkpoints.expired_snapshots(files).orderBy("path").collect()] == ["f5", "f6"]


# --- fleet -----------------------------------------------------------------------------------

def test_drift_rules(spark):
    recorded = spark.createDataFrame(
        [(1, "a", "1.0.0"), (1, "b", "unknown"), (1, "c", "unknown"), (1, "gone", "1")],
        "scan_id bigint, tool string, version string",
    )
    current = fleet.current_versions(spark.createDataFrame(
        [("a", "Current Version: v1.1.0"), ("b", ""), ("c", "2.0.0"), ("new", "3.0.0")],
        "tool string, version_text string",
    ))
    rows = fleet.environment_drift(recorded, current).orderBy("tool").collect()
    assert [(r["tool"], r["has_unknown"]) for r in rows] == [("a", False), ("c", True)]
    assert rows[0]["message"] == "Tool version mismatch for a: 1.0.0 (checkpoint) vs 1.1.0 (current)"
    assert fleet.environment_validity(recorded, current).first()["mismatches"] == 2


def test_containment_counts_as_current(spark):
    installed = spark.createDataFrame(
        [(1, "a", "1.2.30"), (1, "b", None), (1, "c", "1.0.0")], "scan_id bigint, tool string, version string"
    )
    latest = spark.createDataFrame([("a", "v1.2.3"), ("b", "v1"), ("c", "v2.0.0")], "tool string, tag string")
    rows = fleet.outdated_tools(installed, latest).orderBy("tool").collect()
    assert [(r["needs_update"], r["exact_match"]) for r in rows] == [
        (False, False), (True, False), (True, False),
    ]
    assert all(r["needs_update"] for r in fleet.outdated_tools(installed, latest, force=True).collect())
    required = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "a"), (2, "gone")], "scan_id bigint, tool string")
    rows = fleet.outdated_tools(installed, latest, required).orderBy("scan_id", "tool").collect()
    assert [(r["version"], r["latest_version"], r["needs_update"]) for r in rows] == [
        ("1.2.30", "1.2.3", False), (None, "1", True), (None, "1.2.3", True), (None, None, False),
    ]


def test_fingerprint_ignores_order_and_sees_changes(spark):
    rows = [(1, f"p{i}.yaml", f"text {i}" * 2000) for i in range(40)] + [(1, "x.txt", "no template")]
    schema = "scan_id bigint, path string, content string"
    one = fleet.corpus_fingerprint(spark.createDataFrame(rows, schema)).first()
    other = fleet.corpus_fingerprint(spark.createDataFrame(rows[::-1], schema).repartition(7)).first()
    assert one == other and one["files"] == 40
    changed = [*rows[1:], (1, "p0.yaml", "text 0" * 1999 + "text !")]
    assert fleet.corpus_fingerprint(spark.createDataFrame(changed, schema)).first() != one


# --- notifications ---------------------------------------------------------------------------

def test_list_message(spark):
    items = spark.range(103).select(
        F.lit(1).alias("scan_id"), F.format_string("h%03d", "id").alias("item")
    )
    domains = spark.createDataFrame([(1, "d.com"), (2, "e.com")], "scan_id bigint, domain string")
    totals = spark.createDataFrame([(1, 500)], "scan_id bigint, total bigint")
    made = notify.list_messages(
        items.union(spark.createDataFrame([(3, "x")], "scan_id bigint, item string")), domains,
        notify.SUBDOMAINS_FOUND, totals)
    rows = made.filter("part = 0").orderBy("scan_id").collect()
    body = json.loads(rows[0]["payload"])
    lines = body["content"].split("\n")
    assert lines[0] == "🔍 Found 500 subdomains for d.com (showing 103 sample):"
    assert lines[1:101] == [f"• h{i:03d}" for i in range(100)]
    assert lines[101:] == ["... and 3 more"]
    assert body["embeds"] == [{"title": "Subdomains Found", "color": 0x00FF00}]
    assert rows[1]["content"] == "🔍 Found 0 subdomains for e.com:\n"
    assert rows[2]["content"] == "🔍 Found 1 subdomains for unknown domain:\n• x"
    rest = made.filter("part > 0").collect()
    assert [(r["scan_id"], r["part"]) for r in rest] == [(1, 1)]
    assert rest[0]["content"].split("\n")[1:] == ["• h100", "• h101", "• h102"]


def test_event_messages(spark):
    events = spark.createDataFrame(
        [(1, 1, "start", "d.com", None), (1, 2, "cancelled", "d.com", None),
         (1, 3, "error", "d.com", 'bad "x"'), (1, 4, "nonsense", "d.com", None)],
        "scan_id bigint, seq bigint, kind string, domain string, detail string",
    )
    rows = notify.event_messages(events).orderBy("seq").collect()
    assert [json.loads(r["payload"])["content"] for r in rows] == [
        "🚀 Starting security scan for domain: d.com",
        "🚫 Scan cancelled for d.com\nReason: User cancelled",
        '❌ Error scanning domain d.com:\n```\nbad "x"\n```',
    ]


def test_result_parts_hold_every_line(spark):
    lines = spark.range(250).select(
        F.lit(1).alias("scan_id"), "id", F.format_string("line %d", "id").alias("line")
    )
    domains = spark.createDataFrame([(1, "d.com"), (2, "e.com")], "scan_id bigint, domain string")
    for limit in (1_000, 50):
        rows = notify.result_messages(lines, domains, ["id"], max_group_rows=limit)
        rows = rows.orderBy("scan_id", "part").collect()
        assert [r["part"] for r in rows] == [0, 1, 2, 0]
        found = [l for r in rows[:3] for l in r["content"].split("\n")[2:-1]]
        assert found == [f"line {i}" for i in range(250)]
        assert rows[3]["content"] == "✅ No vulnerabilities found for e.com"
