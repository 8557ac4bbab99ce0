"""Files in, files out."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from exposure.functions import text
from exposure.operators import checkpoints, fleet, hygiene, inventory, progress
from exposure.session import shared_dir
from exposure.sources import cachelog, folders, hoststore, linestore, readers, writers


def parts(spark, path):
    """What the store's files hold, file after file of the newest version, as they lie there."""
    files = sorted({r["file"] for r in linestore.read_index(spark, path).collect()})
    return [(r["scan_id"], r["line"]) for f in files
            for r in spark.read.parquet(f"{path}/files/{f}").collect()]


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content)


def test_sorted_unique_parts(spark, tmp_path):
    hosts = spark.range(3_000).select(
        (F.col("id") % 2).alias("scan_id"), F.md5((F.col("id") % 700).cast("string")).alias("host")
    )
    path = str(tmp_path / "out")
    linestore.write_stored_lines(hosts, path, "host", dedupe=True)
    assert parts(spark, path) == sorted({tuple(r) for r in hosts.collect()})
    linestore.export_text(spark, path, str(tmp_path / "text"), hosts.where("scan_id = 1"))
    files = sorted(glob.glob(f"{tmp_path}/text/scan_id=*/part-*"))
    lines = [line for f in files for line in open(f, encoding="utf-8").read().splitlines()]
    assert lines == sorted({r["host"] for r in hosts.where("scan_id = 1").collect()})


def test_sorted_parts_with_copies(spark, tmp_path):
    lines = spark.range(4_000).select(
        F.lit(1).alias("scan_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.md5((F.col("id") % 50).cast("string")))
        .alias("line"),
    )
    linestore.write_stored_lines(lines, str(tmp_path / "out"))
    assert parts(spark, str(tmp_path / "out")) == sorted(tuple(r) for r in lines.collect())


def test_files_follow_the_bytes_and_scans_are_replaced(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "scan_id bigint, line string"
    lines = spark.range(5_000).selectExpr("id % 1000 as scan_id", "concat('line ', id) as line")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:  # several files though they are small
        linestore.write_stored_lines(lines, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    index = linestore.read_index(spark, path)
    first = {r["file"] for r in index.select("file").distinct().collect()}
    assert 1 < len(first) <= 8 and index.agg(F.sum("lines")).first()[0] == 5_000
    spans = index.groupBy("file").agg(
        F.min(F.struct("scan_id", "first_line")).alias("low"),
        F.max(F.struct("scan_id", "last_line")).alias("high")).orderBy("low").collect()
    assert all(a["high"] < b["low"] for a, b in zip(spans, spans[1:]))

    new = spark.createDataFrame([(7, "x"), (7, "x"), (2_000, "y"), (8, None)], schema)
    linestore.write_stored_lines(new, path)
    found = sorted(map(str, linestore.read_stored_lines(spark, path).collect()))
    assert found == sorted(map(str, lines.where("scan_id not in (7, 8)").unionByName(new).collect()))
    # only the files that held scans 7 and 8 were written anew
    second = {r["file"] for r in linestore.read_index(spark, path).select("file").distinct().collect()}
    assert 0 < len(first - second) < len(first) and len(second) <= len(first) + 8
    wanted = spark.createDataFrame([(7,), (9,)], "scan_id bigint")
    some = linestore.read_stored_lines(spark, path, wanted)
    assert sorted(r["line"] for r in some.where("scan_id = 7").collect()) == ["x", "x"]
    assert len(some.inputFiles()) < len(second) and some.count() == 7
    linestore.vacuum(spark, path)
    assert linestore.read_stored_lines(spark, path).count() == len(found)
    linestore.write_stored_lines(new.limit(0), path)
    assert linestore.read_stored_lines(spark, path).count() == len(found)
    assert linestore.read_stored_lines(spark, str(tmp_path / "none")).isEmpty()


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "scan_id bigint, line string"
    linestore.write_stored_lines(spark.createDataFrame([(1, "a"), (2, "b")], schema), path)
    bad = spark.createDataFrame([(1, "c")], schema).withColumn("line", F.expr("raise_error('lost')"))
    with pytest.raises(Exception, match="lost"):
        linestore.write_stored_lines(bad.withColumn("line", F.col("line").cast("string")), path)
    (tmp_path / "store" / "index" / "version=1").mkdir()  # a version without its mark
    assert sorted(map(tuple, linestore.read_stored_lines(spark, path).collect())) == [
        (1, "a"), (2, "b")]


def test_copies_of_one_line_spread_over_tasks(spark):
    lines = spark.range(10_000).select(F.lit(1).alias("scan_id"), F.lit("same").alias("line"))
    repeated = writers.sorted_lines(lines, dedupe=False, copies_per_row=100)
    assert repeated.count() == 10_000
    ranged = writers.sorted_lines(lines, dedupe=False, copies_per_row=100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = ranged.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 1
    assert max(r["count"] for r in tasks) < 5_000


def test_lines_break_as_files_do(spark, tmp_path):
    put(str(tmp_path / "scan_id=3" / "subdomains.txt"), "a.com\r\nb.com\n\n  \n\tc.com \nb.com")
    lines = readers.read_lines(spark, str(tmp_path), "*.txt")
    hosts = hygiene.load_hosts(lines.withColumn("scan_id", F.col("scan_id").cast("bigint")))
    assert sorted(r["host"] for r in hosts.collect()) == ["a.com", "b.com", "c.com"]
    assert [r["scan_id"] for r in hosts.select("scan_id").distinct().collect()] == [3]


def test_glob_skips_empty_and_foreign_files(spark, tmp_path):
    put(str(tmp_path / "scan_id=1" / "tool_results_1.txt"), "a [low]\n\n b \n")
    put(str(tmp_path / "scan_id=1" / "tool_results_2.txt"), "")
    put(str(tmp_path / "scan_id=2" / "tool_results_3.txt"), "c\n")
    put(str(tmp_path / "scan_id=2" / "other.txt"), "no\n")
    rows = readers.load_findings_glob(spark, str(tmp_path)).collect()
    assert sorted((r["scan_id"], r["line"]) for r in rows) == [(1, "a [low]"), (1, "b"), (2, "c")]
    assert {os.path.basename(r["path"]) for r in rows} == {"tool_results_1.txt", "tool_results_3.txt"}


def test_documents_are_read_whole_and_broken_ones_survive(spark, tmp_path):
    put(str(tmp_path / "scan_id=1" / "scan_state.json"), '{\n "scan_id": "x",\n "status": "paused"\n}')
    put(str(tmp_path / "scan_id=2" / "scan_state.json"), '{"scan_id": "br')
    loaded = checkpoints.load_checkpoints(readers.read_documents(spark, str(tmp_path)))
    rows = {r["scan_id"]: (r["load_status"], r["status"]) for r in loaded.collect()}
    assert rows == {1: ("loaded", "paused"), 2: ("corrupt", None)}


def test_cache_files(spark, tmp_path):
    put(str(tmp_path / "abc.json"), '{"timestamp": 1706659100.5, "result": "x\\ny"}')
    put(str(tmp_path / "old.json"), '{"result": "z"}')
    rows = {r["cache_key"]: r for r in readers.read_cache(spark, str(tmp_path)).collect()}
    assert rows["abc"]["result"] == "x\ny"
    assert str(rows["abc"]["ts"]) == "2024-01-30 23:58:20.500000"
    assert rows["old"]["ts"].year == 1970


def test_template_folders(spark, tmp_path):
    rows = [
        (1, "a/one.yaml", "x" * 3_000_000), (1, "/a//b/two words.yaml", "é%20\n"), (2, "a/one.yaml", None),
        (-3, "q.yaml", "q"), (2, "a/skip.txt", "z"), (None, "a.yaml", "n"), (4, None, "n")]
    files = spark.createDataFrame(rows, "scan_id int, path string, content string")
    for _ in range(2):
        assert folders.write_corpus(files, f"file:{tmp_path}/t") == 5
    found = folders.read_corpus_folder(spark, str(tmp_path / "t"))
    assert sorted((r.scan_id, r.path, r.length, bytes(r.content).decode()) for r in found.collect()) == [
        (-3, "q.yaml", 1, "q"), (1, "a/b/two words.yaml", 6, "é%20\n"),
        (1, "a/one.yaml", 3_000_000, "x" * 3_000_000)]
    assert os.path.getsize(tmp_path / "t" / "scan_id=2" / "a" / "one.yaml") == 0
    assert not glob.glob(f"{tmp_path}/t/**/*.part", recursive=True)
    assert folders.write_corpus(files.limit(0), str(tmp_path / "none")) == 0
    with pytest.raises(Exception, match="not a path inside"):
        folders.write_corpus(files.limit(1).selectExpr("scan_id", "'a/../../b' as path", "content"), str(tmp_path))


def test_corpus_and_inventory(spark, tmp_path):
    put(str(tmp_path / "a" / "one.yaml"), "x" * 5_000)
    put(str(tmp_path / "b" / "c" / "two.yaml"), "y")
    put(str(tmp_path / "b" / "skip.txt"), "z")
    corpus = readers.read_corpus(spark, str(tmp_path)).withColumn("scan_id", F.lit(1))
    assert fleet.corpus_fingerprint(corpus).first()["files"] == 2
    files = readers.file_inventory(spark, str(tmp_path))
    assert sorted(r["length"] for r in files.collect()) == [1, 1, 5_000]
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_many_small_templates_make_few_tasks(spark, tmp_path):
    names = spark.range(60).selectExpr(
        "id % 3 as scan_id", "concat('d/f', id, '.yaml') as path", "cast(id as string) as content")
    assert folders.write_corpus(names, str(tmp_path / "t")) == 60
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")  # a partition for each file
    try:
        found = folders.read_corpus_folder(spark, str(tmp_path / "t"))
        assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert sorted(bytes(r.content).decode() for r in found.collect()) == sorted(map(str, range(60)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_snapshot_of_the_same_moment_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    docs = spark.createDataFrame([(1, "{}"), (2, "{}"), (3, None)], "scan_id bigint, doc string")
    for moment in ("2024-01-31 00:00:00", "2024-01-31 00:00:01", "2024-01-31 00:00:01"):
        as_of = F.lit(moment).cast("timestamp_ntz")
        writers.write_snapshots(checkpoints.snapshot_checkpoints(docs, as_of), path)
    assert spark.read.parquet(path).count() == 4


def test_memory_documents_as_json(spark, tmp_path):
    samples = spark.range(5).select(
        F.lit(1).alias("scan_id"), F.col("id").alias("seq"),
        F.lit("2024-01-31 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit("x").alias("label"), F.col("id").cast("double").alias("memory_mb"),
    )
    writers.write_json(progress.memory_documents(samples, 2), str(tmp_path / "memory"), "scan_id")
    back = spark.read.json(str(tmp_path / "memory"))
    assert back.count() == 3
    assert back.select(F.sum(F.size("measurements"))).first()[0] == 5


def test_host_loads(spark, tmp_path):
    store, schema = str(tmp_path / "store"), "scan_id bigint, host string"
    assert hoststore.read_host_store(spark, store).isEmpty()
    for _ in range(2):
        hoststore.bulk_host_load(
            spark.createDataFrame([(1, "a"), (2, "b"), (1, "a")], schema), store, "one")
    stored = hoststore.read_host_store(spark, store)
    second = spark.createDataFrame([(1, "a"), (1, "c")], schema)
    hoststore.write_host_load(inventory.append_new_hosts(stored, second), store, "q.000-000")
    rows = hoststore.read_host_store(spark, store).collect()
    assert sorted(map(tuple, rows)) == [(1, "a"), (1, "c"), (2, "b")]
    assert {r["scan_id"]: r["hosts"] for r in hoststore.host_counts(spark, store).collect()} == {
        1: 2, 2: 1}
    hoststore.compact_host_store(spark, store, str(tmp_path / "compact"))
    assert hoststore.read_host_store(spark, str(tmp_path / "compact")).count() == 3
    hoststore.clear_host_store(spark, store)
    assert hoststore.read_host_store(spark, store).isEmpty()


def test_cache_log_keeps_the_last_write(spark, tmp_path):
    path = tmp_path / "cache"
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    appends = [
        [("k", at(1), 1, "old"), ("t", None, None, "timeless"), (None, at(1), 1, "no key")],
        [("k", at(9.000001), 5, "new"), ("e", at(1), 1, "")],
        [("k", at(9.000001), 4, "before"), ("t", at(3), 1, None)], [("l", at(2), 2, "two\nlines")]]
    for number, rows in enumerate([*appends, [("k", at(2), 9, "late")]]):
        for _ in range(2):
            cachelog.append_cache(
                spark.createDataFrame(rows, cachelog.ENTRIES), str(path), number, fan=2)
    log = cachelog.read_cache_log(spark, str(path))
    last = {r["cache_key"]: (r["ts"], r["seq"], r["result"])
            for r in cachelog.latest_entries(log).collect()}
    assert last == {"k": (at(9.000001), 5, "new"), "t": (at(3), 1, None), "e": (at(1), 1, ""),
                    "l": (at(2), 2, "two\nlines")}
    assert log.count() == 5  # the first four appends are one load
    assert len([p for p in path.iterdir() if p.name.startswith("load=")]) <= 4
    assert cachelog.read_cache_log(spark, str(tmp_path / "none")).isEmpty()


def test_loads_stay_few_over_many_batches():
    """What a batch lists, reads and holds, for two queries that write to one store."""
    names, held = ["bulk"], {}
    most = 0
    for batch in range(400):
        for query in ("a", "b"):
            own = [n for n in names if n.startswith(f"{query}.")]
            names = [n for n in names if n not in own or n in hoststore.live_loads(own)]
            most = max(most, len(names))
            for _ in range(2):  # the second time, the batch is repeated
                stored = hoststore.earlier_loads(names, query, batch)
                inside = {x for n in stored for x in held.get(n, ())}
                assert inside >= {(query, b) for b in range(batch)}
                assert sum(len(held.get(n, ())) for n in stored) == len(inside)
                load = hoststore.load_name(query, batch)
                held[load] = {(query, batch)}.union(
                    *(held[n] for n in hoststore.merged_loads(stored, query, batch)))
                names = sorted({*names, load})
    assert most <= 2 * (3 * 5 + 5) + 1


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base)
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_shared_dir_refuses_a_private_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        shared_dir(Session(), "x")


def test_text_against_python(spark):
    import random
    import re
    rng = random.Random(3)
    alphabet = list("aZ09-._/:@?#[]!~é\x1b\x7f\x01 m;\t \x1c\n\xa0\u2003")
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(3_000)]
    made += [f"http{s}://{a}" for s in ("", "s") for a in made[:300]]
    ansi = re.compile(r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])")
    label = re.compile(r"([a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?\.)+[a-zA-Z]{2,}")
    made += ["".join(rng.choice("ab-.1") for _ in range(rng.randrange(1, 9))) for _ in range(3_000)]
    rows = spark.createDataFrame(list(enumerate(made)), "i int, t string").select(
        "i", text.stripped(F.col("t")).alias("s"), text.without_ansi(F.col("t")).alias("a"),
        text.authority(F.col("t")).alias("h"), text.valid_host(F.col("t")).alias("v"),
        text.not_blank(F.col("t")).alias("b"), text.has_text(F.col("t")).alias("b2"),
    ).orderBy("i").collect()
    for line, row in zip(made, rows):
        found = re.match(r"https?://([^/?#]*)", line)
        host = found.group(1) if found else line
        assert row["s"] == line.strip()
        assert row["b"] == row["b2"] == bool(line.strip())
        assert row["a"] == ansi.sub("", line)
        assert row["h"] == host
        assert row["v"] == bool(label.fullmatch(host))
