"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from exposure.operators import checkpoints, findings, inventory, joins
from exposure.plans.bindings import frame
from exposure.plans.queries import QUERIES
from exposure.sources import writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


STREAMS = {n for n in QUERIES if n.startswith("stream_")}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_product_no_python_no_global_window(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in (
        "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython",
        "InPandas", "InArrow", "SinglePartition",
    ):
        assert word not in text


def test_scan_reads_only_the_columns_it_needs(spark, sf_dir):
    text = plan(QUERIES["severity_counts"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text
    text = plan(QUERIES["expired_snapshots"](spark, sf_dir))
    assert "text:" not in text.split("ReadSchema")[1]


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["severity_counts"](spark, sf_dir))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")
    assert text.count("Exchange") == 1
    assert plan(QUERIES["scan_funnel"](spark, sf_dir)).count("Join") == 0


@pytest.mark.parametrize("name, rows", [
    ("finding_preview", 10), ("expired_snapshots", 5), ("corpus_sample", 100),
])
def test_groups_are_limited_before_the_shuffle(spark, sf_dir, name, rows):
    text = plan(QUERIES[name](spark, sf_dir))
    assert f"row_number(), {rows}, Partial" in text


def test_severity_partition_is_pruned(spark, sf_dir, tmp_path):
    path = str(tmp_path / "tagged")
    tagged = findings.tag_severity(frame(spark, sf_dir, "findings"))
    writers.write_tagged_findings(tagged, path)
    stored = spark.read.parquet(path)
    kept = findings.filter_severity(stored, ["critical"])
    assert "PartitionFilters: [isnotnull(severity" in plan(kept) or "severity#" in plan(kept).split("PartitionFilters")[1][:80]
    assert kept.count() == tagged.filter("severity = 'critical'").count()
    assert stored.count() == tagged.count()


def final_plan(df):
    df._jdf.queryExecution().toRdd().count()
    return plan(df).split("== Initial Plan ==")[0]


def test_small_delta_does_not_shuffle_the_store(spark, tmp_path):
    stored = spark.range(100_000).select(
        (F.col("id") % 9).alias("scan_id"), F.md5(F.col("id").cast("string")).alias("host")
    )
    stored.write.parquet(str(tmp_path / "stored"))
    store = spark.read.parquet(str(tmp_path / "stored"))
    delta = store.limit(50).unionByName(
        spark.createDataFrame([(1, "new"), (1, "new")], "scan_id bigint, host string")
    )
    delta.write.parquet(str(tmp_path / "delta"))
    fresh = inventory.append_new_hosts(store, spark.read.parquet(str(tmp_path / "delta")))
    text = plan(fresh)
    semi = text[text.index("LeftSemi"):]
    assert "BroadcastHashJoin" in text
    assert "Exchange" not in semi[:semi.index("FileScan")]
    assert [tuple(r) for r in fresh.collect()] == [(1, "new")]


def test_bucketed_store_is_not_shuffled(spark, sf_dir, no_automatic_broadcast):
    hosts = QUERIES["load_hosts"](spark, sf_dir)
    spark.sql("drop table if exists host_store")
    writers.create_host_table(hosts.filter("scan_id < 3"), "host_store", buckets=8)
    try:
        fresh = inventory.append_new_hosts(spark.table("host_store"), hosts)
        text = final_plan(fresh)
        assert "Bucketed: true" in text
        # one shuffle per use of the delta, none for the store
        assert text.count(" Exchange hashpartitioning") == 2
        stored_side = text[text.index("LeftSemi"):text.index("Bucketed: true")]
        assert "Exchange" not in stored_side
        assert fresh.count() == hosts.filter("scan_id >= 3").count()
        writers.append_host_table(fresh, "host_store", buckets=8)
        assert spark.table("host_store").count() == hosts.count()
        assert inventory.append_new_hosts(spark.table("host_store"), hosts).count() == 0
    finally:
        spark.sql("drop table if exists host_store")


@pytest.fixture
def no_automatic_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def hot_lines(spark, rows=60_000):
    """One scan holds a third of all rows."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1_000).alias("scan_id"),
        F.concat(F.md5(F.col("id").cast("string")), F.lit(" [low]")).alias("line"),
        F.col("id").alias("mtime_s"), F.md5(F.col("id").cast("string")).alias("path"),
    )


def largest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("case", ["requests", "rebuild", "expired", "consolidate", "alive"])
def test_hot_keys_do_not_meet_in_one_task(spark, no_automatic_broadcast, case):
    lines = hot_lines(spark)
    scans = spark.range(1_000).withColumnRenamed("id", "scan_id")
    expected = 60_000

    def result(**limits):
        if case == "requests":
            requests = scans.withColumn("severities", F.array(F.lit("low")))
            return findings.filter_severity_requests(
                findings.tag_severity(lines), requests, **limits)
        if case == "rebuild":
            state = scans.withColumn("vulnerabilities", F.lit(1).cast("bigint"))
            return findings.rebuild_empty_results(
                state, lines.filter("scan_id < 0"), lines, **limits)
        if case == "expired":
            return checkpoints.expired_snapshots(
                lines.select("scan_id", "path", "mtime_s"), **limits)
        if case == "consolidate":
            path = F.concat(F.lit("f"), F.col("scan_id").cast("string"))
            records = scans.select("scan_id", F.lit(0).alias("batch_id"), path.alias("path"))
            return findings.consolidate_findings(
                records, records.select("path", F.lit(9).alias("length")),
                lines.select(path.alias("path"), F.col("mtime_s").alias("seq"), "line"), **limits)
        host = F.concat(F.lit("http://h"), F.col("scan_id").cast("string"), F.lit(".com"))
        hosts = lines.select(F.lit(1).alias("scan_id"), F.concat(host, F.lit("/"), "path").alias("host"))
        probes = scans.select(F.lit(1).alias("scan_id"), F.concat(host, F.lit(" [200]")).alias("line"))
        return inventory.alive_hosts(hosts, probes, **limits)

    if case == "expired":
        per_scan = lines.groupBy("scan_id").count()
        expected = per_scan.agg(F.sum(F.greatest(F.col("count") - 5, F.lit(0)))).first()[0]
    plain, split = result(ways=1), result()
    assert plain.count() == split.count() == expected
    assert plain.exceptAll(split).count() == 0
    assert largest_task(plain) >= 20_000 - 5
    assert largest_task(split) < 12_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("ways", [1, 7])
def test_lookup_join_equals_join(spark, how, ways):
    rows = hot_lines(spark, 3_000).select("scan_id", "path")
    lookup = spark.range(0, 1_000, 3).select(F.col("id").alias("scan_id"), (F.col("id") * 2).alias("x"))
    plain = rows.join(lookup, "scan_id", how)
    split = joins.lookup_join(rows, lookup, ["scan_id"], how, ways)
    assert plain.columns == split.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
