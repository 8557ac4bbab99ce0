"""Sliced running values equal the plain window's, also when one key holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from exposure.operators import ordered, progress
from exposure.operators.ordered import PEAK, PEAK_BEFORE, PREVIOUS, ROW_NUMBER, SUM

KINDS = {
    "row": (ROW_NUMBER, None), "total": (SUM, "n"), "peak": (PEAK, "n"),
    "peak_before": (PEAK_BEFORE, "n"), "previous": (PREVIOUS, "s"),
}


def data(spark, rows=2_000):
    rng = random.Random(7)
    made = [
        (None if i % 97 == 0 else 0 if rng.random() < 0.6 else rng.randrange(40),
         rng.randrange(50), i, None if rng.random() < 0.2 else rng.randrange(-100, 100),
         rng.choice([None, "a", "b", "c"]))
        for i in range(rows)
    ]
    rng.shuffle(made)
    return spark.createDataFrame(made, "scan_id bigint, ts bigint, seq bigint, n bigint, s string")


def values():
    return {name: (kind, None if col is None else F.col(col)) for name, (kind, col) in KINDS.items()}


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("limit", [100, 7])
def test_slices_equal_one_window(spark, limit):
    df = data(spark).persist()
    plain = ordered.running(df, ["scan_id"], ["ts", "seq"], values())
    sliced = ordered.running(df, ["scan_id"], ["ts", "seq"], values(), max_group_rows=limit)
    assert rows(plain) == rows(sliced)
    assert sliced.columns == [*df.columns, *KINDS]
    df.unpersist()


@pytest.mark.parametrize("order", [["ts", "seq"], ["name"], ["moment", "seq"]])
def test_slices_of_a_hot_key_stay_bounded(spark, order):
    df = data(spark).withColumns({
        "name": F.concat(F.lit("host-"), F.md5(F.col("seq").cast("string"))),
        "moment": (F.timestamp_seconds("ts") + F.expr("interval '1' microsecond")).cast(
            "timestamp_ntz")})
    cut = ordered.slice_number(df, ["scan_id"], order, 100)
    sliced = df.select("scan_id", *order, cut.alias("cut"))
    sizes = sliced.groupBy("scan_id", "cut").count().collect()
    assert max(r["count"] for r in sizes) <= 150
    assert sum(r["count"] for r in sizes) == 2_000
    # in order, and small groups are whole
    spans = sliced.groupBy("scan_id", "cut").agg(
        F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high")).collect()
    for key in {r["scan_id"] for r in sizes}:
        mine = sorted((r for r in spans if r["scan_id"] == key), key=lambda r: r["cut"])
        assert key == 0 or len(mine) == 1
        assert all(a["high"] < b["low"] for a, b in zip(mine, mine[1:]))


def test_many_bounds_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_SLICES", 100)
    df = spark.range(3_000).selectExpr("0 as scan_id", "id as seq", "1 as n")
    cut = ordered.slice_number(df, ["scan_id"], ["seq"], 10)
    sizes = df.groupBy(cut.alias("cut")).count().orderBy("cut").collect()
    assert 90 <= len(sizes) <= 100 and [r["cut"] for r in sizes] == list(range(len(sizes)))
    assert max(r["count"] for r in sizes) <= 60


def test_building_takes_one_job_and_writes_nothing(spark, monkeypatch):
    """Of the hot plan as of the plain one: one action, over key and order only, and no table."""
    df, actions = data(spark), []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: actions.append(self) or collect(self))
    monkeypatch.setattr(type(df), "write", property(lambda self: pytest.fail("written")))
    for limit in (100, 5_000):
        actions.clear()
        plan = ordered.running(df, ["scan_id"], ["ts", "seq"], values(), max_group_rows=limit)
        assert len(actions) == 1
    monkeypatch.undo()
    hot = ordered.running(df, ["scan_id"], ["ts", "seq"], values(), max_group_rows=100)
    assert "parquet" not in hot._jdf.queryExecution().toString()
    assert hot.count() == plan.count() == 2_000


def test_columns_of_the_caller_are_left_alone(spark):
    extra = {name: F.col("seq") * -1 for name in (
        "_slice", "_row", "_in_total", "_own_total", "_carry_total", "_key_scan_id", "_turn", "cut")}
    df = data(spark).withColumns(extra)
    for limit in (100, 5_000):
        out = ordered.running(df, ["scan_id"], ["ts", "seq"], values(), max_group_rows=limit)
        assert out.columns == [*df.columns, *KINDS]
        assert out.where(F.expr(" or ".join(f"{n} <> -seq" for n in extra))).isEmpty()
    assert ordered.running(
        df.limit(0), ["scan_id"], ["ts", "seq"], values(), max_group_rows=1).isEmpty()


def test_batches_are_full_but_for_the_last(spark):
    hosts = spark.range(1_003).select(
        F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 5).alias("scan_id"),
        F.md5(F.col("id").cast("string")).alias("host"),
    )
    for limit in (10_000, 100):
        batches = progress.assign_batches(hosts, 10, limit)
        sizes = batches.groupBy("scan_id", "batch_id").count()
        assert sizes.agg(F.max("count")).first()[0] == 10
        short = sizes.filter("count < 10").groupBy("scan_id").count().filter("count > 1")
        assert short.count() == 0
        assert batches.count() == 1_003
        totals = {r["scan_id"]: r["batches"] for r in progress.batch_totals(hosts, 10).collect()}
        found = {r["scan_id"]: r["n"] for r in batches.groupBy("scan_id").agg(
            F.count_distinct("batch_id").alias("n")).collect()}
        assert totals == found


def test_bounds_stay_few_with_many_large_groups(spark, monkeypatch):
    held = []
    bracket = ordered._bracket
    monkeypatch.setattr(ordered, "_bracket", lambda *given: held.append(given[2]) or bracket(*given))
    df = spark.range(30_000).selectExpr("id % 1500 as scan_id", "id as seq", "cast(id as string) as s")
    values = {"previous": (PREVIOUS, F.col("s"))}
    plain = ordered.running(df, ["scan_id"], ["seq"], values)
    sliced = ordered.running(df, ["scan_id"], ["seq"], values, max_group_rows=5)
    assert rows(plain) == rows(sliced)
    assert 0 < len(held[0]) < ordered.MAX_SLICES
