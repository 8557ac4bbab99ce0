"""Connected components by alternating large and small stars.

Every round links each node's neighbours to the smallest node it knows. The neighbours of a hub are
dealt over many tasks (by neighbour), so no task ever holds all links of one node. Each round is a
table in the shared folder, and rounds end when the links stop changing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exposure.llm.frames import way
from exposure.session import materialize


def _star(links: DataFrame) -> DataFrame:
    """Rows (at, other) with the smallest node among ``at`` and all its others."""
    ways = links.withColumn("_way", way("other"))
    least = ways.groupBy("at", "_way").agg(F.min("other").alias("least"))
    least = least.select(
        "at", "_way", F.least("at", F.min("least").over(Window.partitionBy("at"))).alias("least"))
    return ways.join(least, ["at", "_way"]).select("at", "other", "least")


def _pairs(links: DataFrame, a: str, b: str) -> DataFrame:
    return links.where(F.col(a) > F.col(b)).select(F.col(a).alias("hi"), F.col(b).alias("lo"))


def _sign(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b) but the roots; root is the smallest node."""
    now = materialize(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("hi > lo").distinct(), "links")
    sign = _sign(now)
    while sign[0]:
        both = now.select(F.col("hi").alias("at"), F.col("lo").alias("other")).union(
            now.select(F.col("lo").alias("at"), F.col("hi").alias("other")))
        large = _pairs(_star(both).where("other > at"), "other", "least").distinct()
        small = _star(large.select(F.col("hi").alias("at"), F.col("lo").alias("other")))
        after = materialize(
            _pairs(small, "other", "least").union(_pairs(small, "at", "least")).distinct(), "links")
        before, sign, now = sign, _sign(after), after
        if sign == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
