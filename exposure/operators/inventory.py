"""Membership questions about hosts, and the result cache.

Hosts are unique per scan, so joins on (scan, host) have no hot key. Where a key may repeat on the
left (many URLs of one host, many requests of one command), ``lookup_join`` deals them out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposure.functions import text
from exposure.operators.joins import WAYS, lookup_join
from exposure.schemas import CACHE_TTL_SECONDS

HOST_KEY = ["scan_id", "host"]


def append_new_hosts(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming hosts that the store does not hold yet, each once.

    The store is first reduced to the hosts that came in. A delta is usually far smaller than the
    store: Spark then broadcasts it, and the stored side is scanned where it lies instead of being
    shuffled. Where both are large, this costs one more shuffle of the delta.
    """
    delta = incoming.select(*HOST_KEY).dropDuplicates(HOST_KEY)
    already = stored.select(*HOST_KEY).join(delta, HOST_KEY, "left_semi")
    return delta.join(already, HOST_KEY, "left_anti")


def bulk_load_hosts(hosts: DataFrame) -> DataFrame:
    """The rows of a store that starts empty: a set, also when the input repeats hosts."""
    return hosts.select(*HOST_KEY).dropDuplicates(HOST_KEY)


def known_hosts(stored: DataFrame, asked: DataFrame) -> DataFrame:
    """The asked rows whose host is in the store.

    The store is cut down to the asked hosts first: of a semi join only the right side can be
    broadcast, so a small question does not shuffle the store.
    """
    found = stored.select(*HOST_KEY).join(
        asked.select(*HOST_KEY).dropDuplicates(), HOST_KEY, "left_semi"
    )
    return asked.join(found, HOST_KEY, "left_semi")


def store_sizes(stored: DataFrame) -> DataFrame:
    return stored.groupBy("scan_id").agg(F.count(F.lit(1)).alias("hosts"))


def resume_worklist(targets: DataFrame, processed: DataFrame) -> DataFrame:
    """Targets that no finished batch has covered, whatever the order of either list."""
    return targets.join(processed.select(*HOST_KEY).dropDuplicates(), HOST_KEY, "left_anti")


def _answered(probe_lines: DataFrame) -> DataFrame:
    return probe_lines.select(
        "scan_id", text.host_key(text.probe_target(F.col("line"))).alias("_host_key")
    ).dropDuplicates()


def _by_answer(hosts: DataFrame, probe_lines: DataFrame, how: str, ways: int) -> DataFrame:
    keyed = hosts.withColumn("_host_key", text.host_key(F.col("host")))
    return lookup_join(
        keyed, _answered(probe_lines), ["scan_id", "_host_key"], how, ways
    ).select(*hosts.columns)


def alive_hosts(hosts: DataFrame, probe_lines: DataFrame, ways: int = WAYS) -> DataFrame:
    """Hosts with at least one probe line."""
    return _by_answer(hosts, probe_lines, "left_semi", ways)


def dead_hosts(hosts: DataFrame, probe_lines: DataFrame, ways: int = WAYS) -> DataFrame:
    """Hosts without any probe line."""
    return _by_answer(hosts, probe_lines, "left_anti", ways)


def cache_key(argv: Column) -> Column:
    return F.md5(F.concat_ws(" ", argv))


def cache_lookup(
    requests: DataFrame, cache: DataFrame, as_of: Column, use_cache: bool = True
) -> DataFrame:
    """Answer each request (column ``argv``) from the last write under its key.

    A hit needs a non-empty result written less than the time-to-live before ``as_of``.
    """
    latest = cache.groupBy("cache_key").agg(
        F.max_by(F.struct("ts", "result"), F.struct("ts", "seq")).alias("_last")
    )
    fresh = F.col("_last.ts") > as_of - F.expr(f"interval {CACHE_TTL_SECONDS} seconds")
    hit = F.coalesce(
        F.lit(use_cache) & fresh & (F.length("_last.result") > 0), F.lit(False)
    )
    keyed = requests.withColumn("cache_key", cache_key(F.col("argv")))
    return lookup_join(keyed, latest, ["cache_key"], "left").select(
        *requests.columns, "cache_key", hit.alias("is_hit"),
        F.when(hit, F.col("_last.result")).alias("result"),
    )


def cache_misses(requests: DataFrame, cache: DataFrame, as_of: Column) -> DataFrame:
    """The distinct commands that have to be run again."""
    return (
        cache_lookup(requests, cache, as_of).filter("not is_hit")
        .select("cache_key", "argv").dropDuplicates(["cache_key"])
    )


def cache_entries(keyed_results: DataFrame, as_of: Column) -> DataFrame:
    """Rows to append to the cache for freshly run commands (argv, seq, result)."""
    return keyed_results.select(
        cache_key(F.col("argv")).alias("cache_key"), as_of.alias("ts"), "seq", "result"
    )
