"""A growing set of hosts in loads that merge by size.

A stream writes one load a batch. Where the number of batches reaches a multiple of FAN, of FAN
squared and so on, the batch writes the loads of that many batches together with its own new hosts
as one load. A load's name says which batches it holds: ``<query>.<first>-<last>``. A load that lies
inside a larger complete one of its query is dead and is not read; it is deleted by the next batch,
when the larger one is committed. So a store of n batches has at most FAN - 1 loads of each size, each
host is rewritten log(n) times, and a batch that is repeated replaces its own load. Files follow the
bytes of a load.

Loads of other names (a bulk load, a compaction) are always read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposure.operators.inventory import bulk_load_hosts

HOSTS = "scan_id bigint, host string"
FAN = 4

_SPAN = re.compile(r"(.+)\.(\d+)-(\d+)")


def span(batch_id: int, fan: int = FAN) -> int:
    """How many batches, this one included, the batch's load holds."""
    size = 1
    while (batch_id + 1) % (size * fan) == 0:
        size *= fan
    return size


def load_name(query: str, batch_id: int, fan: int = FAN) -> str:
    return f"{query}.{batch_id + 1 - span(batch_id, fan):012d}-{batch_id:012d}"


def _parsed(name: str) -> tuple[str, int, int] | None:
    found = _SPAN.fullmatch(name)
    return found and (found[1], int(found[2]), int(found[3]))


def live_loads(names: list[str]) -> list[str]:
    """The loads that no larger load of their query contains."""
    spans = {name: _parsed(name) for name in names}
    widest: dict[str, list[tuple[int, int]]] = {}
    for parsed in sorted(filter(None, spans.values()), key=lambda p: (p[0], p[1], -p[2])):
        widest.setdefault(parsed[0], [])
        if not widest[parsed[0]] or widest[parsed[0]][-1][1] < parsed[2]:
            widest[parsed[0]].append(parsed[1:])
    return [n for n, p in spans.items() if p is None or p[1:] in widest[p[0]]]


def earlier_loads(names: list[str], query: str, batch_id: int) -> list[str]:
    """What counts as stored for a batch: everything but what the batch itself wrote before."""
    mine = [n for n in names if (p := _parsed(n)) and p[0] == query and p[2] >= batch_id]
    return live_loads([n for n in names if n not in mine])


def merged_loads(names: list[str], query: str, batch_id: int, fan: int = FAN) -> list[str]:
    """The stored loads that the batch's load takes in."""
    first = batch_id + 1 - span(batch_id, fan)
    return [n for n in names if (p := _parsed(n)) and p[0] == query and first <= p[1]]


# --- folders -------------------------------------------------------------------------------------

def _folder(spark: SparkSession, path: str):
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    return top, top.getFileSystem(spark._jsc.hadoopConfiguration())


def load_names(spark: SparkSession, path: str) -> list[str]:
    """All complete loads."""
    top, files = _folder(spark, path)
    if not files.exists(top):
        return []
    found = [s.getPath() for s in files.listStatus(top)]
    return sorted(p.getName()[5:] for p in found
                  if p.getName().startswith("load=") and files.exists(p.suffix("/_SUCCESS")))


def read_loads(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], HOSTS)
    return spark.read.schema(HOSTS).parquet(*[f"{path}/load={n}" for n in names])


def read_host_store(spark: SparkSession, path: str) -> DataFrame:
    """(scan_id, host), each once."""
    return read_loads(spark, path, live_loads(load_names(spark, path)))


def write_host_load(hosts: DataFrame, path: str, load: str) -> None:
    """One load; writing the same load again replaces it."""
    hosts.select("scan_id", "host").hint("rebalance").write.mode("overwrite").parquet(
        f"{path}/load={load}")


def drop_dead_loads(spark: SparkSession, path: str, query: str, batch_id: int) -> None:
    """Delete the loads that the committed batches before ``batch_id`` have merged."""
    names = [n for n in load_names(spark, path)
             if (p := _parsed(n)) and p[0] == query and p[2] < batch_id]
    _, files = _folder(spark, path)
    for name in set(names).difference(live_loads(names)):
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/load={name}"), True)


def compact_host_store(spark: SparkSession, path: str, target: str) -> None:
    """The whole store as one load of a new folder."""
    write_host_load(read_host_store(spark, path), target, "compacted")


def bulk_host_load(hosts: DataFrame, path: str, load: str) -> None:
    """The hosts of an empty store, each once."""
    write_host_load(bulk_load_hosts(hosts), path, load)


def clear_host_store(spark: SparkSession, path: str) -> None:
    top, files = _folder(spark, path)
    files.delete(top, True)


def host_counts(spark: SparkSession, path: str) -> DataFrame:
    return read_host_store(spark, path).groupBy("scan_id").agg(F.count("*").alias("hosts"))
