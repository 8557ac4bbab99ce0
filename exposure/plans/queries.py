"""The registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposure.functions import text
from exposure.functions.documents import body_of, epoch_micros
from exposure.operators import (
    checkpoints, compare, findings, fleet, hygiene, inventory, notify, progress,
)
from exposure.operators.joins import lookup_join
from exposure.plans import reports
from exposure.plans.bindings import AS_OF, AS_OF_EPOCH, frame, with_bindings
from exposure.schemas import (
    DEFAULT_SEVERITIES, FINGERPRINT_SAMPLE, PHASES, REQUIRED_FIELDS, REQUIRED_PHASE_FIELDS,
    SEVERITIES, STATISTICS,
)
from exposure.session import shared_dir
from exposure.sources import cachelog, folders, hoststore, linestore, readers, writers
from exposure.streaming import event_time, jobs, updates

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BATCH_SIZE = 10
LOST = "lost before the commit"

# Limits small enough to send the skewed relations through the sliced plan on the test tables.
HOT_HOSTS = 400
HOT_LOG_ROWS = 1_000


def query(bindings: list[str], sql: str | None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = with_bindings(bindings, sql)
        return fn
    return register


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


# --- pieces of SQL used by several checks ----------------------------------------------------

HOSTS_SQL = "select distinct scan_id, trim(line) as host from hosts_raw where trim(line) <> ''"
NAMES_SQL = "select distinct scan_id, trim(line) as host from host_names where trim(line) <> ''"
CLEAN_LINE_SQL = (
    r"trim(regexp_replace(line, chr(27) || '(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])', '', 'g'))"
)
PROBE_SQL = f"select scan_id, batch_id, {CLEAN_LINE_SQL} as line from probe_raw"


def authority_sql(column: str) -> str:
    return (
        f"case when regexp_matches({column}, '^https?://') "
        f"then regexp_extract({column}, '^https?://([^/?#]*)', 1) else {column} end"
    )


def host_key_sql(column: str) -> str:
    return rf"regexp_replace({authority_sql(column)}, '^[^@]*@|:\d+$', '', 'g')"


# Fixed value: the pattern of a valid host.
VALID_HOST_SQL = (
    r"regexp_matches(domain, '^([a-zA-Z0-9]([a-zA-Z0-9\-]{0,61}[a-zA-Z0-9])?\.)+[a-zA-Z]{2,}$')"
)
SEVERITY_SQL = (
    "case when contains(lower(line), '[critical]') then 'critical' "
    "when contains(lower(line), '[high]') then 'high' "
    "when contains(lower(line), '[medium]') then 'medium' "
    "when contains(lower(line), '[low]') then 'low' "
    "when contains(lower(line), '[info]') then 'info' end"
)
PARSED_DOCS_SQL = (
    "select scan_id, doc, expected_domain, try_cast(doc as json) as j from checkpoint_docs"
)
LATEST_PHASES_SQL = (
    "select scan_id, phase, arg_max(status, seq) as status, arg_max(progress, seq) as progress, "
    "arg_max(results_count, seq) as results_count, max(seq) as seq "
    "from phase_events group by scan_id, phase"
)


def one_decimal_sql(value: str) -> str:
    return (
        f"cast(cast(round(cast({value} as decimal(18,6)), 1) as decimal(18,1)) as varchar)"
    )


def skewed(df: DataFrame) -> DataFrame:
    """The same rows with a third of them moved into one scan."""
    scan = F.col("scan_id")
    return df.withColumn("scan_id", F.when(scan % 3 == 0, 0).otherwise(scan))


def skewed_sql(relation: str) -> str:
    return (
        "(select * replace (case when scan_id % 3 = 0 then 0 else scan_id end as scan_id) "
        f"from {relation})"
    )


# --- hosts -----------------------------------------------------------------------------------

def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hygiene.load_hosts(frame(spark, sf_dir, "hosts_raw"))


def probe_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hygiene.load_probe_lines(frame(spark, sf_dir, "probe_raw"))


def probed_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe_lines(spark, sf_dir).select(
        "scan_id", text.probe_target(F.col("line")).alias("host")
    )


@query(["hosts_raw"], HOSTS_SQL)
def load_hosts(spark, sf_dir):
    return hosts(spark, sf_dir)


@query(["probe_raw"], PROBE_SQL)
def load_probe_lines(spark, sf_dir):
    return probe_lines(spark, sf_dir)


@query(["findings"], "select scan_id, batch_id, seq, trim(line) as line from findings "
                     "where trim(line) <> ''")
def load_findings(spark, sf_dir):
    return hygiene.load_findings(frame(spark, sf_dir, "findings")).drop("ts")


@query(["batch_outputs"], "select batch_id, trim(line) as line from batch_outputs "
                          "where trim(line) <> ''")
def load_findings_glob(spark, sf_dir):
    path = shared_dir(spark, "results")
    frame(spark, sf_dir, "batch_outputs").select("batch_id", "line").write.partitionBy(
        "batch_id"
    ).text(path)
    return readers.load_findings_glob(spark, path, "part-*").select("batch_id", "line")


@query(["hosts_raw", "host_names"], f"""
select scan_id, host, domain, {VALID_HOST_SQL} as is_valid
from (select *, {authority_sql('host')} as domain from ({HOSTS_SQL} union all {NAMES_SQL}))
""")
def validate_hosts(spark, sf_dir):
    names = hygiene.load_hosts(frame(spark, sf_dir, "host_names"))
    return hygiene.validate_hosts(hosts(spark, sf_dir).unionByName(names))


@query(["host_names"], f"""
select scan_id, host, domain from (select *, {authority_sql('host')} as domain from ({NAMES_SQL}))
where not {VALID_HOST_SQL}
""")
def quarantined_hosts(spark, sf_dir):
    return hygiene.quarantined_hosts(hygiene.load_hosts(frame(spark, sf_dir, "host_names")))


@query(["hosts_raw"], HOSTS_SQL)
def write_sorted_hosts(spark, sf_dir):
    path = shared_dir(spark, "sorted-hosts")
    linestore.write_stored_lines(hosts(spark, sf_dir), path, "host", dedupe=True)
    return linestore.read_stored_lines(spark, path).withColumnRenamed("line", "host")


@query(["probe_raw"], f"select scan_id, line from ({PROBE_SQL})")
def write_sorted_probe_lines(spark, sf_dir):
    path = shared_dir(spark, "sorted-probes")
    linestore.write_stored_lines(probe_lines(spark, sf_dir), path)
    return linestore.read_stored_lines(spark, path)


@query(["hosts_raw", "probe_raw"], f"""
select h.* from ({HOSTS_SQL}) h anti join
(select scan_id, split_part(line, ' ', 1) as host from ({PROBE_SQL})) using (scan_id, host)
""")
def append_new_hosts(spark, sf_dir):
    stored = inventory.bulk_load_hosts(probed_hosts(spark, sf_dir))
    return inventory.append_new_hosts(stored, hosts(spark, sf_dir))


@query(["hosts_raw", "probe_raw"], f"""
select h.* from ({HOSTS_SQL}) h semi join
(select scan_id, split_part(line, ' ', 1) as host from ({PROBE_SQL})) using (scan_id, host)
""")
def known_hosts(spark, sf_dir):
    stored = inventory.bulk_load_hosts(probed_hosts(spark, sf_dir))
    return inventory.known_hosts(stored, hosts(spark, sf_dir))


@query(["hosts_raw"], f"select scan_id, count(*) as hosts from ({HOSTS_SQL}) group by scan_id")
def store_sizes(spark, sf_dir):
    return inventory.store_sizes(hosts(spark, sf_dir))


@query(["hosts_raw", "probe_raw"], f"""
select h.* from ({HOSTS_SQL}) h anti join
(select scan_id, split_part(line, ' ', 1) as host from ({PROBE_SQL})) using (scan_id, host)
""")
def resume_worklist(spark, sf_dir):
    return inventory.resume_worklist(hosts(spark, sf_dir), probed_hosts(spark, sf_dir))


_ANSWERED_SQL = f"""
select distinct scan_id, {host_key_sql("split_part(line, ' ', 1)")} as k from ({PROBE_SQL})
"""


@query(["hosts_raw", "probe_raw"], f"""
select scan_id, host from (select *, {host_key_sql('host')} as k from ({HOSTS_SQL}))
semi join ({_ANSWERED_SQL}) using (scan_id, k)
""")
def alive_hosts(spark, sf_dir):
    return inventory.alive_hosts(hosts(spark, sf_dir), probe_lines(spark, sf_dir))


@query(["hosts_raw", "probe_raw"], f"""
select scan_id, host from (select *, {host_key_sql('host')} as k from ({HOSTS_SQL}))
anti join ({_ANSWERED_SQL}) using (scan_id, k)
""")
def dead_hosts(spark, sf_dir):
    return inventory.dead_hosts(hosts(spark, sf_dir), probe_lines(spark, sf_dir))


@query(["hosts_raw", "probe_raw"], f"""
select scan_id, host from (select *, {host_key_sql('host')} as k from {skewed_sql(f"({HOSTS_SQL})")})
anti join (select * from {skewed_sql(f"({_ANSWERED_SQL})")}) using (scan_id, k)
""")
def dead_hosts_hot(spark, sf_dir):
    return inventory.dead_hosts(
        skewed(hosts(spark, sf_dir)), skewed(probe_lines(spark, sf_dir)),
    )


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "cache_requests").select(
        "scan_id", F.array(F.lit("enumerate"), F.lit("-d"), F.col("host")).alias("argv")
    )


_CACHE_SQL = f"""
select scan_id, md5('enumerate -d ' || host) as cache_key,
  coalesce(l.ts > timestamp '{AS_OF}' - interval 86400 second and length(l.result) > 0, false)
    as is_hit,
  case when l.ts > timestamp '{AS_OF}' - interval 86400 second and length(l.result) > 0
    then l.result end as result
from cache_requests left join
(select cache_key, arg_max(result, seq) as result, max(ts) as ts from result_cache
 group by cache_key) l on l.cache_key = md5('enumerate -d ' || host)
"""


@query(["cache_requests", "result_cache"], _CACHE_SQL)
def cache_lookup(spark, sf_dir):
    return inventory.cache_lookup(
        _requests(spark, sf_dir), frame(spark, sf_dir, "result_cache"), as_of()
    ).drop("argv")


@query(["cache_requests", "result_cache"],
       f"select distinct cache_key from ({_CACHE_SQL}) where not is_hit")
def cache_misses(spark, sf_dir):
    return inventory.cache_misses(
        _requests(spark, sf_dir), frame(spark, sf_dir, "result_cache"), as_of()
    ).select("cache_key")


@query(["cache_requests", "result_cache"], f"""
select scan_id, true as is_hit, case when is_hit then result else 'run ' || cache_key end as result
from ({_CACHE_SQL})
""")
def cache_refresh(spark, sf_dir):
    """Store a new result for every miss, then look everything up again."""
    requests, cache = _requests(spark, sf_dir), frame(spark, sf_dir, "result_cache")
    run_again = inventory.cache_misses(requests, cache, as_of()).select(
        "argv", F.lit(0).cast("bigint").alias("seq"),
        F.concat(F.lit("run "), "cache_key").alias("result"),
    )
    refreshed = cache.unionByName(inventory.cache_entries(run_again, as_of()))
    return inventory.cache_lookup(requests, refreshed, as_of()).select(
        "scan_id", "is_hit", "result"
    )


@query(["cache_requests", "result_cache"], _CACHE_SQL)
def stored_cache(spark, sf_dir):
    """The same lookups in a log of cache files: five appends, one of them repeated."""
    path, entries = shared_dir(spark, "cache"), frame(spark, sf_dir, "result_cache")
    # entries without a time are older than all others
    untimed = entries.where("seq % 50 = 0").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    part = F.pmod(F.xxhash64("seq"), F.lit(5))
    for number in (0, 1, 2, 3, 3, 4):
        cachelog.append_cache(
            entries.unionByName(untimed).where(part == number), path, number)
    return inventory.cache_lookup(
        _requests(spark, sf_dir), cachelog.read_cache_log(spark, path), as_of()).drop("argv")


# --- findings --------------------------------------------------------------------------------

def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.tag_severity(hygiene.load_findings(frame(spark, sf_dir, "findings")))


@query(["findings"], f"select scan_id, seq, {SEVERITY_SQL} as severity from findings")
def tag_severity(spark, sf_dir):
    return tagged(spark, sf_dir).select("scan_id", "seq", "severity")


@query(["findings"], f"""
select scan_id, severity, count(*) as findings,
  cast(list_position(['critical','high','medium','low','info'], severity) as integer)
    as severity_rank,
  upper(severity[1]) || severity[2:] as label
from (select scan_id, {SEVERITY_SQL} as severity from findings)
where severity is not null group by scan_id, severity
""")
def severity_counts(spark, sf_dir):
    return findings.severity_counts(tagged(spark, sf_dir))


@query(["findings"], f"""
select scan_id, seq, severity from (select scan_id, seq, {SEVERITY_SQL} as severity from findings)
where severity in ('critical', 'high', 'medium')
""")
def filter_severity(spark, sf_dir):
    return findings.filter_severity(tagged(spark, sf_dir), list(DEFAULT_SEVERITIES)).select(
        "scan_id", "seq", "severity"
    )


@query(["findings"], f"""
select scan_id, seq, severity from (select scan_id, seq, {SEVERITY_SQL} as severity from findings)
where severity in ('critical', 'high', 'medium')
""")
def filter_severity_stored(spark, sf_dir):
    """The same request on findings that were stored by severity: other levels are not read."""
    path = shared_dir(spark, "tagged")
    writers.write_tagged_findings(tagged(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return findings.filter_severity(stored, list(DEFAULT_SEVERITIES)).select(
        "scan_id", "seq", "severity"
    )


def _severity_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "severity_requests").select(
        "scan_id", text.comma_list(F.col("wanted")).alias("severities")
    )


_WANTED_SQL = "list_transform(string_split(wanted, ','), lambda x: trim(x))"


@query(["findings", "severity_requests"], f"""
select scan_id, seq, severity
from (select scan_id, seq, {SEVERITY_SQL} as severity from findings)
left join severity_requests using (scan_id)
where wanted is null or list_contains({_WANTED_SQL}, severity)
""")
def filter_severity_requests(spark, sf_dir):
    return findings.filter_severity_requests(
        tagged(spark, sf_dir), _severity_requests(spark, sf_dir)
    ).select("scan_id", "seq", "severity")


@query(["findings", "severity_requests"], f"""
select scan_id, seq, severity
from (select scan_id, seq, {SEVERITY_SQL} as severity from {skewed_sql("findings")})
left join severity_requests using (scan_id)
where wanted is null or list_contains({_WANTED_SQL}, severity)
""")
def filter_severity_requests_hot(spark, sf_dir):
    return findings.filter_severity_requests(
        skewed(tagged(spark, sf_dir)), _severity_requests(spark, sf_dir)
    ).select("scan_id", "seq", "severity")


@query(["severity_requests"], f"""
select scan_id, wanted is null or len(list_filter({_WANTED_SQL},
  lambda x: x not in ('critical', 'high', 'medium', 'low', 'info'))) = 0 as is_valid
from severity_requests
""")
def check_severity_requests(spark, sf_dir):
    return findings.check_severity_requests(_severity_requests(spark, sf_dir)).drop("severities")


@query(["findings"], """
select scan_id, position, line, greatest(total - 10, 0) as more_findings from (
  select scan_id, line, count(*) over (partition by scan_id) as total,
    cast(row_number() over (partition by scan_id order by seq) as integer) as position
  from findings) where position <= 10
""")
def finding_preview(spark, sf_dir):
    lines = hygiene.load_findings(frame(spark, sf_dir, "findings"))
    return findings.finding_preview(lines, ["seq"])


def _batch_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    outputs = frame(spark, sf_dir, "batch_outputs")
    records = outputs.groupBy("scan_id", "batch_id", "path").agg(F.max("error").alias("error"))
    inventory_rows = outputs.groupBy("path").agg(
        F.sum(F.length(text.stripped(F.col("line")))).alias("length")
    )
    return records, inventory_rows, outputs.select("path", "seq", "line")


_KEPT_FILES_SQL = """
records as (select scan_id, batch_id, path, max(error) as error from batch_outputs
  group by scan_id, batch_id, path),
kept as (select scan_id, path, min(batch_id) as batch_id from records
  where path in (select path from batch_outputs group by path having sum(length(trim(line))) > 0)
  group by scan_id, path)
"""


@query(["batch_outputs"], f"""
, {_KEPT_FILES_SQL}
select kept.scan_id, kept.batch_id, path, seq, trim(line) as line
from kept join (select path, seq, line from batch_outputs) using (path) where trim(line) <> ''
""")
def consolidate_findings(spark, sf_dir):
    return findings.consolidate_findings(*_batch_files(spark, sf_dir))


@query(["batch_outputs"], f"""
, {_KEPT_FILES_SQL}
select scan_id, batches, batch_errors, coalesce(files, 0) as files,
  coalesce(findings, 0) as findings
from (select scan_id, count(distinct batch_id) as batches,
        count(distinct case when error is not null then batch_id end) as batch_errors
      from records group by scan_id)
left join (select kept.scan_id, count(distinct path) as files, count(*) as findings
      from kept join (select path, line from batch_outputs where trim(line) <> '') using (path)
      group by kept.scan_id) using (scan_id)
""")
def consolidation_totals(spark, sf_dir):
    return findings.consolidation_totals(*_batch_files(spark, sf_dir))


def _reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan state whose summary is one finding too high for every tenth scan; the state of some
    scans stands under another scan_id, so that these have lines and no state."""
    scan = F.col("scan_id")
    return frame(spark, sf_dir, "findings").groupBy("scan_id").agg(
        F.count(F.lit(1)).alias("_n")
    ).select(
        F.when(scan % 25 == 7, -scan).otherwise(scan).alias("scan_id"),
        (F.col("_n") + F.when(F.col("scan_id") % 10 == 0, 1).otherwise(0)).alias("vulnerabilities"),
    )


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines of the scans whose last event was no error; the others were never written."""
    failed = (
        frame(spark, sf_dir, "event_kinds").groupBy("scan_id")
        .agg(F.max_by("kind", "seq").alias("_last")).filter(F.col("_last") == "error")
    )
    return lookup_join(
        hygiene.load_findings(frame(spark, sf_dir, "findings")), failed.select("scan_id"),
        ["scan_id"], "left_anti",
    )


_STATE_SQL = """
state as (select case when scan_id % 25 = 7 then -scan_id else scan_id end as scan_id,
    count(*) + case when scan_id % 10 = 0 then 1 else 0 end as reported
  from findings group by findings.scan_id),
failed as (select scan_id from event_kinds group by scan_id having arg_max(kind, seq) = 'error')
"""


@query(["findings", "event_kinds"], f"""
, {_STATE_SQL}
select *, counted - classified as unclassified, reported <> counted as is_mismatch,
  reported > 0 and counted = 0 as needs_rebuild
from (select scan_id, coalesce(reported, 0) as reported, reported is not null as has_state,
        coalesce(counted, 0) as counted, coalesce(classified, 0) as classified
      from state full join (select scan_id, count(*) as counted,
          count({SEVERITY_SQL}) as classified
        from findings where scan_id not in (select scan_id from failed) group by scan_id)
      using (scan_id))
""")
def reconcile_findings(spark, sf_dir):
    return findings.reconcile_findings(_reported(spark, sf_dir), _written(spark, sf_dir))


@query(["findings", "event_kinds"], f"""
, {_STATE_SQL}
select scan_id, batch_id, seq, line from findings
where scan_id in (select scan_id from failed) and scan_id in (select scan_id from state)
""")
def rebuild_empty_results(spark, sf_dir):
    return findings.rebuild_empty_results(
        _reported(spark, sf_dir), _written(spark, sf_dir), frame(spark, sf_dir, "findings")
    ).drop("ts")


@query(["findings", "event_kinds"], f"""
, {_STATE_SQL}
select scan_id, line from findings
where scan_id not in (select scan_id from failed) or scan_id in (select scan_id from state)
""")
def write_findings(spark, sf_dir):
    """Write the readable results, then add the rebuilt ones to the scans that had none."""
    path = shared_dir(spark, "findings")
    written, reported = _written(spark, sf_dir), _reported(spark, sf_dir)
    linestore.write_stored_lines(written, path)
    linestore.write_stored_lines(findings.rebuild_empty_results(
        reported, written, frame(spark, sf_dir, "findings")), path)
    return linestore.read_stored_lines(spark, path)


@query(["hosts_raw", "probe_raw", "findings"], f"""
select scan_id, cast(sum(hosts) as bigint) as hosts, cast(sum(alive) as bigint) as alive,
  cast(sum(findings) as bigint) as findings
from (select scan_id, count(*) as hosts, 0 as alive, 0 as findings from ({HOSTS_SQL}) group by 1
  union all select scan_id, 0, count(*), 0 from probe_raw group by 1
  union all select scan_id, 0, 0, count(*) from findings group by 1)
group by scan_id
""")
def scan_funnel(spark, sf_dir):
    return findings.scan_funnel(
        hosts(spark, sf_dir), probe_lines(spark, sf_dir),
        hygiene.load_findings(frame(spark, sf_dir, "findings")),
    )


# --- progress --------------------------------------------------------------------------------

def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hygiene.load_hosts(frame(spark, sf_dir, "host_names"))


def _batches_sql(relation: str) -> str:
    return f"""
select scan_id, host,
  (row_number() over (partition by scan_id order by host) - 1) // {BATCH_SIZE} as batch_id
from {relation}
"""


@query(["host_names"], _batches_sql(f"({NAMES_SQL})"))
def assign_batches(spark, sf_dir):
    return progress.assign_batches(_targets(spark, sf_dir), BATCH_SIZE)


@query(["host_names"], _batches_sql(skewed_sql(f"({NAMES_SQL})")))
def assign_batches_hot(spark, sf_dir):
    return progress.assign_batches(skewed(_targets(spark, sf_dir)), BATCH_SIZE, HOT_HOSTS)


@query(["host_names"], f"""
select scan_id, count(*) as targets, cast(ceil(count(*) / {BATCH_SIZE}) as bigint) as batches
from ({NAMES_SQL}) group by scan_id
""")
def batch_totals(spark, sf_dir):
    return progress.batch_totals(_targets(spark, sf_dir), BATCH_SIZE)


@query(["findings"], """
select scan_id, batch_id, n, results_count, total_batches,
  cast(trunc(batch_id / total_batches * 100) as integer) as progress_before,
  cast(trunc((batch_id + 1) / total_batches * 100) as integer) as progress_after
from (select scan_id, batch_id, n,
        cast(sum(n) over (partition by scan_id order by batch_id) as bigint) as results_count,
        max(batch_id) over (partition by scan_id) + 1 as total_batches
      from (select scan_id, batch_id, count(*) as n from findings group by scan_id, batch_id))
""")
def batch_progress(spark, sf_dir):
    batches = frame(spark, sf_dir, "findings").groupBy("scan_id", "batch_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return progress.batch_progress(batches)


def _status_transitions_sql(relation: str) -> str:
    return f"""
select scan_id, seq, previous_status, status from (
  select scan_id, seq, status,
    lag(status) over (partition by scan_id order by ts, seq) as previous_status
  from {relation} where status <> '')
where status is distinct from previous_status
"""


@query(["status_log"], _status_transitions_sql("status_log"))
def status_transitions(spark, sf_dir):
    return progress.status_transitions(frame(spark, sf_dir, "status_log")).drop("ts")


@query(["status_log"], _status_transitions_sql(skewed_sql("status_log")))
def status_transitions_hot(spark, sf_dir):
    return progress.status_transitions(
        skewed(frame(spark, sf_dir, "status_log")), max_group_rows=HOT_LOG_ROWS
    ).drop("ts")


@query(["status_log"], f"""
select scan_id, count(*) as transitions from ({_status_transitions_sql("status_log")})
group by scan_id
""")
def transition_counts(spark, sf_dir):
    return jobs.transition_counts(
        progress.status_transitions(frame(spark, sf_dir, "status_log"))
    )


def _progress_increments_sql(relation: str) -> str:
    return f"""
select scan_id, seq, results_count, greatest(results_count - greatest(coalesce(
  max(results_count) over (partition by scan_id order by ts, seq
    rows between unbounded preceding and 1 preceding), 0), 0), 0) as increment
from {relation}
"""


@query(["phase_events"], _progress_increments_sql("phase_events"))
def progress_increments(spark, sf_dir):
    return progress.progress_increments(
        frame(spark, sf_dir, "phase_events"), "results_count"
    ).select("scan_id", "seq", "results_count", "increment")


@query(["phase_events"], _progress_increments_sql(skewed_sql("phase_events")))
def progress_increments_hot(spark, sf_dir):
    return progress.progress_increments(
        skewed(frame(spark, sf_dir, "phase_events")), "results_count",
        max_group_rows=HOT_LOG_ROWS,
    ).select("scan_id", "seq", "results_count", "increment")


def _memory_profile_sql(relation: str) -> str:
    return f"""
select scan_id, seq, label, memory_mb,
  max(memory_mb) over (partition by scan_id order by ts, seq) as peak_mb,
  memory_mb > 819.2 as is_high
from {relation}
"""


@query(["measurements"], _memory_profile_sql("measurements"))
def memory_profile(spark, sf_dir):
    return progress.memory_profile(frame(spark, sf_dir, "measurements")).drop("ts")


@query(["measurements"], _memory_profile_sql(skewed_sql("measurements")))
def memory_profile_hot(spark, sf_dir):
    return progress.memory_profile(
        skewed(frame(spark, sf_dir, "measurements")), max_group_rows=HOT_LOG_ROWS
    ).drop("ts")


@query(["measurements"], """
select scan_id, max(memory_mb) as peak_mb, count(*) as samples,
  count(*) filter (memory_mb > 40) as high_samples
from measurements group by scan_id
""")
def memory_peaks(spark, sf_dir):
    return progress.memory_peaks(frame(spark, sf_dir, "measurements"), threshold_mb=50)


@query(["measurements"], """
select scan_id, part, any_value(peak) as peak_usage, count(*) as samples,
  arg_min(label, seq) as first_label, arg_max(label, seq) as last_label
from (select *, (row_number() over (partition by scan_id order by ts, seq) - 1) // 20 as part,
        max(memory_mb) over (partition by scan_id) as peak
      from measurements) group by scan_id, part
""")
def memory_documents(spark, sf_dir):
    documents = progress.memory_documents(frame(spark, sf_dir, "measurements"), 20)
    return documents.select(
        "scan_id", "part", "peak_usage", F.size("measurements").cast("bigint").alias("samples"),
        F.element_at("measurements", 1)["label"].alias("first_label"),
        F.element_at("measurements", -1)["label"].alias("last_label"),
    )


@query(["phase_events"], LATEST_PHASES_SQL)
def latest_phase_status(spark, sf_dir):
    return progress.latest_phase_status(frame(spark, sf_dir, "phase_events")).drop("ts")


@query(["scan_starts"], f"""
select scan_id, start_time, duration, case when duration < 60
  then {one_decimal_sql('duration')} || 's'
  else {one_decimal_sql('duration / 60')} || 'm' end as duration_text
from (select *, {AS_OF_EPOCH} - start_time as duration
      from (select scan_id, epoch_us(max(ts)) / 1e6 as start_time from scan_starts
            group by scan_id))
""")
def scan_durations(spark, sf_dir):
    starts = frame(spark, sf_dir, "scan_starts").groupBy("scan_id").agg(F.max("ts").alias("ts"))
    state = starts.select("scan_id", (epoch_micros(F.col("ts")) / 1e6).alias("start_time"))
    return progress.scan_durations(state, float(AS_OF_EPOCH))


# --- scan-state documents --------------------------------------------------------------------

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "checkpoint_docs")


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.load_checkpoints(documents(spark, sf_dir))


@query(["checkpoint_docs"], f"""
select scan_id, case when j is null then 'corrupt' when not json_exists(j, '$.scan_id')
    then 'no_scan_id' else 'loaded' end as load_status,
  j->>'$.scan_id' as checkpoint_id, j->>'$.domain' as domain, j->>'$.status' as status,
  coalesce(cast(j->>'$.phases.subdomain_enumeration.checkpoint.batch_index' as integer), -1)
    as batch_index,
  coalesce(cast(j->>'$.phases.alive_check.progress_percentage' as integer), -1)
    as alive_progress,
  coalesce(cast(j->>'$.statistics.subdomains_found' as bigint), -1) as subdomains_found
from ({PARSED_DOCS_SQL})
""")
def load_checkpoints(spark, sf_dir):
    phase = lambda name: F.try_element_at("phases", F.lit(name))
    return loaded(spark, sf_dir).select(
        "scan_id", "load_status", "checkpoint_id", "domain", "status",
        phase("subdomain_enumeration")["checkpoint"]["batch_index"].alias("batch_index"),
        phase("alive_check")["progress_percentage"].alias("alive_progress"),
        F.col("statistics.subdomains_found").alias("subdomains_found"),
    ).na.fill(-1)


@query(["state_docs"], """
select scan_id, j is not null as is_readable, coalesce(j->>'$.status', 'unknown') as status,
  case coalesce(j->>'$.status', 'unknown') when 'failed' then 'error'
    else coalesce(j->>'$.status', 'unknown') end as display_status,
  cast(j->>'$.start_time' as double) as start_time,
  coalesce(cast(j->>'$.duration' as double), 0) as duration,
  coalesce(cast(j->>'$.subdomains' as bigint), 0) as subdomains,
  coalesce(cast(j->>'$.alive_subdomains' as bigint), 0) as alive_subdomains,
  coalesce(cast(j->>'$.vulnerabilities' as bigint), 0) as vulnerabilities
from (select scan_id, try_cast(doc as json) as j from state_docs)
""")
def load_scan_state(spark, sf_dir):
    return readers.load_scan_state(frame(spark, sf_dir, "state_docs")).drop("error")


def _missing_sql(names: tuple[str, ...], message: str, path: str) -> str:
    return ", ".join(
        f"case when not json_exists(j, '{path}.{name}') then '{message}{name}' end"
        for name in names
    )


_PHASE_FIELDS = dict(zip(
    REQUIRED_PHASE_FIELDS, ("status", "progress percentage", "results count")
))
_PHASE_ISSUES_SQL = ", ".join(
    f"case when not json_exists(j, '$.phases.{p}') then 'Missing phase: {p}' end, " + ", ".join(
        f"case when json_exists(j, '$.phases.{p}') and not json_exists(j, '$.phases.{p}.{field}') "
        f"then 'Missing {label} in phase: {p}' end" for field, label in _PHASE_FIELDS.items())
    for p in PHASES
)

_ISSUES_SQL = f"""
select scan_id, cast(len(issues) as integer) as n_issues, len(issues) = 0 as is_valid,
  array_to_string(issues, '; ') as issues
from (select scan_id, case when j is null or j = '{{}}' then ['Checkpoint not initialized']
        when len(top) > 0 then top else nested end as issues
      from (select *,
        list_filter([{_missing_sql(REQUIRED_FIELDS, 'Missing required field: ', '$')}],
          lambda x: x is not null) as top,
        list_filter([case when (j->>'$.domain') <> expected_domain then 'Domain mismatch: '
            || (j->>'$.domain') || ' (checkpoint) vs ' || expected_domain || ' (current)' end,
          {_PHASE_ISSUES_SQL},
          {_missing_sql(STATISTICS, 'Missing statistic: ', '$.statistics')}],
          lambda x: x is not null) as nested
        from ({PARSED_DOCS_SQL})))
"""


def _listed_issues(issues: DataFrame) -> DataFrame:
    return issues.select(
        "scan_id", F.size("issues").alias("n_issues"), "is_valid",
        F.array_join("issues", "; ").alias("issues"),
    )


@query(["checkpoint_docs"], _ISSUES_SQL)
def checkpoint_issues(spark, sf_dir):
    return _listed_issues(checkpoints.checkpoint_issues(documents(spark, sf_dir)))


@query(["checkpoint_docs"], f"""
select scan_id, j is not null as is_repaired,
  case when j is null then '' else array_to_string(list_filter([
    {_missing_sql(REQUIRED_FIELDS, '', '$')}, {_missing_sql(PHASES, '', '$.phases')}],
    lambda x: x is not null), ',') end as added,
  case when j is null then null else coalesce(j->>'$.domain', expected_domain) end as domain,
  case when j is null then null
    when json_exists(j, '$.phases.alive_check') then j->>'$.phases.alive_check.status'
    else 'pending' end as alive_status,
  j->>'$.phases.subdomain_enumeration.status' as enumeration_status,
  case when j is null then 'Checkpoint not initialized'
    else array_to_string(list_filter([
      case when (j->>'$.domain') <> expected_domain then 'Domain mismatch: '
        || (j->>'$.domain') || ' (checkpoint) vs ' || expected_domain || ' (current)' end,
      case when json_exists(j, '$.phases.alive_check') and json_type(j, '$.phases.alive_check')
        <> 'OBJECT' then 'Missing status in phase: alive_check; Missing progress percentage in '
        || 'phase: alive_check; Missing results count in phase: alive_check' end,
      {_missing_sql(STATISTICS, 'Missing statistic: ', '$.statistics')}],
      lambda x: x is not null), '; ') end as issues_left
from (select * replace (case when j <> '{{}}' then j end as j) from ({PARSED_DOCS_SQL}))
""")
def repair_checkpoints(spark, sf_dir):
    repaired = checkpoints.repair_checkpoints(documents(spark, sf_dir), as_of())
    checked = checkpoints.checkpoint_issues(
        checkpoints.load_checkpoints(repaired),
        keep=("is_repaired", "added", "domain", "phases"),
    )
    status = lambda name: F.when(
        F.col("is_repaired"), F.try_element_at("phases", F.lit(name))["status"]
    )
    return checked.select(
        "scan_id", "is_repaired", F.array_join("added", ",").alias("added"),
        F.when(F.col("is_repaired"), F.col("domain")).alias("domain"),
        status("alive_check").alias("alive_status"),
        status("subdomain_enumeration").alias("enumeration_status"),
        F.array_join("issues", "; ").alias("issues_left"),
    )


@query(["checkpoint_docs"], f"""
select scan_id, j is not null as is_readable, cast(null as varchar) as position,
  j->>'$.phases.subdomain_enumeration.results_count' as results_count,
  j->>'$.phases.alive_check.progress_percentage' as alive_progress, j->>'$.domain' as domain
from ({PARSED_DOCS_SQL})
""")
def compact_checkpoints(spark, sf_dir):
    readable = body_of(F.col("doc")).isNotNull()
    value = lambda path: F.when(readable, F.get_json_object("doc", path))
    compacted = checkpoints.compact_checkpoints(documents(spark, sf_dir))
    return compacted.select(
        "scan_id", readable.alias("is_readable"),
        value("$.phases.subdomain_enumeration.checkpoint").alias("position"),
        value("$.phases.subdomain_enumeration.results_count").alias("results_count"),
        value("$.phases.alive_check.progress_percentage").alias("alive_progress"),
        value("$.domain").alias("domain"),
    )


@query(["checkpoint_docs"], f"""
select scan_id, j->>'$.scan_id' as checkpoint_id, j->>'$.domain' as domain,
  j->>'$.status' as status, array_to_string(list_filter([
    {", ".join(f"'{p}=' || (j->>'$.phases.{p}.status')" for p in sorted(PHASES))}],
    lambda x: x is not null), ',') as phase_status,
  cast(j->>'$.statistics.subdomains_found' as bigint) as subdomains_found
from ({PARSED_DOCS_SQL}) where json_exists(j, '$.scan_id')
""")
def scan_summary(spark, sf_dir):
    entries = F.transform(
        F.map_entries("phase_status"),
        lambda e: F.concat(e["key"], F.lit("="), e["value"]),
    )
    return checkpoints.scan_summary(loaded(spark, sf_dir)).select(
        "scan_id", "checkpoint_id", "domain", "status",
        F.array_join(F.sort_array(entries), ",").alias("phase_status"),
        F.col("statistics.subdomains_found").alias("subdomains_found"),
    )


_PHASE_ROWS_SQL = " union all ".join(
    f"select scan_id, {i} as position, '{p}' as phase, '{label}' as phase_label, "
    f"json_extract(j, '$.phases.{p}') as r from parsed"
    for i, (p, label) in enumerate(
        zip(PHASES, ("Subdomain Enumeration", "Alive Check", "Vulnerability Scan")), start=1
    )
)


@query(["checkpoint_docs"], f"""
, parsed as ({PARSED_DOCS_SQL}), phase_rows as ({_PHASE_ROWS_SQL})
select scan_id, phase, phase_label,
  case r->>'$.status' when 'completed' then 'Completed' when 'in_progress' then 'In_Progress'
    when 'pending' then 'Pending' end as status_label,
  (r->>'$.progress_percentage') || '%' as progress,
  cast(r->>'$.results_count' as bigint) as results
from phase_rows where r is not null
""")
def phase_table(spark, sf_dir):
    return checkpoints.phase_table(loaded(spark, sf_dir))


@query(["checkpoint_docs"], f"""
select scan_id, 'Subdomains Found' as metric,
  cast(j->>'$.statistics.subdomains_found' as bigint) as value
from ({PARSED_DOCS_SQL}) where json_exists(j, '$.statistics')
""")
def statistics_table(spark, sf_dir):
    return checkpoints.statistics_table(loaded(spark, sf_dir))


@query(["checkpoint_docs"], f"""
, parsed as ({PARSED_DOCS_SQL}), phase_rows as ({_PHASE_ROWS_SQL})
select scan_id, position, phase, r->>'$.status' as status from phase_rows
where (r->>'$.status') is distinct from 'completed'
""")
def pending_phases(spark, sf_dir):
    return checkpoints.pending_phases(loaded(spark, sf_dir))


@query(["checkpoint_docs"], f"""
, parsed as ({PARSED_DOCS_SQL}), phase_rows as ({_PHASE_ROWS_SQL})
select scan_id, position, phase, r->>'$.status' as status from phase_rows
where position >= 2 or (r->>'$.status') is distinct from 'completed'
""")
def forced_phases(spark, sf_dir):
    return checkpoints.pending_phases(loaded(spark, sf_dir), force_phase="alive_check")


@query(["checkpoint_docs"], f"""
, parsed as ({PARSED_DOCS_SQL}), phase_rows as ({_PHASE_ROWS_SQL})
select scan_id, phase, r->>'$.status' as status,
  coalesce(cast(r->>'$.progress_percentage' as integer), -1) as progress_percentage,
  coalesce(cast(r->>'$.results_count' as bigint), -1) as results_count
from phase_rows where phase = 'alive_check'
""")
def phase_record(spark, sf_dir):
    return checkpoints.phase_record(loaded(spark, sf_dir), "alive_check").drop(
        "checkpoint"
    ).na.fill(-1)


@query(["new_scans"], """
select scan_id, '{"scan_id":"' || domain || '-1706659200-'
  || substr(md5(domain || '-1706659200'), 1, 8) || '","domain":"' || domain
  || '","start_time":"2024-01-31T00:00:00","last_update":"2024-01-31T00:00:00",'
  || '"status":"in_progress","phases":{"subdomain_enumeration":{"status":"pending",'
  || '"progress_percentage":0,"results_count":0},"alive_check":{"status":"pending",'
  || '"progress_percentage":0,"results_count":0},"vulnerability_scan":{"status":"pending",'
  || '"progress_percentage":0,"results_count":0}},"statistics":{"subdomains_found":0,'
  || '"alive_subdomains":0,"vulnerabilities_found":0},"environment":{"tool_versions":{"probe":"'
  || version || '"},"templates_hash":""}}' as doc
from new_scans
""")
def init_checkpoints(spark, sf_dir):
    scans = frame(spark, sf_dir, "new_scans").withColumn(
        "tool_versions", F.create_map(F.lit("probe"), F.col("version"))
    )
    return checkpoints.init_checkpoints(scans)


@query(["checkpoint_docs"], """
select scan_id, '20240131_000000' as snapshot, 'scan_state_20240131_000000.json' as file_name, doc
from checkpoint_docs
""")
def snapshot_checkpoints(spark, sf_dir):
    return checkpoints.snapshot_checkpoints(documents(spark, sf_dir), as_of())


@query(["checkpoint_docs", "document_updates"], """
select scan_id, arg_max(seq, seq) as seq, arg_max(doc, seq) as doc
from (select scan_id, -1 as seq, doc from checkpoint_docs
      union all select scan_id, seq, doc from document_updates) group by scan_id
""")
def upsert_checkpoints(spark, sf_dir):
    current = documents(spark, sf_dir).select(
        "scan_id", F.lit("2023-12-31 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit(-1).cast("bigint").alias("seq"), "doc",
    )
    updates = frame(spark, sf_dir, "document_updates")
    return checkpoints.upsert_checkpoints(current, updates).drop("ts")


@query(["files"], """
select scan_id, path, mtime_s from (select *, row_number() over (partition by scan_id
  order by mtime_s desc, path) as n from files) where n > 5
""")
def expired_snapshots(spark, sf_dir):
    return checkpoints.expired_snapshots(
        frame(spark, sf_dir, "files").select("scan_id", "path", "mtime_s")
    )


@query(["files"], f"""
select scan_id, path, mtime_s from (select *, row_number() over (partition by scan_id
  order by mtime_s desc, path) as n from {skewed_sql("files")}) where n > 5
""")
def expired_snapshots_hot(spark, sf_dir):
    files = skewed(frame(spark, sf_dir, "files").select("scan_id", "path", "mtime_s"))
    return checkpoints.expired_snapshots(files)


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(loaded(spark, sf_dir))


def _typed(documents_read: DataFrame) -> DataFrame:
    return documents_read.select(
        "scan_id", "load_status", "phases", "statistics", "status",
        F.col("environment.templates_hash").alias("templates_hash"),
        F.col("last_update").cast("timestamp_ntz").alias("last_update"),
        "held_phases", "held_statistics", "has_environment",
    )


_BASE_SQL = f"""
base as (select scan_id, j, j is not null and json_exists(j, '$.scan_id') as is_loaded,
    cast(j->>'$.last_update' as timestamp) as last_update
  from ({PARSED_DOCS_SQL}))
"""
_HELD_PHASES_SQL = "held as (" + " union all ".join(
    f"select scan_id, '{p}' as phase from base "
    f"where is_loaded and json_type(j, '$.phases.{p}') = 'OBJECT'" for p in PHASES) + ")"
_HELD_STATISTICS_SQL = "held as (" + " union all ".join(
    f"select scan_id, '{s}' as name from base "
    f"where is_loaded and json_exists(j, '$.statistics.{s}')" for s in STATISTICS) + ")"
_HELD_FIELDS_SQL = (
    "held as (select scan_id, 'status' as name from base where is_loaded union all "
    "select scan_id, 'templates_hash' from base "
    "where is_loaded and json_type(j, '$.environment') = 'OBJECT')"
)
_SHORT = dict(zip(PHASES, ("enumeration", "alive", "vulnerability")))


def _last_update_us():
    return F.coalesce(epoch_micros(F.col("last_update")), F.lit(-1)).alias("last_update_us")


def _flat_phases(field: str) -> list:
    return [
        F.try_element_at("phases", F.lit(phase))[field].alias(short)
        for phase, short in _SHORT.items()
    ]


def _flat_statistics() -> list:
    return [F.col("statistics")[s].alias(s) for s in STATISTICS]


def _flat_positions() -> list:
    return [
        F.try_element_at("phases", F.lit(phase))["checkpoint"][field].alias(f"{field}_{short}")
        for phase, short in _SHORT.items() for field in checkpoints.POSITION
    ]


@query(["checkpoint_docs", "phase_events"], f"""
, {_BASE_SQL}, {_HELD_PHASES_SQL},
known as (select * from ({LATEST_PHASES_SQL})
  join (select scan_id, phase, max(ts) as ts from phase_events group by scan_id, phase)
  using (scan_id, phase) semi join held using (scan_id, phase))
select base.scan_id,
  {", ".join(
      f"coalesce(max(case when phase = '{p}' then known.status end), any_value(j->>'$.phases.{p}.status')) as {s}"
      for p, s in _SHORT.items())},
  coalesce(epoch_us(greatest(last_update, max(ts))), -1) as last_update_us
from base left join known using (scan_id) group by base.scan_id, j, last_update
""")
def apply_phase_events(spark, sf_dir):
    applied = checkpoints.apply_phase_events(
        _base(spark, sf_dir), frame(spark, sf_dir, "phase_events")
    )
    return applied.select("scan_id", *_flat_phases("status"), _last_update_us())


@query(["checkpoint_docs", "phase_events"], f"""
, {_BASE_SQL}, {_HELD_PHASES_SQL}
select scan_id, seq, phase from phase_events anti join held using (scan_id, phase)
""")
def rejected_phase_events(spark, sf_dir):
    _, rejected = checkpoints.split_phase_events(
        frame(spark, sf_dir, "phase_events"), _base(spark, sf_dir)
    )
    return rejected.select("scan_id", "seq", "phase")


@query(["checkpoint_docs", "statistic_events", "field_events"], f"""
, {_BASE_SQL}, statistics as (with {_HELD_STATISTICS_SQL} select * from held),
fields as (with {_HELD_FIELDS_SQL} select * from held)
select 'statistic' as kind, scan_id, seq, name
from statistic_events anti join statistics using (scan_id, name)
union all select 'field', scan_id, seq, name from field_events anti join fields using (scan_id, name)
""")
def rejected_updates(spark, sf_dir):
    base = _base(spark, sf_dir)
    _, statistics = checkpoints.split_statistic_events(
        frame(spark, sf_dir, "statistic_events"), base
    )
    _, fields = checkpoints.split_field_events(frame(spark, sf_dir, "field_events"), base)
    return statistics.select(F.lit("statistic").alias("kind"), "scan_id", "seq", "name").union(
        fields.select(F.lit("field").alias("kind"), "scan_id", "seq", "name")
    )


@query(["checkpoint_docs", "statistic_events"], f"""
, {_BASE_SQL}, {_HELD_STATISTICS_SQL}
select scan_id, {", ".join(
    f"coalesce(e.{s}, cast(j->>'$.statistics.{s}' as bigint), -1) as {s}" for s in STATISTICS)},
  coalesce(epoch_us(greatest(last_update, ts)), -1) as last_update_us
from base left join (select scan_id, max(ts) as ts from statistic_events
    semi join (from base where is_loaded) using (scan_id) group by scan_id) using (scan_id)
  left join (select scan_id, {", ".join(
    f"arg_max(value, seq) filter (name = '{s}') as {s}" for s in STATISTICS)}
  from statistic_events semi join held using (scan_id, name) group by scan_id) e using (scan_id)
""")
def apply_statistic_events(spark, sf_dir):
    return checkpoints.apply_statistic_events(
        _base(spark, sf_dir), frame(spark, sf_dir, "statistic_events")
    ).select("scan_id", *_flat_statistics(), _last_update_us()).na.fill(-1)


@query(["checkpoint_docs", "field_events"], f"""
, {_BASE_SQL}, {_HELD_FIELDS_SQL}
select scan_id, coalesce(e.status, j->>'$.status') as status,
  coalesce(e.templates_hash, j->>'$.environment.templates_hash') as templates_hash,
  coalesce(epoch_us(greatest(last_update, ts)), -1) as last_update_us
from base left join (select scan_id, max(ts) as ts,
    arg_max(value, seq) filter (name = 'status') as status,
    arg_max(value, seq) filter (name = 'templates_hash') as templates_hash
  from field_events semi join held using (scan_id, name) group by scan_id) e using (scan_id)
""")
def apply_field_events(spark, sf_dir):
    return checkpoints.apply_field_events(
        _base(spark, sf_dir), frame(spark, sf_dir, "field_events")
    ).select("scan_id", "status", "templates_hash", _last_update_us())


@query(["checkpoint_docs", "position_events"], f"""
, {_BASE_SQL}, {_HELD_PHASES_SQL}
select scan_id, {", ".join(
    f"coalesce(e.{f}_{s}, cast(j->>'$.phases.{p}.checkpoint.{f}' as integer), -1) as {f}_{s}"
    for p, s in _SHORT.items() for f in checkpoints.POSITION)},
  coalesce(epoch_us(greatest(last_update, ts)), -1) as last_update_us
from base left join (select scan_id, max(ts) as ts, {", ".join(
    f"arg_max({f}, seq) filter (phase = '{p}' and {f} is not null) as {f}_{s}"
    for p, s in _SHORT.items() for f in checkpoints.POSITION)}
  from position_events semi join held using (scan_id, phase) group by scan_id) e using (scan_id)
""")
def apply_position_events(spark, sf_dir):
    applied = checkpoints.apply_position_events(
        _base(spark, sf_dir), frame(spark, sf_dir, "position_events")
    )
    return applied.select("scan_id", *_flat_positions(), _last_update_us()).na.fill(-1)


# --- what changed between scans ---------------------------------------------------------------

_PAIRS_SQL = """
pairs as (select * from (select scan_id, lag(scan_id) over (partition by target
    order by started, scan_id) as previous_scan_id from scan_runs)
  where previous_scan_id is not null)
"""


def _changes_sql(lines: str) -> str:
    """Lines (scan_id, line) of each scan against its predecessor's."""
    return f"""
select scan_id, line, coalesce(b.n, 0) as before, coalesce(a.n, 0) as now,
  case when b.n is null then 'added' when a.n is null then 'removed' when a.n = b.n then 'same'
    when a.n > b.n then 'more' else 'fewer' end as change
from (select scan_id, line, count(*) as n from {lines} semi join pairs using (scan_id)
      group by scan_id, line) a
full join (select pairs.scan_id, line, count(*) as n from {lines} x join pairs
      on x.scan_id = previous_scan_id group by pairs.scan_id, line) b using (scan_id, line)
"""


def _comparison_sql(lines: str) -> str:
    counts = ", ".join(
        f"count(*) filter (change = '{c}') as {c}" for c in compare.CHANGES)
    return f"""
select scan_id, previous_scan_id, {", ".join(f"coalesce({c}, 0) as {c}" for c in compare.CHANGES)}
from pairs left join (select scan_id, {counts} from ({_changes_sql(lines)}) group by scan_id)
  using (scan_id)
"""


_FOUND_SQL = "(select scan_id, split_part(line, ' https', 1) as line from findings)"
_LISTED_SQL = "(select scan_id, trim(line) as line from hosts_raw where trim(line) <> '')"


def _found_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings without the address: which template found what severity."""
    return frame(spark, sf_dir, "findings").select(
        "scan_id", F.substring_index("line", " https", 1).alias("line"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.predecessors(frame(spark, sf_dir, "scan_runs"))


@query(["findings", "scan_runs"], f", {_PAIRS_SQL} {_changes_sql(_FOUND_SQL)}")
def scan_changes(spark, sf_dir):
    return compare.line_changes(_found_kinds(spark, sf_dir), _pairs(spark, sf_dir))


@query(["findings", "hosts_raw", "scan_runs"], f"""
, {_PAIRS_SQL}
select 'findings' as kind, * from ({_comparison_sql(_FOUND_SQL)})
union all select 'hosts', * from ({_comparison_sql(_LISTED_SQL)})
""")
def scan_comparison(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    listed = frame(spark, sf_dir, "hosts_raw").select(
        "scan_id", text.stripped(F.col("line")).alias("line")).where("line <> ''")
    kinds = {"findings": _found_kinds(spark, sf_dir), "hosts": listed}
    found, hosts_found = [
        compare.comparison(compare.line_changes(lines, pairs), pairs).select(
            F.lit(kind).alias("kind"), "*") for kind, lines in kinds.items()]
    return found.unionByName(hosts_found)


@query(["findings", "scan_runs"], f"""
, hot as {skewed_sql("findings")}, {_PAIRS_SQL}
{_comparison_sql(_FOUND_SQL.replace("findings", "hot"))}
""")
def scan_comparison_hot(spark, sf_dir):
    pairs = compare.predecessors(frame(spark, sf_dir, "scan_runs"), max_group_rows=4)
    return compare.comparison(
        compare.line_changes(skewed(_found_kinds(spark, sf_dir)), pairs), pairs)


def _tree_changes_sql(files: str) -> str:
    return f"""
select scan_id, path, case when b.content is null then 'added' when a.content is null
    then 'removed' else 'changed' end as change
from (select scan_id, path, content from {files} semi join pairs using (scan_id)) a
full join (select pairs.scan_id, path, content from {files} x join pairs
      on x.scan_id = previous_scan_id) b using (scan_id, path)
where a.content is distinct from b.content"""


@query(["corpus_trees", "scan_runs"], f", {_PAIRS_SQL} {_tree_changes_sql('corpus_trees')}")
def corpus_changes(spark, sf_dir):
    tree = compare.hash_tree(frame(spark, sf_dir, "corpus_trees"))
    return compare.tree_changes(tree, _pairs(spark, sf_dir))


# every tenth file is no template; empty files are not read back
_TEMPLATES_SQL = """templates as (
  select scan_id, path || '.yaml' as path, content from corpus_trees
  where path not like '%0' and content <> '')"""


def _stored_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = shared_dir(spark, "corpus"), frame(spark, sf_dir, "corpus_trees")
    ending = F.when(F.col("path").endswith("0"), ".txt").otherwise(".yaml")
    folders.write_corpus(files.withColumn("path", F.concat("path", ending)), folder)
    return folders.read_corpus_folder(spark, folder)


@query(["corpus_trees"], f""", {_TEMPLATES_SQL}
select scan_id, path, strlen(content) as length, md5(content) as content_md5 from templates
""")
def stored_corpus(spark, sf_dir):
    """Each template written as a file of its own and read back."""
    return _stored_templates(spark, sf_dir).select(
        "scan_id", "path", "length", F.md5("content").alias("content_md5"))


@query(["corpus_trees", "scan_runs"], f""", {_PAIRS_SQL}, {_TEMPLATES_SQL}
{_tree_changes_sql("templates")}
""")
def stored_corpus_changes(spark, sf_dir):
    tree = compare.hash_tree(_stored_templates(spark, sf_dir))
    return compare.tree_changes(tree, _pairs(spark, sf_dir))


# --- tools and templates ---------------------------------------------------------------------

_CURRENT_SQL = r"select tool, regexp_extract(version_text, 'v?(\d+\.\d+\.\d+)', 1) as current_version from version_outputs"


@query(["tool_versions", "version_outputs"], f"""
select scan_id, tool, version, current_version, 'Tool version mismatch for ' || tool || ': '
  || version || ' (checkpoint) vs ' || current_version || ' (current)' as message,
  version = 'unknown' or current_version = 'unknown' as has_unknown
from tool_versions join ({_CURRENT_SQL}) using (tool) where version <> current_version
""")
def environment_drift(spark, sf_dir):
    return fleet.environment_drift(
        frame(spark, sf_dir, "tool_versions"),
        fleet.current_versions(frame(spark, sf_dir, "version_outputs")),
    )


@query(["tool_versions", "version_outputs"], f"""
select scan_id, count(current_version) as compared,
  count(*) filter (version <> current_version) as mismatches,
  count(*) filter (version <> current_version) = 0 as is_valid
from tool_versions left join ({_CURRENT_SQL}) using (tool) group by scan_id
""")
def environment_validity(spark, sf_dir):
    return fleet.environment_validity(
        frame(spark, sf_dir, "tool_versions"),
        fleet.current_versions(frame(spark, sf_dir, "version_outputs")),
    )


@query(["installed_tools", "release_tags", "required_tools"], """
select scan_id, tool, version, ltrim(tag, 'v') as latest_version,
  tag is not null and not coalesce(contains(version, ltrim(tag, 'v')), false) as needs_update,
  coalesce(version = ltrim(tag, 'v'), false) as exact_match
from (select distinct scan_id, tool from required_tools)
left join installed_tools using (scan_id, tool) left join release_tags using (tool)
""")
def outdated_tools(spark, sf_dir):
    return fleet.outdated_tools(
        frame(spark, sf_dir, "installed_tools"), frame(spark, sf_dir, "release_tags"),
        frame(spark, sf_dir, "required_tools"),
    )


@query(["files"], """
select scan_id, count(*) as files, md5(concat_ws('-', count(*),
  sum(('0x' || substr(md5(content), 1, 8))::bigint),
  sum(('0x' || substr(md5(content), 9, 8))::bigint),
  sum(('0x' || substr(md5(content), 17, 8))::bigint),
  sum(('0x' || substr(md5(content), 25, 8))::bigint))) as fingerprint
from files where path like '%.yaml' group by scan_id
""")
def corpus_fingerprint(spark, sf_dir):
    return fleet.corpus_fingerprint(frame(spark, sf_dir, "files"))


@query(["files"], f"""
select scan_id, path from (select scan_id, path, row_number() over (partition by scan_id
  order by md5(path), path) as n from files where path like '%.yaml')
where n <= {FINGERPRINT_SAMPLE}
""")
def corpus_sample(spark, sf_dir):
    return fleet.corpus_sample(frame(spark, sf_dir, "files").select("scan_id", "path"))


@query(["corpus_markers", "corpus_latest"], """
select scan_id, repo, local_commit is distinct from commit as needs_update,
  case when local_commit = commit
    then 'Templates already at latest version (commit: ' || substr(local_commit, 1, 7) || ')'
    when local_commit is not null then 'New templates available (current: '
      || substr(local_commit, 1, 7) || ', latest: ' || substr(commit, 1, 7) || ')' end as message
from corpus_markers left join corpus_latest using (repo)
""")
def corpus_staleness(spark, sf_dir):
    return fleet.corpus_staleness(
        frame(spark, sf_dir, "corpus_markers"), frame(spark, sf_dir, "corpus_latest")
    )


# --- notifications ---------------------------------------------------------------------------

def payload_sql(content: str, title: str) -> str:
    return (
        f"to_json(struct_pack(content := {content}, embeds := "
        f"[struct_pack(title := {title}, color := 65280)]))::varchar"
    )


@query(["message_events"], f"""
select scan_id, seq, title, content, {payload_sql('content', 'title')} as payload from (
  select scan_id, seq,
    case kind when 'start' then 'Scan Started' when 'complete' then 'Scan Completed'
      when 'cancelled' then 'Scan Cancelled' else 'Scan Error' end as title,
    case kind when 'start' then '🚀 Starting security scan for domain: ' || domain
      when 'complete' then '✅ Scan completed for domain: ' || domain
      when 'cancelled' then '🚫 Scan cancelled for ' || domain || chr(10) || 'Reason: '
        || coalesce(detail, 'User cancelled')
      else '❌ Error scanning domain ' || domain || ':' || chr(10) || '```' || chr(10)
        || coalesce(detail, '') || chr(10) || '```' end as content
  from message_events where kind <> 'other')
""")
def notification_payloads(spark, sf_dir):
    return notify.event_messages(frame(spark, sf_dir, "message_events"))


def _list_message_sql(items: str, icon: str, noun: str, title: str) -> str:
    return f"""
select scan_id, part, '{title}' as title, content,
  {payload_sql('content', f"'{title}'")} as payload
from (select scan_id, coalesce(part, 0) as part, '{icon} Found ' || coalesce(n, 0)
    || ' {noun} for ' || coalesce(domain, 'unknown domain') || ':' || chr(10) || coalesce(shown, '')
    || case when part = 0 and n > 100 then chr(10) || '... and ' || (n - 100) || ' more'
       else '' end as content
  from some_domains full join (
    select scan_id, part, any_value(n) as n, string_agg('• ' || item, chr(10) order by item) as shown
    from (select *, (row_number() over (partition by scan_id order by item) - 1) // 100 as part,
            count(*) over (partition by scan_id) as n from ({items}))
    group by scan_id, part) using (scan_id))
"""


@query(["host_names", "some_domains"], _list_message_sql(
    NAMES_SQL.replace("as host", "as item"), "🔍", "subdomains", "Subdomains Found"))
def notification_hosts_found(spark, sf_dir):
    items = _targets(spark, sf_dir).withColumnRenamed("host", "item")
    return notify.list_messages(
        items, frame(spark, sf_dir, "some_domains"), notify.SUBDOMAINS_FOUND
    )


@query(["probe_raw", "some_domains"], _list_message_sql(
    f"select scan_id, line as item from ({PROBE_SQL})", "🌐", "alive subdomains",
    "Alive Subdomains"))
def notification_hosts_alive(spark, sf_dir):
    items = probe_lines(spark, sf_dir).select("scan_id", F.col("line").alias("item"))
    return notify.list_messages(
        items, frame(spark, sf_dir, "some_domains"), notify.ALIVE_SUBDOMAINS
    )


@query(["findings", "some_domains"], f"""
select scan_id, part, title, content, {payload_sql('content', 'title')} as payload from (
  select scan_id, coalesce(part, 0) as part,
    case when part is null then 'Scan Completed' else 'Scan Results' end as title,
    case when part is null then '✅ No vulnerabilities found for ' || domain
      else '📊 Scan results for ' || coalesce(domain, 'unknown domain') || ':' || chr(10) || '```' || chr(10) || body
        || chr(10) || '```' end as content
  from some_domains full join (
    select scan_id, part, string_agg(line, chr(10) order by seq) as body
    from (select *, (row_number() over (partition by scan_id order by seq) - 1) // 25 as part
          from findings) group by scan_id, part) using (scan_id))
""")
def notification_results(spark, sf_dir):
    return notify.result_messages(
        hygiene.load_findings(frame(spark, sf_dir, "findings")),
        frame(spark, sf_dir, "some_domains"), ["seq"], lines_per_part=25,
    )


# --- sinks read back -------------------------------------------------------------------------

@query(["checkpoint_docs"], """
select scan_id, '20240131_000000' as snapshot, 'scan_state_20240131_000000.json' as file_name, doc
from checkpoint_docs
""")
def stored_snapshots(spark, sf_dir):
    """Snapshots written twice under one label: the second write replaces the first."""
    path = shared_dir(spark, "snapshots")
    taken = checkpoints.snapshot_checkpoints(documents(spark, sf_dir), as_of())
    writers.write_snapshots(taken, path)
    writers.write_snapshots(taken, path)
    return spark.read.schema(taken.schema).parquet(path).select(taken.columns)


@query([], None)
def stored_scan_state(spark, sf_dir):
    """Scan-state documents written as JSON text and loaded from there."""
    path = shared_dir(spark, "scan-state")
    writers.write_json(frame(spark, sf_dir, "state_docs"), path)
    stored = spark.read.schema("scan_id bigint, doc string").json(path)
    return readers.load_scan_state(stored).drop("error")


@query([], None)
def stored_memory_documents(spark, sf_dir):
    path = shared_dir(spark, "memory")
    made = progress.memory_documents(frame(spark, sf_dir, "measurements"), 20)
    writers.write_json(made, path)
    return spark.read.schema(made.schema).json(path).select(
        "scan_id", "part", "peak_usage", F.size("measurements").cast("bigint").alias("samples"),
        F.element_at("measurements", 1)["label"].alias("first_label"),
        F.element_at("measurements", -1)["label"].alias("last_label"),
    )


@query(["hosts_raw"], HOSTS_SQL)
def exported_hosts(spark, sf_dir):
    """The host store as sorted lines, read back; the store is cleared and holds nothing then."""
    store, path = shared_dir(spark, "host-store"), shared_dir(spark, "host-export")
    hoststore.bulk_host_load(hosts(spark, sf_dir), store, "all")
    linestore.write_stored_lines(hoststore.read_host_store(spark, store), path, "host")
    hoststore.clear_host_store(spark, store)
    exported = linestore.read_stored_lines(spark, path).withColumnRenamed("line", "host")
    return exported.unionByName(hoststore.read_host_store(spark, store))


# What is read back is what was written.
ORACLES["stored_scan_state"] = ORACLES["load_scan_state"]
ORACLES["stored_memory_documents"] = ORACLES["memory_documents"]


# --- streams ---------------------------------------------------------------------------------

def _as_stream(spark: SparkSession, df: DataFrame, order: str, cuts: list) -> DataFrame:
    """Write all rows of ``df`` as consecutive loads and read them as a stream, one file a batch."""
    path = shared_dir(spark, "stream")
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:]):
        part = df
        if low is not None:
            # The last load also takes the rows that have no time.
            later = F.col(order) >= low
            part = part.filter(later if high is not None else later | F.col(order).isNull())
        if high is not None:
            part = part.filter(F.col(order) < high)
        part.write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _days(*days: int) -> list:
    return [F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz") for day in days]


@query(["hosts_raw"], HOSTS_SQL)
def stream_new_hosts(spark, sf_dir):
    cleaned = hosts(spark, sf_dir)
    # the same hosts arrive again in every load
    path = shared_dir(spark, "stream")
    for _ in range(2):
        cleaned.write.mode("append").parquet(path)
    stream = spark.readStream.schema(cleaned.schema).option("maxFilesPerTrigger", 1).parquet(path)
    store = shared_dir(spark, "host-store")
    jobs.stream_new_hosts(stream, store, shared_dir(spark, "progress")).awaitTermination()
    return hoststore.read_host_store(spark, store)


@query(["hosts_raw"], HOSTS_SQL)
def stream_hosts_after_failure(spark, sf_dir):
    """A stream that is lost after it has written a load and before it could commit it."""
    path, store = shared_dir(spark, "stream"), shared_dir(spark, "host-store")
    cleaned, progress_dir = hosts(spark, sf_dir), shared_dir(spark, "progress")
    for part in range(3):
        cleaned.where(F.pmod(F.xxhash64("host"), F.lit(3)) <= part).write.mode("append").parquet(path)
    stream = spark.readStream.schema(cleaned.schema).option("maxFilesPerTrigger", 1).parquet(path)

    def lose(batch_id: int) -> None:
        if batch_id == 1:
            raise RuntimeError(LOST)

    try:
        jobs.stream_new_hosts(stream, store, progress_dir, on_written=lose).awaitTermination()
    except StreamingQueryException as error:
        if LOST not in str(error):
            raise
    jobs.stream_new_hosts(stream, store, progress_dir).awaitTermination()
    return hoststore.read_host_store(spark, store)


@query(["phase_events"], f"select * from ({LATEST_PHASES_SQL}) where phase <> 'unknown_phase'")
def stream_phase_state(spark, sf_dir):
    stream = _as_stream(spark, frame(spark, sf_dir, "phase_events"), "ts", _days(11, 21))
    state = shared_dir(spark, "phase-state")
    jobs.stream_phase_state(stream, state, shared_dir(spark, "progress")).awaitTermination()
    return jobs.current_phase_state(spark, state).drop("ts")


@query(["document_updates"], """
select scan_id, max(seq) as seq, arg_max(doc, seq) as doc from document_updates group by scan_id
""")
def stream_checkpoints(spark, sf_dir):
    stream = _as_stream(spark, frame(spark, sf_dir, "document_updates"), "ts", _days(11, 21))
    state = shared_dir(spark, "documents")
    jobs.stream_checkpoints(stream, state, shared_dir(spark, "progress")).awaitTermination()
    return jobs.current_checkpoints(spark, state).drop("ts")


@query(["status_log"], _status_transitions_sql("status_log"))
def stream_status_transitions(spark, sf_dir):
    stream = _as_stream(spark, frame(spark, sf_dir, "status_log"), "ts", _days(11, 21))
    out = shared_dir(spark, "transitions")
    jobs.stream_status_transitions(stream, out, shared_dir(spark, "progress")).awaitTermination()
    return jobs.recorded_transitions(spark, out).drop("ts")


# Some rows of the first days come with the last load: later than the delay allows.
_LATE_SQL = "(ts is null or seq % 97 = 0 and ts < timestamp '2024-01-06')"


def _out_of_order(spark: SparkSession, sf_dir: str) -> str:
    """The status log in four loads, each row up to ten days late, and a few later than that."""
    log, path = frame(spark, sf_dir, "status_log"), shared_dir(spark, "stream")
    out, progress_dir = shared_dir(spark, "in-order"), shared_dir(spark, "progress")
    day = F.dayofmonth("ts") + F.pmod(F.xxhash64("seq"), F.lit(11))
    late = (F.col("seq") % 97 == 0) & (F.col("ts") < _days(6)[0])
    load = F.when(late, 3).otherwise(F.coalesce(F.least(F.floor(day / 10), F.lit(3)), F.lit(3)))
    for number in range(4):
        log.where(load == number).write.mode("append").parquet(path)
        event_time.stream_transitions_in_order(
            spark.readStream.schema(log.schema).parquet(path), out, progress_dir, "12 days",
        ).awaitTermination()
    event_time.release(spark, out)
    return out


@query(["status_log"], _status_transitions_sql(f"(from status_log where not {_LATE_SQL})"))
def status_transitions_event_time(spark, sf_dir):
    return event_time.transitions(spark, _out_of_order(spark, sf_dir)).drop("ts")


@query(["status_log"], f"select scan_id, seq, status from status_log where {_LATE_SQL}")
def late_status_rows(spark, sf_dir):
    return event_time.late_rows(spark, _out_of_order(spark, sf_dir)).drop("ts", "watermark")


@query(["findings"], "select distinct scan_id, 'h' || scan_id || '.example.com' as host "
                     "from findings")
def stream_hosts_within_delay(spark, sf_dir):
    seen = frame(spark, sf_dir, "findings").select(
        "scan_id", F.concat(F.lit("h"), "scan_id", F.lit(".example.com")).alias("host"), "ts"
    )
    stream = _as_stream(spark, seen, "ts", _days(11, 21)).withColumn("ts", F.col("ts").cast("timestamp"))
    out = shared_dir(spark, "hosts-within")
    (
        jobs.new_hosts_within(stream, "ts", "40 days").select("scan_id", "host")
        .writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", shared_dir(spark, "progress"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema("scan_id bigint, host string").parquet(out)


def _update_loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The updates of all four kinds in four loads, in no order of time."""
    every = (
        updates.phase_updates(frame(spark, sf_dir, "phase_events"))
        .unionByName(updates.statistic_updates(frame(spark, sf_dir, "statistic_events")))
        .unionByName(updates.field_updates(frame(spark, sf_dir, "field_events")))
        .unionByName(updates.position_updates(frame(spark, sf_dir, "position_events"))))
    return [every.where(F.pmod(F.xxhash64("seq"), F.lit(4)) == i) for i in range(4)]


def _restarted(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], object]) -> None:
    """Run a stream over two loads, stop it, and go on with two more."""
    path = shared_dir(spark, "stream")
    for i, load in enumerate(_update_loads(spark, sf_dir)):
        load.write.mode("append").parquet(path)
        if i % 2:
            start(spark.readStream.schema(updates.UPDATE).parquet(path)).awaitTermination()


_UPDATED_SQL = f"""
, phases as (with {{phase}}), counters as (with {{statistic}}), fields as (with {{field}}),
positions as (with {{position}})
select phases.* exclude (last_update_us), counters.* exclude (scan_id, last_update_us),
  fields.* exclude (scan_id, last_update_us), positions.* exclude (scan_id, last_update_us),
  greatest(phases.last_update_us, counters.last_update_us, fields.last_update_us,
    positions.last_update_us) as last_update_us
from phases join counters using (scan_id) join fields using (scan_id) join positions using (scan_id)
"""
_UPDATE_BINDINGS = [
    "checkpoint_docs", "phase_events", "statistic_events", "field_events", "position_events"]


def _inner(name: str) -> str:
    """A registered check without its leading relations."""
    return ORACLES[name].split("\n, ", 1)[1]


@query(_UPDATE_BINDINGS, _UPDATED_SQL.format(**{
    kind: _inner(f"apply_{kind}_events") for kind in ("phase", "statistic", "field", "position")}))
def stream_document_updates(spark, sf_dir):
    before = documents(spark, sf_dir)
    out, progress_dir = shared_dir(spark, "updates"), shared_dir(spark, "progress")
    _restarted(spark, sf_dir, lambda stream: updates.stream_document_updates(
        stream, before, out, progress_dir))
    now = checkpoints.load_checkpoints(updates.updated_documents(before, out))
    return _typed(now).select(
        "scan_id", *_flat_phases("status"), *_flat_statistics(), "status", "templates_hash",
        *_flat_positions(), _last_update_us()).na.fill(-1)


@query(_UPDATE_BINDINGS, f"""
, p as (with {_inner("rejected_phase_events")}), u as (with {_inner("rejected_updates")})
select 'phase' as kind, scan_id, seq, phase as name from p union all select * from u
""")
def stream_rejected_updates(spark, sf_dir):
    out, progress_dir = shared_dir(spark, "rejected"), shared_dir(spark, "progress")
    before = documents(spark, sf_dir)
    _restarted(spark, sf_dir, lambda stream: updates.stream_rejected_updates(
        stream, before, out, progress_dir))
    refused = spark.read.schema(updates.UPDATE).parquet(out)
    return refused.where(F.col("kind") != updates.POSITION_KIND).select(
        "kind", "scan_id", "seq", "name")


# --- reports ---------------------------------------------------------------------------------

_LEVELS_SQL = ", ".join(
    f"count(*) filter (severity = '{s}') as {s}"
    for s in ("critical", "high", "medium", "low", "info")
)


@query(["hosts_raw", "probe_raw", "findings"], f"""
select scan_id, coalesce(hosts, 0) as hosts, coalesce(valid_hosts, 0) as valid_hosts,
  coalesce(alive_hosts, 0) as alive_hosts, coalesce(findings, 0) as findings,
  coalesce(critical, 0) as critical, coalesce(high, 0) as high, coalesce(medium, 0) as medium,
  coalesce(low, 0) as low, coalesce(info, 0) as info
from (select scan_id, count(*) as hosts, count(*) filter ({VALID_HOST_SQL}) as valid_hosts
      from (select *, {authority_sql('host')} as domain from ({HOSTS_SQL})) group by scan_id)
full join (select scan_id, count(*) as alive_hosts
      from (select *, {host_key_sql('host')} as k from ({HOSTS_SQL}))
      semi join ({_ANSWERED_SQL}) using (scan_id, k) group by scan_id) using (scan_id)
full join (select scan_id, count(*) as findings, {_LEVELS_SQL}
      from (select scan_id, {SEVERITY_SQL} as severity from findings) group by scan_id)
  using (scan_id)
""")
def fleet_report(spark, sf_dir):
    return reports.fleet_report(
        frame(spark, sf_dir, "hosts_raw"), frame(spark, sf_dir, "probe_raw"),
        frame(spark, sf_dir, "findings"),
    )


@query(["checkpoint_docs", "hosts_raw", "probe_raw"], f"""
, parsed as ({PARSED_DOCS_SQL}), phase_rows as ({_PHASE_ROWS_SQL})
select scan_id, case when is_document is null then 'missing' when j is null then 'corrupt'
    when not json_exists(j, '$.scan_id') then 'no_scan_id' else 'loaded' end as load_status,
  coalesce(n_issues, 1) as issues, cast(case when is_document is null then 3
    else coalesce(pending_phases, 0) end as integer) as pending_phases,
  case when is_document is null then 'subdomain_enumeration' else next_phase end as next_phase,
  coalesce(targets_left, 0) as targets_left
from (select *, true as is_document from parsed) join ({_ISSUES_SQL}) using (scan_id)
left join (select scan_id, count(*) as pending_phases, arg_min(phase, position) as next_phase
  from phase_rows where (r->>'$.status') is distinct from 'completed' group by scan_id)
  using (scan_id)
full join (select scan_id, count(*) as targets_left from ({HOSTS_SQL}) anti join
  (select scan_id, split_part(line, ' ', 1) as host from ({PROBE_SQL})) using (scan_id, host)
  group by scan_id) using (scan_id)
""")
def resume_plan(spark, sf_dir):
    return reports.resume_plan(
        documents(spark, sf_dir), hosts(spark, sf_dir), probed_hosts(spark, sf_dir)
    )


@query(["findings", "event_kinds"], f"""
, {_STATE_SQL}
select scan_id, coalesce(reported, 0) as reported, reported is not null as has_state,
  coalesce(found, 0) as found,
  cast(found > 0 and scan_id in (select scan_id from failed) as integer) as is_rebuilt,
  {", ".join(f"coalesce({level}, 0) as {level}" for level in SEVERITIES)}
from state full join (select scan_id, count(*) as found, {_LEVELS_SQL}
  from (select scan_id, {SEVERITY_SQL} as severity from findings
    where scan_id not in (select scan_id from failed) or scan_id in (select scan_id from state))
  group by scan_id) using (scan_id)
""")
def results_report(spark, sf_dir):
    return reports.results_report(
        _reported(spark, sf_dir), _written(spark, sf_dir), frame(spark, sf_dir, "findings")
    )
