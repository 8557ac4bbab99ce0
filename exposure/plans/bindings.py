"""The engine's input relations, expressed over the given test tables.

Each relation is one list of SQL expressions over one whole table. Spark evaluates them with
``selectExpr``; the same text becomes a common table expression for the SQL check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-31 00:00:00"
AS_OF_EPOCH = 1_706_659_200


@dataclass(frozen=True)
class Binding:
    table: str
    columns: dict[str, str]
    where: str | None = None

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        if self.where:
            df = df.filter(self.where)
        return df.selectExpr(*[f"{expr} as {name}" for name, expr in self.columns.items()])

    def sql(self) -> str:
        listed = ", ".join(f"{expr} as {name}" for name, expr in self.columns.items())
        where = f" where {self.where}" if self.where else ""
        return f"select {listed} from {self.table}{where}"


_SEVERITY_TAG = (
    "case when event_id % 17 = 0 then '' when event_type = 'error' then '[CRITICAL]' "
    "when event_type = 'purchase' then '[high]' when event_type = 'signup' then '[Medium]' "
    "when event_type = 'click' then '[low]' else '[info]' end"
)
_FINDING_LINE = (
    "concat('[tpl-', cast(event_id % 50 as string), '] [http] ', " + _SEVERITY_TAG + ", "
    "case when event_id % 23 = 0 then ' [critical]' else '' end, "
    "' https://h', cast(user_id as string), '.example.com/')"
)
_PHASE_STATUS = (
    "case event_type when 'view' then 'pending' when 'click' then 'in_progress' "
    "when 'signup' then 'in_progress' when 'purchase' then 'completed' else 'failed' end"
)
_PHASE_NAME = (
    "case event_id % 4 when 0 then 'subdomain_enumeration' when 1 then 'alive_check' "
    "when 2 then 'vulnerability_scan' else 'unknown_phase' end"
)
_DOCUMENT = """case when c_custkey % 19 = 0 then '{"scan_id": "broken'
    when c_custkey % 29 = 0 then '{}' else concat(
    '{"scan_id":"s', cast(c_custkey as string), '"',
    case when c_custkey % 7 = 0 then '' else ',"domain":"d.example.com"' end,
    ',"start_time":"2024-01-01T00:00:00","last_update":"2024-01-01T00:00:00","status":"in_progress","phases":{"subdomain_enumeration":{"status":"completed","progress_percentage":100,"results_count":',
    cast(c_nationkey as string), ',"checkpoint":{"batch_index":3}}',
    case when c_custkey % 5 = 0 then '' when c_custkey % 17 = 0 then ',"alive_check":5,"vulnerability_scan":{"status":"pending","progress_percentage":"7","results_count":0}' else ',"alive_check":{"status":"in_progress","progress_percentage":45,"results_count":2},"vulnerability_scan":{"status":"pending","progress_percentage":0,"results_count":0}' end,
    '},"statistics":{"subdomains_found":', cast(c_nationkey as string), '}',
    case when c_custkey % 11 = 0 then '' else ',"environment":{"tool_versions":{},"templates_hash":""}' end, '}',
    case when c_custkey % 23 = 0 then ' trailing' when c_custkey % 31 = 0 then ' }' when c_custkey % 37 = 0 then ']' else '' end) end"""
_STATE_DOCUMENT = """case when c_custkey % 19 = 0 then '{"status": ' else concat(
    '{', case when c_custkey % 3 = 0 then '' else '"status":"failed",' end,
    '"start_time":', cast(1700000000 + c_custkey as string),
    case when c_custkey % 4 = 0 then '' else concat(',"duration":', cast(c_nationkey as string), '.5') end,
    case when c_custkey % 5 = 0 then '' else concat(',"subdomains":', cast(c_custkey % 900 as string)) end,
    case when c_custkey % 6 = 0 then '' else concat(',"vulnerabilities":', cast(c_nationkey as string)) end,
    '}') end"""

_SIXTH = "cast(floor(doc_id / 6) as bigint)"

BINDINGS = {
    # padding, blanks, duplicates after trimming
    "hosts_raw": Binding("pages", {
        "scan_id": "page_id % 5",
        "line": "concat(case when page_id % 4 = 0 then '  ' else '' end, "
                "case when page_id % 11 = 0 then '' else url end, "
                "case when page_id % 6 = 0 then ' ' else '' end)",
    }),
    # coloured "url [status] [title]" lines of all pages; those served over http answered from
    # another host, so the host that was asked counts as dead
    "probe_raw": Binding("pages", {
        "scan_id": "page_id % 5",
        "batch_id": "cast(page_id as int) % 8",
        "line": "concat(replace(url, 'http://', 'https://moved.'), ' [', chr(27), '[32m200', "
                "chr(27), '[0m] [', chr(27), '[36mtitle ', cast(page_id % 10 as string), "
                "chr(27), '[0m]')",
    }),
    # bare host names, a part of them not valid
    "host_names": Binding("customer", {
        "scan_id": "c_custkey % 20",
        "line": "concat(case when c_custkey % 8 = 0 then '-' when c_custkey % 9 = 0 then 'http://' "
                "when c_custkey % 10 = 0 then 'HTTP://' else '' end, 'h', "
                "cast(c_custkey as string), case when c_custkey % 12 = 0 then '_' "
                "when c_custkey % 13 = 0 then '-' else '' end, '.', lower(c_mktsegment), "
                "case when c_custkey % 14 = 0 then '.c1' else '.com' end, "
                "case when c_custkey % 15 = 0 then ':8443' when c_custkey % 27 = 0 then '/x?y' "
                "else '' end)",
    }),
    # mixed-case tags, untagged lines, lines with two tags
    "findings": Binding("events", {
        "scan_id": "user_id", "batch_id": "cast(event_id % 20 as int)", "seq": "event_id",
        "ts": "ts", "line": _FINDING_LINE,
    }),
    # what each batch wrote, and to which file: every fifth batch shares its neighbour's file
    "batch_outputs": Binding("events", {
        "scan_id": "user_id", "batch_id": "cast(event_id % 20 as int)", "seq": "event_id",
        "path": "concat('scan', cast(user_id as string), '/results_', cast(event_id % 20 - "
                "case when event_id % 5 = 4 then 1 else 0 end as string))",
        "line": "case when event_id % 17 = 0 then ' ' else " + _FINDING_LINE + " end",
        "error": "case when event_type = 'error' then 'timeout' else null end",
    }),
    "event_kinds": Binding("events", {
        "scan_id": "user_id", "seq": "event_id", "kind": "event_type",
    }),
    "scan_starts": Binding("events", {"scan_id": "user_id", "ts": "ts"}),
    "severity_requests": Binding("customer", {
        "scan_id": "c_custkey",
        "wanted": "case c_nationkey % 5 when 0 then 'critical' when 1 then 'critical, high ,low' "
                  "when 2 then 'info,urgent' when 3 then 'High' else null end",
    }),
    "document_updates": Binding("events", {
        "scan_id": "user_id", "ts": "ts", "seq": "event_id",
        "doc": "concat('{\"scan_id\":\"u', cast(event_id as string), '\"}')",
    }),
    # three known phases and one unknown
    "phase_events": Binding("events", {
        "scan_id": "user_id", "seq": "event_id", "ts": "ts", "phase": _PHASE_NAME,
        "status": _PHASE_STATUS, "progress": "cast(event_id % 101 as int)",
        "results_count": "cast(floor(value) as bigint)",
    }),
    "status_log": Binding("events", {
        "scan_id": "user_id", "seq": "event_id", "ts": "ts",
        "status": "case when event_id % 29 = 0 then '' else " + _PHASE_STATUS + " end",
    }),
    "statistic_events": Binding("events", {
        "scan_id": "user_id", "seq": "event_id", "ts": "ts",
        "name": "case event_id % 4 when 0 then 'subdomains_found' when 1 then 'alive_subdomains' "
                "when 2 then 'vulnerabilities_found' else 'unknown_statistic' end",
        "value": "cast(floor(value) as bigint)",
    }),
    "field_events": Binding("events", {
        "scan_id": "user_id", "seq": "event_id", "ts": "ts",
        "name": "case event_id % 3 when 0 then 'status' when 1 then 'templates_hash' "
                "else 'other' end",
        "value": "case when event_id % 3 = 0 then event_type "
                 "else md5(cast(event_id as string)) end",
    }),
    "position_events": Binding("events", {
        "scan_id": "user_id", "seq": "event_id", "ts": "ts", "phase": _PHASE_NAME,
        "batch_index": "cast(event_id % 37 as int)",
        "batch_size": "case when event_id % 3 = 0 then cast(10 as int) end",
        "progress": "cast(event_id % 101 as int)",
    }),
    "measurements": Binding("events", {
        "scan_id": "user_id", "seq": "event_id", "ts": "ts", "label": "event_type",
        "memory_mb": "value * 4",
    }),
    # several writes per key, some empty
    "result_cache": Binding("events", {
        "cache_key": "md5(concat('enumerate -d host', cast(user_id as string)))", "ts": "ts",
        "seq": "event_id", "result": "case when event_id % 5 = 0 then '' else event_type end",
    }),
    "cache_requests": Binding("customer", {
        "scan_id": "c_custkey", "host": "concat('host', cast(c_custkey as string))",
    }),
    # some tools on one side only
    "tool_versions": Binding("customer", {
        "scan_id": "c_custkey", "tool": "concat('tool', cast(c_custkey % 130 as string))",
        "version": "case when c_custkey % 13 = 0 then 'unknown' else concat('1.', "
                   "cast(c_nationkey % 3 as string), '.', cast(c_custkey % 40 as string)) end",
    }),
    "version_outputs": Binding("supplier", {
        "tool": "concat('tool', cast(s_suppkey as string))",
        "version_text": "concat('Current Version: v1.', cast(s_nationkey % 3 as string), '.', "
                        "cast(s_suppkey % 4 as string))",
    }),
    "installed_tools": Binding("customer", {
        "scan_id": "c_custkey", "tool": "concat('tool', cast(c_custkey % 130 as string))",
        "version": "case when c_custkey % 13 = 0 then null else concat('1.', "
                   "cast(c_nationkey % 3 as string), '.', cast(c_custkey % 40 as string)) end",
    }),
    "release_tags": Binding("supplier", {
        "tool": "concat('tool', cast(s_suppkey as string))",
        "tag": "concat('v1.', cast(s_nationkey % 3 as string), '.', "
               "cast(s_suppkey % 4 as string))",
    }),
    "corpus_markers": Binding("customer", {
        "scan_id": "c_custkey", "repo": "concat('repo', cast(c_nationkey as string))",
        "local_commit": "case when c_custkey % 9 = 0 then null "
                        "else md5(cast(c_nationkey + c_custkey % 2 as string)) end",
    }),
    "corpus_latest": Binding("nation", {
        "repo": "concat('repo', cast(n_nationkey as string))",
        "commit": "md5(cast(n_nationkey as string))",
    }),
    # three levels of folders, most files the same in the next scan
    "corpus_trees": Binding("documents", {
        "scan_id": "doc_id % 6 + 1",
        "path": f"concat('d', cast({_SIXTH} % 7 as string), '/e', cast({_SIXTH} % 3 as string), "
                f"case when doc_id % 17 = 0 then '/g' else '' end, '/f', cast({_SIXTH} as string))",
        "content": f"case when doc_id % 13 = 0 then text else cast({_SIXTH} as string) end",
    }),
    # inventory and content, some empty, two extensions
    "files": Binding("documents", {
        "scan_id": "doc_id % 9",
        "path": "concat(source, '/', cast(doc_id as string), "
                "case when doc_id % 3 = 0 then '.txt' else '.yaml' end)",
        "length": "case when doc_id % 10 = 0 then 0 else n_chars end",
        "content": "text", "mtime_s": "doc_id * 61 % 9973",
    }),
    # truncated documents, missing domain, phases, environment and statistics
    "checkpoint_docs": Binding("customer", {
        "scan_id": "c_custkey", "doc": _DOCUMENT,
        "expected_domain": "case when c_nationkey = 3 then 'e.example.com' "
                           "else 'd.example.com' end",
    }),
    "state_docs": Binding("customer", {"scan_id": "c_custkey", "doc": _STATE_DOCUMENT}),
    "new_scans": Binding("customer", {
        "scan_id": "c_custkey", "domain": "concat('c', cast(c_custkey as string), '.example.com')",
        "started": "cast('2024-01-31 00:00:00' as timestamp)",
        "version": "concat('1.0.', cast(c_nationkey as string))",
    }),
    # eight scans in a row are of one target, started in another order
    "scan_runs": Binding("customer", {
        "scan_id": "c_custkey", "target": "concat('t', cast(cast(floor(c_custkey / 8) as bigint) as string))",
        "started": "c_custkey * 61 % 9973",
    }),
    "domains": Binding("customer", {
        "scan_id": "c_custkey", "domain": "concat('c', cast(c_custkey as string), '.example.com')",
    }),
    # scans 3, 10, 17, ... have no domain row: their scan_id is that of another table
    "some_domains": Binding("customer", {
        "scan_id": "case when c_custkey % 7 = 3 then -c_custkey else c_custkey end",
        "domain": "concat('c', cast(c_custkey as string), '.example.com')",
    }),
    "required_tools": Binding("customer", {
        "scan_id": "c_custkey",
        "tool": "concat('tool', cast(c_custkey % 130 + c_custkey % 2 * 50 as string))",
    }),
    "message_events": Binding("events", {
        "scan_id": "user_id", "seq": "event_id",
        "kind": "case event_type when 'view' then 'start' when 'click' then 'complete' "
                "when 'signup' then 'cancelled' when 'purchase' then 'other' else 'error' end",
        "domain": "concat('c', cast(user_id as string), '.example.com')",
        "detail": "case when event_id % 7 = 0 then null else props end",
    }),
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BINDINGS[name].frame(spark, sf_dir)


def with_bindings(names: list[str], query: str) -> str:
    """``query`` with the named relations in front as common table expressions."""
    ctes = ",\n".join(f"{name} as ({BINDINGS[name].sql()})" for name in names)
    return f"with {ctes}\n{query}"
