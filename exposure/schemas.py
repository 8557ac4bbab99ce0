"""Vocabulary and schemas shared by every operator."""

from __future__ import annotations

# Fixed values -----------------------------------------------------------
# They must equal the reference data format for results to match.

SEVERITIES = ("critical", "high", "medium", "low", "info")
DEFAULT_SEVERITIES = ("critical", "high", "medium")

PHASES = ("subdomain_enumeration", "alive_check", "vulnerability_scan")
STATISTICS = ("subdomains_found", "alive_subdomains", "vulnerabilities_found")
REQUIRED_FIELDS = (
    "scan_id", "domain", "start_time", "last_update", "status",
    "phases", "statistics", "environment",
)
REQUIRED_PHASE_FIELDS = ("status", "progress_percentage", "results_count")

CACHE_TTL_SECONDS = 86_400
MEMORY_THRESHOLD_MB = 1_024
MEMORY_WARNING_RATIO = 0.8
SNAPSHOTS_KEPT = 5
PREVIEW_ROWS = 10
MESSAGE_ITEMS = 100
FINGERPRINT_SAMPLE = 100

ANSI_PATTERN = r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])"
EMBED_COLOR = 0x00FF00

# Two producers name the same scanning status differently; readers use the right-hand names.
STATUS_ALIASES = {
    "enumerating_subdomains": "discovering_subdomains",
    "checking_alive_domains": "probing_subdomains",
    "failed": "error",
}

# Schemas ----------------------------------------------------------------

PHASE_STATE = (
    "scan_id bigint, phase string, status string, progress int, "
    "results_count bigint, ts timestamp_ntz, seq bigint"
)

DOCUMENT_STATE = "scan_id bigint, ts timestamp_ntz, seq bigint, doc string"

LAST_STATUS = "scan_id bigint, seq bigint, ts timestamp_ntz, status string, arrived bigint"

TRANSITIONS = (
    "scan_id bigint, seq bigint, ts timestamp_ntz, previous_status string, status string"
)

SCAN_STATE = (
    "status string, start_time double, duration double, subdomains bigint, "
    "alive_subdomains bigint, vulnerabilities bigint, error string"
)
