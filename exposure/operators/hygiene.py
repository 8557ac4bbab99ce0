"""Raw lines to clean relations: hosts are a set, probe lines and findings are bags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposure.functions import text


def load_hosts(lines: DataFrame) -> DataFrame:
    """(scan_id, line) -> unique (scan_id, host): trimmed, no blanks."""
    return (
        lines.filter(text.not_blank(F.col("line")))
        .select("scan_id", text.stripped(F.col("line")).alias("host"))
        .dropDuplicates(["scan_id", "host"])
    )


def load_probe_lines(lines: DataFrame) -> DataFrame:
    """Remove terminal colours, trim, drop blanks; duplicates stay."""
    plain = text.without_ansi(F.col("line"))
    return lines.filter(text.has_text(plain)).withColumn("line", text.stripped(plain))


def load_findings(lines: DataFrame) -> DataFrame:
    """Trim and drop blanks; duplicates stay."""
    return lines.filter(text.not_blank(F.col("line"))).withColumn(
        "line", text.stripped(F.col("line"))
    )


def validate_hosts(hosts: DataFrame) -> DataFrame:
    """Add ``domain`` (a URL's authority, else the text itself) and ``is_valid``."""
    return hosts.withColumns(
        {"domain": text.authority(F.col("host")), "is_valid": text.valid_host(F.col("host"))}
    )


def valid_hosts(hosts: DataFrame) -> DataFrame:
    return validate_hosts(hosts).filter("is_valid").drop("is_valid")


def quarantined_hosts(hosts: DataFrame) -> DataFrame:
    return validate_hosts(hosts).filter("not is_valid").drop("is_valid")
