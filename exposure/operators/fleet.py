"""Tool versions and template corpora across scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exposure.functions import versions
from exposure.operators.joins import lookup_join
from exposure.schemas import FINGERPRINT_SAMPLE

# Message texts.
DRIFT_MESSAGE = "Tool version mismatch for %s: %s (checkpoint) vs %s (current)"
CORPUS_CURRENT = "Templates already at latest version (commit: %s)"
CORPUS_OUTDATED = "New templates available (current: %s, latest: %s)"


def recorded_versions(loaded: DataFrame) -> DataFrame:
    """(scan_id, tool, version) rows out of loaded documents."""
    return loaded.select(
        "scan_id", F.explode("environment.tool_versions").alias("tool", "version")
    )


def current_versions(outputs: DataFrame) -> DataFrame:
    """Parse what each tool prints about itself (tool, version_text)."""
    return outputs.select(
        "tool",
        F.coalesce(
            F.nullif(versions.version_from_text(F.col("version_text")), F.lit("")),
            F.lit("unknown"),
        ).alias("version"),
    )


def environment_drift(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Tools known on both sides whose versions differ."""
    now = current.select("tool", F.col("version").alias("current_version"))
    return (
        lookup_join(recorded, now, ["tool"]).filter(F.col("version") != F.col("current_version"))
        .select(
            "scan_id", "tool", "version", "current_version",
            F.format_string(
                DRIFT_MESSAGE, F.col("tool"), F.col("version"), F.col("current_version")
            ).alias("message"),
            ((F.col("version") == "unknown") | (F.col("current_version") == "unknown"))
            .alias("has_unknown"),
        )
    )


def environment_validity(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Per scan: tools compared, mismatches, and whether the environment still matches."""
    now = current.select("tool", F.col("version").alias("current_version"))
    return (
        lookup_join(recorded, now, ["tool"], "left").groupBy("scan_id").agg(
            F.count("current_version").alias("compared"),
            F.count_if(F.col("version") != F.col("current_version")).alias("mismatches"),
        )
        .withColumn("is_valid", F.col("mismatches") == 0)
    )


def outdated_tools(
    installed: DataFrame, latest: DataFrame, required: DataFrame | None = None, force: bool = False
) -> DataFrame:
    """Which tools need an update: none installed, or a release that is not part of the installed
    version's text. A tool without a known release is listed and needs none.

    ``required`` (scan_id, tool) lists what each scan needs; without it, what is installed counts.
    Containment is the rule (1.2.3 is "in" 1.2.30); ``exact_match`` tells the two apart.
    """
    released = latest.select(
        "tool", versions.version_of_tag(F.col("tag")).alias("latest_version")
    )
    contained = F.coalesce(F.contains("version", "latest_version"), F.lit(False))
    known = installed
    if required is not None:
        # A scan lists a tool once, so neither side has more rows for a key than scans.
        known = required.select("scan_id", "tool").dropDuplicates().join(
            installed, ["scan_id", "tool"], "left")
    return lookup_join(known, released, ["tool"], "left").select(
        "scan_id", "tool", "version", "latest_version",
        (F.col("latest_version").isNotNull() & (F.lit(force) | ~contained)).alias("needs_update"),
        F.coalesce(F.col("version") == F.col("latest_version"), F.lit(False)).alias("exact_match"),
    )


def corpus_files(files: DataFrame) -> DataFrame:
    return files.filter(F.col("path").endswith(".yaml"))


def corpus_sample(files: DataFrame, size: int = FINGERPRINT_SAMPLE) -> DataFrame:
    """At most ``size`` template files per scan, chosen by the hash of their path."""
    chosen = Window.partitionBy("scan_id").orderBy(F.md5("path"), "path")
    return (
        corpus_files(files).withColumn("_n", F.row_number().over(chosen))
        .filter(F.col("_n") <= size).drop("_n")
    )


def corpus_fingerprint(files: DataFrame) -> DataFrame:
    """One hash per scan over the contents of its template files.

    Every file's MD5 is split into four numbers, which are summed per scan. Sums do not depend on
    file order or partitioning and combine before the shuffle, so a corpus of any size travels as
    one row per task.
    """
    digest = F.md5(F.col("content").cast("binary"))

    def word(n: int) -> Column:
        return F.conv(F.substring(digest, 1 + 8 * n, 8), 16, 10).cast("bigint")

    sums = [f"_w{n}" for n in range(4)]
    return (
        corpus_files(files).groupBy("scan_id")
        .agg(F.count(F.lit(1)).alias("files"),
             *[F.sum(word(n)).alias(name) for n, name in enumerate(sums)])
        .select(
            "scan_id", "files",
            F.md5(F.concat_ws("-", "files", *sums)).alias("fingerprint"),
        )
    )


def corpus_staleness(markers: DataFrame, latest: DataFrame) -> DataFrame:
    """Local commit marker (scan_id, repo, local_commit) against the latest one (repo, commit).

    A scan without a marker needs an update.
    """
    newest = latest.select("repo", F.col("commit").alias("latest_commit"))
    local, last = (
        versions.short_commit(F.col(c)) for c in ("local_commit", "latest_commit")
    )
    current = F.col("local_commit").eqNullSafe(F.col("latest_commit"))
    return lookup_join(markers, newest, ["repo"], "left").select(
        "scan_id", "repo", (~current).alias("needs_update"),
        F.when(current, F.format_string(CORPUS_CURRENT, local))
        .when(F.col("local_commit").isNotNull(), F.format_string(CORPUS_OUTDATED, local, last))
        .alias("message"),
    )
