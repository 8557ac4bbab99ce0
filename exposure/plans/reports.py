"""End-to-end reports: what a full run, a resumed run and a results view answer, for all scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposure.operators import checkpoints, findings, hygiene, inventory
from exposure.schemas import PHASES, SEVERITIES


def _stack(parts: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """Sum per-scan measures of several inputs in one aggregation (no join can multiply rows)."""
    names = [name for _, measures in parts for name in measures]
    rows = [
        df.groupBy("scan_id").agg(*[measures[n].alias(n) for n in measures])
        .select("scan_id", *[
            (F.col(n) if n in measures else F.lit(0)).cast("bigint").alias(n) for n in names
        ])
        for df, measures in parts
    ]
    return reduce(DataFrame.unionByName, rows).groupBy("scan_id").agg(
        *[F.sum(n).alias(n) for n in names]
    )


def fleet_report(host_lines: DataFrame, probe_lines: DataFrame, finding_lines: DataFrame) -> DataFrame:
    """Hosts, valid hosts, hosts that answered and findings by severity, one row per scan."""
    hosts = hygiene.validate_hosts(hygiene.load_hosts(host_lines))
    alive = inventory.alive_hosts(
        hosts, hygiene.load_probe_lines(probe_lines)
    )
    tagged = findings.tag_severity(hygiene.load_findings(finding_lines))
    one = F.count(F.lit(1))
    return _stack([
        (hosts, {"hosts": one, "valid_hosts": F.count_if("is_valid")}),
        (alive, {"alive_hosts": one}),
        (tagged, {
            "findings": one,
            **{level: F.count_if(F.col("severity") == level) for level in SEVERITIES},
        }),
    ])


def resume_plan(documents: DataFrame, targets: DataFrame, processed: DataFrame) -> DataFrame:
    """For every scan: can its document be read, what is wrong, what is left to do.

    Scans with targets but no document are listed as missing, with everything to do.
    """
    loaded = checkpoints.load_checkpoints(documents).withColumn(
        "_pending", checkpoints.pending_list(F.col("phases"))
    )
    checked = checkpoints.checkpoint_issues(loaded, keep=("load_status", "_pending"))
    left = inventory.resume_worklist(targets, processed).groupBy("scan_id").agg(
        F.count(F.lit(1)).alias("targets_left")
    )
    return (
        checked.select(
            "scan_id", "load_status", F.size("issues").alias("issues"),
            F.size("_pending").alias("pending_phases"),
            F.try_element_at("_pending", F.lit(1))["phase"].alias("next_phase"),
        )
        .join(left, "scan_id", "full_outer")
        .na.fill("missing", ["load_status"]).na.fill(1, ["issues"])
        .na.fill(0, ["targets_left"])
        .withColumns({
            "next_phase": F.when(F.col("pending_phases").isNull(), PHASES[0])
            .otherwise(F.col("next_phase")),
            "pending_phases": F.coalesce("pending_phases", F.lit(len(PHASES))),
        })
    )


def results_report(state: DataFrame, results: DataFrame, batch_lines: DataFrame) -> DataFrame:
    """Reported and found findings by severity; empty results are read from the batch files.

    Both inputs are counted once, and each scan takes the counts of one of them: no line is
    shuffled. Scans with lines but no state row are listed with nothing reported and
    ``has_state = false``.
    """
    names = ["found", *SEVERITIES]

    def counts(prefix: str) -> dict[str, Column]:
        return {
            f"{prefix}found": F.count(F.lit(1)),
            **{f"{prefix}{name}": F.count_if(F.col("severity") == name) for name in SEVERITIES},
        }

    counted = _stack([
        (findings.tag_severity(results.select("scan_id", "line")), counts("_r_")),
        (findings.tag_severity(hygiene.load_findings(batch_lines).select("scan_id", "line")),
         counts("_b_")),
    ])
    joined = (
        state.select(
            "scan_id", F.col("vulnerabilities").alias("reported"), F.lit(True).alias("has_state")
        )
        .join(counted, "scan_id", "full_outer")
        .na.fill(0).na.fill(False, ["has_state"])
        .filter(F.col("has_state") | (F.col("_r_found") > 0))
    )
    rebuild = (F.col("reported") > 0) & (F.col("_r_found") == 0)
    return joined.select(
        "scan_id", "reported", "has_state",
        (rebuild & (F.col("_b_found") > 0)).cast("int").alias("is_rebuilt"),
        *[F.when(rebuild, F.col(f"_b_{n}")).otherwise(F.col(f"_r_{n}")).alias(n) for n in names],
    )
