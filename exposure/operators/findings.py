"""Finding lines: severity, previews, consolidation of batch files, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exposure.functions import severity as sev
from exposure.functions import text
from exposure.operators import hygiene
from exposure.operators.joins import WAYS, lookup_join
from exposure.schemas import PREVIEW_ROWS


def tag_severity(lines: DataFrame) -> DataFrame:
    return lines.withColumn("severity", sev.severity_of(F.col("line")))


def severity_counts(tagged: DataFrame) -> DataFrame:
    """Findings per scan and severity; untagged lines and empty levels have no row."""
    # Counting the severity leaves untagged lines at 0; testing it before the aggregation would
    # make Spark derive it from the line twice.
    return (
        tagged.groupBy("scan_id", "severity").agg(F.count("severity").alias("findings"))
        .filter(F.col("findings") > 0)
        .withColumns({
            "severity_rank": sev.severity_rank(F.col("severity")),
            "label": F.initcap("severity"),
        })
    )


def filter_severity(tagged: DataFrame, requested: list[str]) -> DataFrame:
    """Keep the requested levels of all scans; no request keeps every row."""
    return tagged.filter(F.col("severity").isin(*requested)) if requested else tagged


def filter_severity_requests(
    tagged: DataFrame, requests: DataFrame, ways: int = WAYS,
) -> DataFrame:
    """Keep what each scan asked for: ``requests`` has one row (scan_id, severities) per scan.

    A scan without a request, or with an empty one, keeps every row.
    """
    wanted = requests.select("scan_id", F.col("severities").alias("_wanted"))
    return (
        lookup_join(tagged, wanted, ["scan_id"], "left", ways)
        .filter(sev.severity_wanted(F.col("severity"), F.col("_wanted")))
        .select(*tagged.columns)
    )


def check_severity_requests(requests: DataFrame) -> DataFrame:
    return requests.withColumn("is_valid", sev.known_severities(F.col("severities")))


def top_rows(lines: DataFrame, order: list[str | Column], rows: int) -> DataFrame:
    """The first rows of each scan; Spark limits every task's groups before the shuffle."""
    window = Window.partitionBy("scan_id").orderBy(*order)
    return lines.withColumn("position", F.row_number().over(window)).filter(
        F.col("position") <= rows
    )


def finding_preview(lines: DataFrame, order: list[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first lines of each scan and how many more there are."""
    totals = lines.groupBy("scan_id").agg(F.count(F.lit(1)).alias("_total"))
    return (
        top_rows(lines, order, rows).join(totals, "scan_id")
        .select(
            "scan_id", "position", "line",
            F.greatest(F.col("_total") - rows, F.lit(0)).alias("more_findings"),
        )
    )


def _kept_files(records: DataFrame, inventory: DataFrame) -> DataFrame:
    """One record per output file that exists with content: batches may share a file."""
    filled = inventory.filter(F.col("length") > 0).select("path").dropDuplicates()
    return (
        records.filter(F.col("path").isNotNull())
        .groupBy("scan_id", "path").agg(F.min("batch_id").alias("batch_id"))
        .join(filled, "path", "left_semi")
    )


def consolidate_findings(
    records: DataFrame, inventory: DataFrame, file_lines: DataFrame, ways: int = WAYS,
) -> DataFrame:
    """Non-blank lines of every batch output file that exists with content, each file once.

    ``records`` (scan_id, batch_id, path, error), ``inventory`` (path, length),
    ``file_lines`` (path, seq, line).
    """
    return lookup_join(
        hygiene.load_findings(file_lines), _kept_files(records, inventory), ["path"], "inner",
        ways,
    ).select("scan_id", "batch_id", "path", "seq", "line")


def consolidation_totals(
    records: DataFrame, inventory: DataFrame, file_lines: DataFrame
) -> DataFrame:
    """Per scan: batches run, batches failed, files kept, findings."""
    batches = (
        records.groupBy("scan_id", "batch_id")
        .agg(F.max(F.col("error").isNotNull()).alias("failed"))
        .groupBy("scan_id").agg(
            F.count(F.lit(1)).alias("batches"), F.count_if("failed").alias("batch_errors")
        )
    )
    per_file = (
        file_lines.filter(text.not_blank(F.col("line")))
        .groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    )
    files = (
        _kept_files(records, inventory).join(per_file, "path", "left")
        .groupBy("scan_id").agg(
            F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("findings")
        )
    )
    return batches.join(files, "scan_id", "left").na.fill(0, ["files", "findings"])


def reconcile_findings(state: DataFrame, results: DataFrame) -> DataFrame:
    """Compare each scan's reported number of findings with its loaded result lines.

    Scans with result lines but no state row are listed with ``has_state = false``.
    """
    counted = tag_severity(results).groupBy("scan_id").agg(
        F.count(F.lit(1)).alias("counted"), F.count("severity").alias("classified"),
    )
    return (
        state.select(
            "scan_id", F.coalesce("vulnerabilities", F.lit(0)).alias("reported"),
            F.lit(True).alias("has_state"),
        )
        .join(counted, "scan_id", "full_outer")
        .na.fill(0, ["reported", "counted", "classified"]).na.fill(False, ["has_state"])
        .withColumns({
            "unclassified": F.col("counted") - F.col("classified"),
            "is_mismatch": F.col("reported") != F.col("counted"),
            "needs_rebuild": (F.col("reported") > 0) & (F.col("counted") == 0),
        })
    )


def rebuild_empty_results(
    state: DataFrame, results: DataFrame, batch_lines: DataFrame, ways: int = WAYS,
) -> DataFrame:
    """Batch lines of the scans whose results are empty although findings were reported.

    These scans hold no result rows, so writing the rows back is an append; a second run finds
    the scans filled and returns nothing for them.
    """
    flagged = reconcile_findings(state, results).filter("needs_rebuild").select("scan_id")
    return lookup_join(
        hygiene.load_findings(batch_lines), flagged, ["scan_id"], "left_semi", ways,
    )


def scan_funnel(hosts: DataFrame, probe_lines: DataFrame, findings: DataFrame) -> DataFrame:
    """Per scan: unique hosts, probe lines and finding lines, as they were loaded.

    One aggregation over the stacked inputs, so that no join can multiply rows.
    """
    steps = ["hosts", "alive", "findings"]

    def marked(df: DataFrame, step: str) -> DataFrame:
        return df.select("scan_id", *[F.lit(int(s == step)).alias(s) for s in steps])

    stacked = reduce(
        DataFrame.unionByName,
        [
            marked(hosts, "hosts"), marked(probe_lines, "alive"), marked(findings, "findings"),
        ],
    )
    return stacked.groupBy("scan_id").agg(*[F.sum(s).alias(s) for s in steps])
