"""Notification payload rows. They are built here and never sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposure.operators.joins import lookup_join
from exposure.operators.ordered import MAX_GROUP_ROWS, ROW_NUMBER, running
from exposure.schemas import EMBED_COLOR, MESSAGE_ITEMS

# Message texts and titles.
SUBDOMAINS_FOUND = ("🔍 Found %d subdomains for %s%s:\n", "Subdomains Found")
ALIVE_SUBDOMAINS = ("🌐 Found %d alive subdomains for %s%s:\n", "Alive Subdomains")
SAMPLE_NOTE = " (showing %d sample)"
BULLET = "• "
MORE_ITEMS = "\n... and %d more"
SCAN_RESULTS = ("📊 Scan results for %s:\n```\n%s\n```", "Scan Results")
EVENT_TEXTS = {
    "start": ("🚀 Starting security scan for domain: %s", "Scan Started"),
    "complete": ("✅ Scan completed for domain: %s", "Scan Completed"),
    "no_findings": ("✅ No vulnerabilities found for %s", "Scan Completed"),
}
DETAIL_TEXTS = {
    "cancelled": ("🚫 Scan cancelled for %s\nReason: %s", "Scan Cancelled"),
    "error": ("❌ Error scanning domain %s:\n```\n%s\n```", "Scan Error"),
}
DEFAULT_CANCEL_REASON = "User cancelled"

# What stands for the domain of a scan without a domain row.
UNKNOWN_DOMAIN = "unknown domain"


def payload(content: Column, title: Column) -> Column:
    """The JSON body a webhook expects; no title means no embed."""
    embed = F.struct(title.alias("title"), F.lit(EMBED_COLOR).alias("color"))
    embeds = F.when(title.isNotNull(), F.array(embed)).otherwise(
        F.array().cast("array<struct<title:string,color:int>>")
    )
    return F.to_json(F.struct(content.alias("content"), embeds.alias("embeds")))


def list_messages(
    items: DataFrame, domains: DataFrame, text_and_title: tuple[str, str],
    totals: DataFrame | None = None, shown: int = MESSAGE_ITEMS,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """All items of each scan in messages of ``shown`` items.

    Part 0 has the first items and says how many follow; the parts after it hold those, so that no
    item is left out. ``items`` (scan_id, item); ``domains`` (scan_id, domain). ``totals``
    (scan_id, total) is given when ``items`` is only a sample of what was found. Scans without
    items get a message that says so, items of scans without a domain row get theirs all the same.
    """
    template, title = text_and_title
    numbered = running(
        items.select("scan_id", "item"), ["scan_id"], ["item"], {"_row": (ROW_NUMBER, None)},
        max_group_rows,
    )
    parts = numbered.groupBy(
        "scan_id", F.floor((F.col("_row") - 1) / shown).alias("part")
    ).agg(F.sort_array(F.collect_list("item")).alias("_shown"))
    counts = items.groupBy("scan_id").agg(F.count(F.lit(1)).alias("_given"))
    scans = domains.join(counts, "scan_id", "full_outer")
    if totals is not None:
        scans = scans.join(
            totals.select("scan_id", F.col("total").alias("_total")), "scan_id", "left"
        )
    else:
        scans = scans.withColumn("_total", F.lit(None).cast("bigint"))
    empty = scans.filter(F.col("_given").isNull()).withColumns({
        "part": F.lit(0).cast("bigint"), "_shown": F.array().cast("array<string>"),
    })
    rows = lookup_join(parts, scans, ["scan_id"]).unionByName(empty).withColumns({
        "_given": F.coalesce("_given", F.lit(0).cast("bigint")),
        "domain": F.coalesce("domain", F.lit(UNKNOWN_DOMAIN)),
    })
    note = F.when(
        F.col("_given") < F.col("_total"), F.format_string(SAMPLE_NOTE, F.col("_given"))
    ).otherwise("")
    header = F.format_string(
        template, F.coalesce("_total", "_given"), F.col("domain"), note
    )
    bullets = F.array_join(F.transform("_shown", lambda i: F.concat(F.lit(BULLET), i)), "\n")
    more = F.when(
        (F.col("part") == 0) & (F.col("_given") > shown),
        F.format_string(MORE_ITEMS, F.col("_given") - shown),
    ).otherwise("")
    content = F.concat(header, bullets, more)
    return rows.select(
        "scan_id", "part", F.lit(title).alias("title"), content.alias("content"),
        payload(content, F.lit(title)).alias("payload"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Start, completion, cancellation and error messages (scan_id, seq, kind, domain, detail)."""
    kind, domain = F.col("kind"), F.col("domain")
    detail = F.coalesce(
        "detail", F.when(kind == "cancelled", F.lit(DEFAULT_CANCEL_REASON)), F.lit("")
    )
    content, title = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (template, heading) in EVENT_TEXTS.items():
        content = F.when(kind == name, F.format_string(template, domain)).otherwise(content)
        title = F.when(kind == name, F.lit(heading)).otherwise(title)
    for name, (template, heading) in DETAIL_TEXTS.items():
        content = F.when(kind == name, F.format_string(template, domain, detail)).otherwise(content)
        title = F.when(kind == name, F.lit(heading)).otherwise(title)
    known = [*EVENT_TEXTS, *DETAIL_TEXTS]
    return events.filter(kind.isin(*known)).select(
        "scan_id", "seq", title.alias("title"), content.alias("content"),
        payload(content, title).alias("payload"),
    )


def result_messages(
    findings: DataFrame, domains: DataFrame, order: list[str],
    lines_per_part: int = MESSAGE_ITEMS, max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """All result lines of each scan, in order, in parts of a bounded number of lines.

    A scan that fits in one part gets exactly one message. Scans in ``domains`` without findings
    get the message that says so, as part 0; findings of scans without a domain row get theirs.
    """
    template, title = SCAN_RESULTS
    numbered = running(
        findings.select("scan_id", *order, "line"), ["scan_id"], order,
        {"_row": (ROW_NUMBER, None)}, max_group_rows,
    )
    parts = (
        numbered.groupBy(
            "scan_id", F.floor((F.col("_row") - 1) / lines_per_part).alias("part")
        )
        .agg(F.sort_array(F.collect_list(F.struct("_row", "line"))).alias("_lines"))
        .select("scan_id", "part", F.array_join("_lines.line", "\n").alias("_text"))
    )
    filled = lookup_join(parts, domains, ["scan_id"], "left").select(
        "scan_id", "part", F.lit(title).alias("title"),
        F.format_string(
            template, F.coalesce("domain", F.lit(UNKNOWN_DOMAIN)), F.col("_text")
        ).alias("content"),
    )
    empty_template, empty_title = EVENT_TEXTS["no_findings"]
    empty = domains.join(
        findings.select("scan_id").dropDuplicates(), "scan_id", "left_anti"
    ).select(
        "scan_id", F.lit(0).cast("bigint").alias("part"), F.lit(empty_title).alias("title"),
        F.format_string(empty_template, F.col("domain")).alias("content"),
    )
    return filled.unionByName(empty).withColumn(
        "payload", payload(F.col("content"), F.col("title"))
    )
