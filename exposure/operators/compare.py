"""What changed between a scan and the one before it, for lists of lines and for folders of files.

Scans (scan_id, target, started) of one target follow one another by (started, scan_id).

Lists are compared as multisets: every scan's lines are counted once, and each count is used twice,
as the scan's own and as what its successor had before. Both meet in one aggregation by (scan, line),
so no scan's lines ever have to fit in one task and no two lists are joined.

Folders are compared by a tree of hashes. A file's hash is that of its contents, a folder's the sum of
its entries' hashes, so a folder of any size combines before the shuffle. The comparison starts at the
roots and opens only folders whose hashes differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposure.operators.joins import lookup_join
from exposure.operators.ordered import MAX_GROUP_ROWS, PREVIOUS, running
from exposure.session import materialize

CHANGES = ("added", "removed", "same", "more", "fewer")


def predecessors(scans: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """(scan_id, previous_scan_id) of every scan that has one before it; scans without id are left out."""
    return running(
        scans.where("scan_id is not null").select("scan_id", "target", "started"), ["target"], ["started", "scan_id"],
        {"previous_scan_id": (PREVIOUS, F.col("scan_id"))}, max_group_rows,
    ).where("previous_scan_id is not null").select("scan_id", "previous_scan_id")


def _now_and_before(rows: DataFrame, pairs: DataFrame, values: list[str]) -> DataFrame:
    """Each scan's rows with now_* values, and its predecessor's with before_* values, in one list."""
    plain = [c for c in rows.columns if c not in values and c != "scan_id"]
    own = lookup_join(rows, pairs.select("scan_id"), ["scan_id"], "left_semi").select(
        "scan_id", *plain, *[F.col(v).alias(f"now_{v}") for v in values],
        *[F.lit(None).cast(rows.schema[v].dataType).alias(f"before_{v}") for v in values])
    following = pairs.select(
        F.col("previous_scan_id").alias("scan_id"), F.col("scan_id").alias("_next"))
    earlier = lookup_join(rows, following, ["scan_id"], "inner").select(
        F.col("_next").alias("scan_id"), *plain,
        *[F.lit(None).cast(rows.schema[v].dataType).alias(f"now_{v}") for v in values],
        *[F.col(v).alias(f"before_{v}") for v in values])
    return own.unionByName(earlier)


def line_changes(lines: DataFrame, pairs: DataFrame, column: str = "line") -> DataFrame:
    """(scan_id, line, before, now, change) for every line of a scan or of its predecessor.

    ``before`` and ``now`` say how often the line is there; ``change`` is one of CHANGES. A null line
    is a line like others.
    """
    counted = lines.select("scan_id", F.col(column).alias("line")).groupBy("scan_id", "line").agg(
        F.count(F.lit(1)).alias("n"))
    met = _now_and_before(counted, pairs, ["n"]).groupBy("scan_id", "line").agg(
        F.coalesce(F.sum("before_n"), F.lit(0)).alias("before"),
        F.coalesce(F.sum("now_n"), F.lit(0)).alias("now"))
    change = (
        F.when(F.col("before") == 0, "added").when(F.col("now") == 0, "removed")
        .when(F.col("before") == F.col("now"), "same")
        .when(F.col("before") < F.col("now"), "more").otherwise("fewer"))
    return met.withColumn("change", change)


def comparison(changes: DataFrame, pairs: DataFrame) -> DataFrame:
    """How many lines of each kind of change, for every pair of scans, those without lines too."""
    counts = changes.groupBy("scan_id").agg(
        *[F.count_if(F.col("change") == c).alias(c) for c in CHANGES])
    return pairs.join(counts, "scan_id", "left").select(
        "scan_id", "previous_scan_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in CHANGES])


# --- trees of hashes -----------------------------------------------------------------------------

def _words(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, 1 + 8 * n, 8), 16, 10).cast("decimal(38,0)") for n in range(4)]


def hash_tree(files: DataFrame) -> DataFrame:
    """(scan_id, depth, path, folder, is_file, entries, hash) of files (scan_id, path, content).

    The root has depth 0 and the path ''. ``entries`` counts the files below. A folder's hash follows
    from the names and hashes of its entries, in any order. Paths are unique within a scan; a null
    content counts as empty. One job for the greatest depth, one table for each level.
    """
    parts = F.split(F.regexp_replace("path", "^/+", ""), "/+")
    leaves = materialize(files.select(
        "scan_id", F.size(parts).alias("depth"), F.array_join(parts, "/").alias("path"),
        F.lit(True).alias("is_file"), F.lit(1).cast("bigint").alias("entries"),
        F.md5(F.coalesce(F.col("content").cast("binary"), F.lit(b""))).alias("hash")), "tree")
    deepest = leaves.agg(F.max("depth")).first()[0] or 0
    parent = F.regexp_replace("path", "(^|/)[^/]*$", "")
    tree = level = None
    for depth in range(deepest, -1, -1):
        here = leaves.where(F.col("depth") == depth)
        level = here if level is None else here.unionByName(level)
        level = level.withColumn("folder", F.when(F.col("depth") > 0, parent))
        tree = level if tree is None else tree.unionByName(level)
        named = F.md5(F.concat_ws(":", F.col("is_file").cast("string"), "path", "hash"))
        sums = [f"_w{n}" for n in range(4)]
        level = materialize(level.withColumn("_h", named).groupBy("scan_id", "folder").agg(
            F.sum("entries").alias("entries"),
            *[F.sum(w).alias(s) for w, s in zip(_words(F.col("_h")), sums)]
        ).select(
            "scan_id", F.lit(depth - 1).alias("depth"), F.col("folder").alias("path"),
            F.lit(False).alias("is_file"), "entries",
            F.md5(F.concat_ws("-", "entries", *sums)).alias("hash")), "tree") if depth else None
    return tree


def corpus_roots(tree: DataFrame) -> DataFrame:
    """One hash for each scan's whole folder."""
    return tree.where("depth = 0").select("scan_id", "entries", "hash")


def tree_changes(tree: DataFrame, pairs: DataFrame) -> DataFrame:
    """(scan_id, path, change): files added, removed or changed since the scan before.

    Level by level, and only below folders that differ.
    """
    tree = tree.select("scan_id", "depth", "path", "folder", "is_file", "hash")
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    found, unequal = None, pairs.select("scan_id", F.lit(None).cast("string").alias("folder"))
    for depth in range(deepest + 1):
        rows = tree.where(F.col("depth") == depth).drop("depth")
        met = _now_and_before(rows, pairs, ["hash"])
        # Files and folders of one name are different entries.
        opened = F.col("folder").eqNullSafe(F.col("_folder")) & (F.col("scan_id") == F.col("_scan"))
        met = met.join(unequal.toDF("_scan", "_folder"), opened, "left_semi")
        differing = met.groupBy("scan_id", "path", "is_file").agg(
            F.max("before_hash").alias("before"), F.max("now_hash").alias("now")).where(
            ~F.col("before").eqNullSafe(F.col("now")))
        differing = materialize(differing, "differing")
        files = differing.where("is_file").select(
            "scan_id", "path", F.when(F.col("before").isNull(), "added")
            .when(F.col("now").isNull(), "removed").otherwise("changed").alias("change"))
        found = files if found is None else found.unionByName(files)
        unequal = differing.where("not is_file").select("scan_id", F.col("path").alias("folder"))
    return found
