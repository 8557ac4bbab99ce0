"""Scans against the ones before them: multisets of lines, and trees of files."""

import pytest
from pyspark.sql import functions as F

from exposure.operators import compare

SCANS = "scan_id bigint, target string, started bigint"
LINES = "scan_id bigint, line string"
FILES = "scan_id bigint, path string, content string"


def scans(spark):
    return spark.createDataFrame(
        [(5, "a", 1), (3, "a", 2), (4, "a", 2), (9, "b", 1), (None, "b", 2)], SCANS)


def test_predecessors_follow_start_and_id(spark):
    for limit in (1, 100):
        pairs = compare.predecessors(scans(spark), limit)
        assert sorted(map(tuple, pairs.where("scan_id is not null").collect())) == [(3, 5), (4, 3)]


def test_lines_are_counted(spark):
    rows = {5: ["x", "x", "y", None, "z"], 3: ["x", "x", "x", "y", None, None], 9: ["q"]}
    lines = spark.createDataFrame([(s, line) for s, ls in rows.items() for line in ls], LINES)
    pairs = compare.predecessors(scans(spark))
    changes = compare.line_changes(lines, pairs)
    found = {(r["scan_id"], r["line"]): (r["before"], r["now"], r["change"]) for r in changes.collect()}
    assert found == {
        (3, "x"): (2, 3, "more"), (3, "y"): (1, 1, "same"), (3, None): (1, 2, "more"),
        (3, "z"): (1, 0, "removed"), (4, "x"): (3, 0, "removed"), (4, "y"): (1, 0, "removed"),
        (4, None): (2, 0, "removed")}
    table = compare.comparison(changes, pairs).where("scan_id is not null")
    assert sorted(map(tuple, table.collect())) == [(3, 5, 0, 1, 1, 2, 0), (4, 3, 0, 3, 0, 0, 0)]
    none = compare.line_changes(lines.limit(0), pairs)
    assert none.isEmpty()
    assert compare.comparison(none, pairs).where("scan_id = 3").first()["same"] == 0


TREE = {"a/b/1": "x", "a/b/2": "y", "a/3": "z", "4": "w", "c/d/e/5": "v"}


def tree(spark, versions):
    return compare.hash_tree(spark.createDataFrame(
        [(s, p, c) for s, files in versions.items() for p, c in files.items()], FILES))


def test_equal_folders_have_equal_hashes(spark):
    found = tree(spark, {5: TREE, 3: dict(reversed(TREE.items())), 4: TREE | {"a/b/2": "Y"}})
    hashes = {(r["scan_id"], r["path"]): r["hash"] for r in found.collect()}
    assert {r["scan_id"]: r["entries"] for r in compare.corpus_roots(found).collect()} == {
        3: 5, 4: 5, 5: 5}
    assert hashes[5, ""] == hashes[3, ""] != hashes[4, ""]
    assert hashes[5, "a"] != hashes[4, "a"] and hashes[5, "a/b"] != hashes[4, "a/b"]
    assert hashes[5, "c"] == hashes[4, "c"] and hashes[5, "a/b"] != hashes[5, "c/d"]
    moved = {(r["scan_id"], r["path"]): r["hash"] for r in tree(
        spark, {1: {"a/1": "x", "b/2": "y"}, 2: {"a/2": "y", "b/1": "x"}}).collect()}
    assert moved[1, ""] != moved[2, ""]


def test_changes_are_found_from_the_root(spark, monkeypatch):
    newer = {"a/b/1": "x", "a/b/2": "changed", "4": "w", "c/d/e/5": "v", "c/d": "now a file",
             "n/new": None, "a/3/deep": "z"}
    opened, keep = [], compare.materialize

    def remember(df, name):
        df = keep(df, name)
        if name == "differing":
            opened.append({(r["scan_id"], r["path"]) for r in df.collect()})
        return df

    monkeypatch.setattr(compare, "materialize", remember)
    pairs = spark.createDataFrame([(3, 5), (4, 3)], "scan_id bigint, previous_scan_id bigint")
    changes = compare.tree_changes(tree(spark, {5: TREE, 3: newer, 4: newer}), pairs)
    assert sorted(map(tuple, changes.collect())) == [
        (3, "a/3", "removed"), (3, "a/3/deep", "added"), (3, "a/b/2", "changed"),
        (3, "c/d", "added"), (3, "n/new", "added")]
    assert not any(s == 4 for level in opened for s, _ in level)
    assert (3, "c/d/e") not in set().union(*opened)


@pytest.mark.parametrize("versions", [{}, {5: TREE}])
def test_nothing_to_compare(spark, versions):
    files = spark.createDataFrame(
        [(s, p, c) for s, fs in versions.items() for p, c in fs.items()], FILES)
    found = compare.hash_tree(files)
    pairs = compare.predecessors(scans(spark).where(F.lit(False)))
    assert compare.tree_changes(found, pairs).isEmpty()
