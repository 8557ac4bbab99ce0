"""Template folders: one file for each template, below ``scan_id=<n>/`` in one folder.

Every task writes the files of its own rows, so nothing is shuffled. A file is written beside its
place and moved there when it is whole: readers see whole files only, and a task that is done again
puts the same file in the same place. Paths are unique within a scan, parts of a path are separated
by slashes, and a path that leaves its scan's folder is refused. Rows without scan_id or path are
left out, a null content is an empty file. Spark's readers pass over files of no bytes, so an empty
template is not read back.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposure.sources.readers import read_corpus


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address and the path in it."""
    scheme, colon, rest = folder.partition(":")
    if not colon or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (rest if colon else folder).lstrip("/")
    return pafs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else folder)


def _inside(path: str) -> str:
    parts = [p for p in path.split("/") if p]
    if not parts or any(p in (".", "..") for p in parts):
        raise ValueError(f"not a path inside a folder: {path!r}")
    return "/".join(parts)


def write_corpus(files: DataFrame, folder: str) -> int:
    """Write files (scan_id, path, content) and say how many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(folder)
        made, written = set(), 0
        for batch in batches:
            for scan, path, content in zip(*(batch[c] for c in ("scan_id", "path", "content"))):
                at = f"{top}/scan_id={scan.as_py()}/{_inside(path.as_py())}"
                if posixpath.dirname(at) not in made:
                    made.add(posixpath.dirname(at))
                    store.create_dir(posixpath.dirname(at))
                part = f"{at}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    out.write(content.as_py())
                store.move(part, at)
                written += 1
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["files"])

    given = files.where("scan_id is not null and path is not null").select(
        F.col("scan_id").cast("long").alias("scan_id"), F.col("path").cast("string").alias("path"),
        F.coalesce(F.col("content").cast("binary"), F.lit(b"")).alias("content"))
    return given.mapInArrow(run, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def read_corpus_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(scan_id, path, length, content) of the template files that ``write_corpus`` wrote."""
    below = r"/scan_id=(-?\d+)/(.*)$"
    return read_corpus(spark, folder).select(
        F.regexp_extract("path", below, 1).cast("long").alias("scan_id"),
        F.regexp_extract("path", below, 2).alias("path"), "length", "content")
