"""WARC archives: writing with revisits, and a reader that salvages damaged ones.

Writing: every page is a ``response`` record, but of pages with equal payloads (full SHA-256, at
least MIN_REVISIT bytes) only the smallest page_id is; the others are ``revisit`` records that refer
to it and keep the HTTP headers with the payload's length. A record is a gzip member of its own.
A task rolls its archive after ARCHIVE_BYTES and gives it its name when it is whole; the table of
archives says which ones count, so what a failed or repeated task left behind is never read.

Reading: an archive is read in windows. A record is taken when its member unpacks with a right
checksum (or its version line stands there, where it is not compressed), its header parses, its
length fits and its payload has the digest it names. After a failed check the reader looks for the
next gzip member or version line that passes, goes on there, and gives the bytes between as a
quarantined gap.

A null or empty html is an empty payload; rows without a page_id are left out; a repeated page_id
gives a record each time (all of them responses, where it is the smallest of its payload). A null url
gives no target. Payloads of any length are kept whole, a record to a member. An empty table gives no
archive and no record. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposure.llm.frames import lookup
from exposure.session import materialize, shared_dir

MIN_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
WINDOW = 1 << 18

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/\d\.\d\r\n")
NOT_TEXT = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f]|\r(?!\n)|(?<!\r)\n")
MEMBER = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"

ARCHIVES = "archive string, records long, bytes long"
RECORDS = (
    "archive string, start long, stop long, gap string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)
_RECORDS = pa.schema([
    ("archive", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("gap", pa.string()),
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
    ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
    ("payload", pa.binary()),
])


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>"


def make_record(page_id: int, url: str | None, payload: bytes, digest: str,
                refers_to: int | None) -> bytes:
    """An uncompressed record."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_uri(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_uri(refers_to))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + head + b"\r\n" + block + END


def gzip_member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


# --- writing -----------------------------------------------------------------------------------

def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, digest and refers_to (null for a response)."""
    given = pages.where("page_id is not null").select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"),
    ).withColumn("digest", F.sha2("html", 256))
    large = F.length("html") >= min_bytes
    groups = (
        given.where(large).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1").select("digest", "first_id"))
    return lookup(given, groups, "digest", "page_id").select(
        "page_id", "url", "html", "digest",
        F.when(F.col("page_id") != F.col("first_id"), F.col("first_id")).alias("refers_to"))


#: Hadoop names of a store that is known by another name here.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a Hadoop address."""
    scheme, named, rest = uri.partition(":")
    if not named or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if named else uri).lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        out, name, records, size = None, None, 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            files.move(f"{base}/{name}.part", f"{base}/{name}")
            return pa.RecordBatch.from_pydict(
                {"archive": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

        for batch in batches:
            columns = [batch[c] for c in ("page_id", "url", "html", "digest", "refers_to")]
            for i in range(batch.num_rows):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{base}/{name}.part", compression=None)
                member = gzip_member(make_record(*(c[i].as_py() for c in columns)))
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` as archives under ``folder`` (reachable from every executor); the archives."""
    return materialize(with_revisits(pages).mapInArrow(_write(folder), ARCHIVES), "archives")


# --- reading -----------------------------------------------------------------------------------

class Source:
    """A file as a window of bytes that can grow and move on."""

    def __init__(self, file) -> None:
        self.file, self.base, self.data, self.ended = file, 0, b"", False

    def more(self, n: int = WINDOW) -> bool:
        got = self.file.read(n)
        self.data += got
        self.ended = not got
        return bool(got)

    def drop(self, n: int) -> None:
        self.base, self.data = self.base + n, self.data[n:]

    def find(self, at: int) -> int:
        """The next place from ``at`` where a member or version line may start; -1: none."""
        while True:
            member, line = self.data.find(MEMBER, at), VERSION_LINE.search(self.data, at)
            found = [x for x in (member, line.start() if line else -1) if x >= 0]
            if found:
                return min(found)
            keep = max(at, len(self.data) - len(VERSION))
            if not self.more():
                return -1
            at = keep


def digest_holds(digest: str, payload: bytes) -> bool:
    """Whether ``algorithm:value`` (hexadecimal or base 32) fits; unknown algorithms are not checked.

    A value without an algorithm is one of SHA-256.
    """
    algorithm, named, value = digest.partition(":")
    if not named:
        algorithm, value = "sha256", digest
    algorithm = algorithm.strip().lower().replace("-", "")
    if not value or algorithm not in ("sha1", "sha256", "sha512", "md5"):
        return True
    found = hashlib.new(algorithm, payload, usedforsecurity=False)
    in_base32 = base64.b32encode(found.digest()).decode().rstrip("=")
    return value.strip().lower() == found.hexdigest() or value.strip().rstrip("=").upper() == in_base32


def parse(record: bytes) -> dict | None:
    """The fields of a whole uncompressed record; None where a check fails."""
    head_end = record.find(END)
    if head_end < 0 or not VERSION_LINE.match(record) or NOT_TEXT.search(record, 0, head_end):
        return None
    fields = {}
    for line in record[:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    block = record[head_end + 4:]
    if not fields.get("content-length", "").isdigit():
        return None
    length = int(fields["content-length"])
    if len(block) < length or block[length:].strip(b"\r\n"):
        return None
    http, _, payload = block[:length].partition(END)
    size = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http + b"\r\n")
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "")
    if kind == "response" and not digest_holds(digest, payload):
        return None
    # The record's length decides; the one a server named counts where there is no payload.
    size = int(size[1]) if size and kind != "response" else len(payload)
    digest = digest.removeprefix("sha256:")
    return {
        "record_type": kind, "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
        "payload_digest": digest, "payload_bytes": size,
        "payload": payload if kind == "response" else None,
    }


def _packed(source: Source) -> tuple[dict, int] | None:
    unpacker, at, parts = zlib.decompressobj(31), 0, []
    try:
        while not unpacker.eof:
            if at >= len(source.data) and not source.more():
                return None
            chunk = source.data[at:at + WINDOW]
            parts.append(unpacker.decompress(chunk))
            at += len(chunk)
            if len(parts) == 1 and not VERSION_LINE.match(parts[0][:10].ljust(10)) and len(parts[0]) >= 10:
                return None
    except zlib.error:
        return None
    record = parse(b"".join(parts))
    return record and (record, at - len(unpacker.unused_data))


def _plain(source: Source) -> tuple[dict, int] | None:
    while (head_end := source.data.find(END)) < 0:
        if len(source.data) > WINDOW or not source.more():
            return None
    length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)\r\n", source.data[:head_end + 2])
    if not length:
        return None
    stop = head_end + 4 + int(length[1]) + len(END)
    while len(source.data) < stop and source.more():
        pass
    record = parse(source.data[:stop])
    return record and (record, min(stop, len(source.data)))


def salvage(file, archive: str = "") -> Iterator[dict]:
    """Records and quarantined gaps (``gap`` says why) of an open binary file, in order."""
    source = Source(file)
    gap_at, why = None, "no member or version line"
    while True:
        at = source.find(0)
        if at:
            gap_at = source.base if gap_at is None else gap_at
            source.drop(at if at > 0 else len(source.data))
        if at < 0:
            break
        packed = source.data.startswith(MEMBER)
        found = (_packed if packed else _plain)(source)
        if found is None:
            if gap_at is None:
                gap_at, why = source.base, "damaged member" if packed else "damaged record"
            source.drop(1)
            continue
        if gap_at is not None:
            yield {"archive": archive, "start": gap_at, "stop": source.base, "gap": why}
            gap_at, why = None, "no member or version line"
        record, used = found
        yield {"archive": archive, "start": source.base, "stop": source.base + used, **record}
        source.drop(used)
    if gap_at is not None and source.base > gap_at:
        yield {"archive": archive, "start": gap_at, "stop": source.base, "gap": why}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch["archive"].to_pylist():
            files, path = _filesystem(archive)
            rows, held = [], 0
            with files.open_input_stream(path, compression=None) as file:
                for row in salvage(file, archive):
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if held > WINDOW * 4 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)


def read_archives(archives: DataFrame) -> DataFrame:
    """Records and gaps of the files in ``archives`` (column archive), dealt over as many tasks.

    The number is given: names are short, and adaptive execution would put them all into one task.
    """
    names = archives.select("archive")
    return names.repartition(max(1, names.count()), "archive").mapInArrow(_read, RECORDS)


def new_folder(spark: SparkSession) -> str:
    return shared_dir(spark, "warc")


def page_records(records: DataFrame) -> DataFrame:
    """What the archives say about each page."""
    def page(column: str):
        return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).cast("long")

    return records.where("gap is null").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"))
