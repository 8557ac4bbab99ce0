"""Ids that stand for several texts or vectors, foreign archives, bounded samples."""

import base64
import hashlib
import io

import numpy as np
from pyspark.sql import functions as F

from exposure.llm import exact_dedup, frames, packing, queries, simhash, vectors, warc

DOCS = "doc_id long, text string, text_sha256 string, digest int, _turn int"


def texts(spark, rows):
    return spark.createDataFrame([(*r, "n", 1, 2) for r in rows], DOCS)


def kept(df):
    assert df.columns == ["doc_id", "text", "text_sha256", "digest", "_turn"]
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_one_doc_id_for_two_texts(spark):
    rows = [(1, "alpha beta gamma"), (1, "wholly other words here"), (2, "alpha beta gamma"),
            (3, "alpha  beta gamma"), (3, "alphabetagamma"), (3, "alpha  beta gamma"), (4, None)]
    assert kept(exact_dedup.exact_dedup(texts(spark, rows))) == [
        (1, "wholly other words here"), (3, "alpha  beta gamma"), (4, None)]
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(1, words), (1, "another text that shares nothing at all"), (2, words), (2, "third one"),
            (5, "third one"), (6, None), (7, "")]
    assert kept(simhash.near_dedup(texts(spark, rows))) == sorted([
        (1, words), (1, rows[1][1]), (2, "third one"), (6, None)], key=str)
    groups = simhash.near_groups(texts(spark, rows)).collect()
    assert len({r["fingerprint"] for r in groups if r["component_id"] == 1}) == 2


VECTORS = "vec_id long, embedding array<float>, label string, id long, key int, root int"


def linked(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS)
    return sorted((r["vec_id"], r["n_links"], r["component_id"])
                  for r in vectors.near_vectors(df).collect())


def test_labels_and_ids_of_vectors(spark):
    assert linked(spark, [(1, [1.0], "2.0,x"), (2, [1.0, 2.0], "x"), (3, [1.0], "2.0")]) == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert linked(spark, [(10, [1.0, 0.0], "a"), (10, [0.0, 1.0], "a"), (11, [1.0, 0.01], "a"),
                          (9, [0.0, 2.0], "b")]) == [(9, 0, 9), (10, 0, 10), (10, 1, 10), (11, 1, 10)]


def test_vectors_with_links_equal_brute_force(spark, sf_dir):
    rng = np.random.default_rng(1)
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").limit(300).collect()
    rows = [(r["vec_id"], r["embedding"], str(r["label"])) for r in given]
    for i, (vec_id, v, label) in enumerate(rows[:150]):
        v = np.array(v, float)
        noise = rng.standard_normal(len(v)) * np.linalg.norm(v) / np.sqrt(len(v))
        rows.append((10_000 + i, (v + noise * rng.choice([0.1, 0.19, 0.2, 0.21, 0.3])).tolist(), label))
    x = np.array([np.array(v, np.float32) for _, v, _ in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    names = np.array([label for *_, label in rows])
    near = (x @ x.T >= 0.98) & (names[:, None] == names)
    np.fill_diagonal(near, False)
    assert near.any()
    reach = near | np.eye(len(rows), dtype=bool)
    for _ in range(8):
        reach = reach @ reach
    ids = np.array([i for i, *_ in rows])
    assert linked(spark, rows) == sorted(
        (int(ids[i]), int(near[i].sum()), int(ids[reach[i]].min())) for i in range(len(rows)))


def record(payload, digest, http_length):
    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % http_length + payload
    head = (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\n"
            + (b"WARC-Payload-Digest: " + digest.encode() + b"\r\n" if digest else b"")
            + b"Content-Length: %d\r\n\r\n" % len(http))
    return warc.gzip_member(head + http + b"\r\n\r\n")


def test_archives_of_other_writers():
    body = b"<html>" * 50
    sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    digests = [f"sha1:{sha1}", "sha1:" + hashlib.sha1(body).hexdigest().upper(),
               "md5:" + hashlib.md5(body).hexdigest(), "sha256:" + hashlib.sha256(body).hexdigest(),
               "blake9:whatever", ""]
    data = b"".join(record(body, d, len(body)) for d in digests)
    data += record(body, f"sha1:{sha1}", 7) + record(body, "sha1:" + "A" * 32, len(body))
    data += record(body, digests[0], len(body))
    rows = list(warc.salvage(io.BytesIO(data)))
    assert [r.get("gap") for r in rows] == [None] * 7 + ["damaged member", None]
    assert all(r["payload"] == body and r["payload_bytes"] == len(body)
               for r in rows if not r.get("gap"))


def test_archives_are_read_by_many_tasks(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").repartition(24)
    archives = warc.write_archives(pages, warc.new_folder(spark))
    read = warc.read_archives(archives).withColumn("task", F.spark_partition_id())
    assert read.select("task").distinct().count() >= 10
    files, path = warc._filesystem("file:/tmp/x")
    assert path == "/tmp/x" == warc._filesystem("/tmp/x")[1] == warc._filesystem("file:///tmp/x")[1]


def test_samples_take_little_from_each_task(spark):
    ids = spark.range(0, 60_000, 1, 500).withColumnRenamed("id", "doc_id")
    chosen = frames.smallest_hashes(ids, 1_000)
    assert 1_000 <= chosen.count() < 1_500
    assert chosen.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 30
    in_order = [F.xxhash64("doc_id"), "doc_id"]
    assert chosen.orderBy(*in_order).limit(1_000).collect() == ids.orderBy(*in_order).limit(
        1_000).collect()
    assert frames.smallest_hashes(ids.limit(5), 1_000).count() == 5
    assert frames.smallest_hashes(ids.limit(0), 1_000).count() == 0


def test_ids_are_kept_on_request_only(spark):
    docs = texts(spark, [(i, "some words " * (i * 37 % 900)) for i in range(60)])
    with_ids = packing.pack(docs, queries.WORD_VOCABULARY)
    plain = packing.pack(docs, queries.WORD_VOCABULARY, keep_ids=False)
    assert with_ids.where("ids is null or size(ids) <> length").isEmpty()
    assert plain.where("ids is not null").isEmpty()
    def whole(df):
        return sorted(map(tuple, df.groupBy("doc_id", "doc_tokens").agg(F.sum("length")).collect()))
    assert whole(with_ids) == whole(plain)
    assert all(total == tokens for _, tokens, total in whole(with_ids))
