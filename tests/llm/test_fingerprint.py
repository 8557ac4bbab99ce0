"""Fingerprints: sums of paragraphs, edits without the text, likeness, and the odd inputs."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from exposure.llm import fingerprint as fp

SCHEMA = "doc_id long, text string, task int, kind string, fingerprint long"


def test_order_does_not_matter_and_edits_add_up():
    lines = ["a b c d e", "", "x", "a b c d e", "ü × y"]
    whole = fp.fingerprint("\n".join(lines))
    shuffled = lines[:]
    random.Random(1).shuffle(shuffled)
    assert (fp.fingerprint("\n".join(shuffled)) == whole).all()
    less = fp.without_paragraphs(whole, ["a b c d e", ""])
    assert (less == fp.fingerprint("x\na b c d e\nü × y")).all()
    assert (fp.with_paragraphs(less, ["", "a b c d e"]) == whole).all()
    assert (fp.from_bytes(fp.to_bytes(whole)) == whole).all()
    for other in ("a b c d e", "a b c d  e\n\nx\na b c d e\nü × y", "\n".join(lines) + "\n"):
        assert (fp.fingerprint(other)[:fp.WORDS] != whole[:fp.WORDS]).any()


def test_likeness_follows_the_common_pieces():
    rng = random.Random(2)
    text = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    other = ["".join(rng.choices("ijklmnop", k=6)) for _ in range(4000)]
    for share in (0.0, 0.25, 0.5, 0.75, 0.9):
        cut = int(share * 4000)
        found = fp.likeness(fp.fingerprint(" ".join(text)),
                            fp.fingerprint(" ".join(text[:cut]) + "\n" + " ".join(other[cut:])))
        assert abs(found - share) < 0.3
    empty = fp.fingerprint("")
    assert fp.likeness(empty, empty) == 1.0 and fp.likeness(empty, fp.fingerprint("a")) == 0.0
    assert fp.likeness(empty, fp.fingerprint("\n")) == 0.0


def test_paragraphs_in_parts(monkeypatch):
    text = "\n".join(" ".join(f"w{i * j % 97}" for j in range(i % 50)) for i in range(200))
    whole = fp.fingerprint(text)
    for at_once in (1, 7, 100):
        monkeypatch.setattr(fp, "PIECES_AT_ONCE", at_once)
        assert (fp.fingerprint(text) == whole).all()
    # one piece: the words' hashes in order, by hand
    piece, counts = fp._pieces(["a", "a b", "a b c", "a b c d", ""])
    assert counts.tolist() == [1, 1, 1, 2, 0] and piece[2] == piece[3] and len(set(piece)) == 4


def expected_rows(rows):
    docs = sorted(((i, t or "") for i, t in rows if i is not None), reverse=True)
    out = []
    for (i, text), (_, behind) in zip(docs, docs[1:] + docs[:1]):
        put = len(text) // 2
        edited = text[:len(text) - put] + behind[:put]
        a, b, c = map(fp.fingerprint, (text, edited, behind))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.to_bytes(a).hex(),
                    fp.to_bytes(b).hex(), fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], SCHEMA)
    return sorted(map(tuple, fp.edited_fingerprints(df.repartition(5)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next").collect()))


def test_edited_texts(spark):
    rows = [(i * 7 % 101, f"line {i}\n\nmore of {i % 5} 😀\n" * (i % 4)) for i in range(100)]
    rows += [(200, None), (201, ""), (202, "x"), (203, "é\n"), (204, "wörd " * 40_000),
             (205, "a\n" * 50_000), (206, "\n"), (None, "left out"), (-5, "last\nof all")]
    assert found(spark, rows) == expected_rows(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, "ab\ncd\nef")]) == expected_rows([(1, "ab\ncd\nef")])


def test_repeated_ids_are_documents_of_their_own(spark):
    rows = [(1, "same\ntext")] * 40 + [(2, "other"), (1, "third")]
    got = found(spark, rows)
    assert len(got) == 42
    assert {r[3] for r in got if r[0] == 1} == {
        fp.to_bytes(fp.fingerprint(t)).hex() for t in ("same\ntext", "third")}
    assert sum(r[6] == 1.0 for r in got) >= 38


def test_edits_of_tables(spark):
    docs = [(i, "\n".join(f"p{i} {j}" for j in range(i % 6))) for i in range(50)]
    edits = [(i, f"p{i} 1", True) for i in range(50) if i % 6 > 1]
    edits += [(7, f"new {j}", False) for j in range(300)] + [(7, None, None), (None, "x", False)]
    edits += [(999, "first", False)]
    current = fp.fingerprints(spark.createDataFrame(docs, "doc_id long, text string"))
    after = fp.apply_edits(current, spark.createDataFrame(
        edits, "doc_id long, paragraph string, deleted boolean").repartition(6))
    texts = {i: t.split("\n") for i, t in docs}
    for i, paragraph, deleted in edits:
        if i is not None and deleted:
            texts[i].remove(paragraph)
        elif i is not None:
            texts.setdefault(i, []).append(paragraph or "")
    assert {r.doc_id: bytes(r.fingerprint) for r in after.collect()} == {
        i: fp.to_bytes(fp.total(fp.paragraph_vectors(t)) if t else np.zeros(
            fp.WORDS + fp.SIGNS, np.uint64)) for i, t in texts.items()}
    again = fp.apply_edits(after, spark.createDataFrame(
        [], "doc_id long, paragraph string, deleted boolean"))
    assert again.count() == 51 and again.where(F.length("fingerprint") != 288).count() == 0
