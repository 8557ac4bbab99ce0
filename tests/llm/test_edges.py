"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import gzip
import io
import json
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from exposure.llm import (
    bpe, cells, chat, components, exact_dedup, frames, language, packing, quality, simhash,
    toxicity, vectors, warc,
)

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "norm string, cell long, id long, _way int, edge string, fp long, x string, key int"

LONG = "wörter " * 30_000
ROWS = [
    (1, "a b c", "en", "s", 5), (2, "abc", "en", "s", 3), (3, " a\tb\nc ", None, None, None),
    (4, None, None, "s", None), (5, "", "fr", None, 0), (6, LONG, "de", "s", 9),
    (6, LONG, "de", "s", 9), (7, LONG + "x", "de", "t", 9), (None, "abc", "en", "s", 3),
    (8, " \t ", "en", "s", 3), (9, "x" * 50_000, "en", "s", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "n", 1, 2, 3, "e", 4, "x", 5) for r in ROWS]
    return spark.createDataFrame(rows, f"{DOCS}, {CLASH}")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None), (6, 1, 0)],
        "doc_id long, quality int, toxic int")


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_exact_groups(docs, none):
    rows = found(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept")
    assert rows == sorted([
        (1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True), (4, 8, 3, False), (5, 8, 3, False),
        (8, 8, 3, True), (6, 6, 2, True), (6, 6, 2, False), (7, 7, 1, True), (9, 9, 1, True)])
    assert exact_dedup.exact_groups(none).collect() == []
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert found(kept, "doc_id") == [(3,), (6,), (7,), (8,), (9,)]


def test_exact_runs_over_many_partitions(spark):
    """One text in most rows: its run fills whole partitions of the sort."""
    texts = spark.range(4000).selectExpr(
        "id as doc_id", "if(id % 5 < 3, 'same  text', concat('t', id div 2)) as text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = exact_dedup.exact_groups(texts).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    hot = [r for r in rows if r.doc_id % 5 < 3]
    assert len(rows) == 4000 and {(r.keep_id, r.group_size) for r in hot} == {(0, 2400)}
    assert [r.doc_id for r in hot if r.kept] == [0]
    assert sum(r.kept for r in rows) == len({r.keep_id for r in rows})


def test_bpe(docs, none):
    rows = bpe.decode(bpe.encode(docs, BYTES), BYTES).collect()
    tokenizer = Tokenizer.from_file(BYTES)
    texts = {(i, t or "") for i, t, *_ in ROWS if i is not None}
    assert len(rows) == len(ROWS) - 1
    for i, text in texts:
        ids = [r.ids for r in rows if r.doc_id == i]
        assert all(x == tokenizer.encode(text, add_special_tokens=False).ids for x in ids)
        assert all(r.decoded == text for r in rows if r.doc_id == i)
    assert bpe.digests(bpe.decode(bpe.encode(none, BYTES), BYTES)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.sampled_from([
    "<|endoftext|>", "a<|endoftext|> b<|endoftext|", "it's we'LL", "\x1c a\x1f\x85  b　c ",
    "᠎​ x", "ﬁ Ǆ İ ς Σ", "é ́a", "é" * 300, "ab" * 400]))
def test_tokenizers_agree(text):
    ids, bounds = bpe.vocabulary(BYTES).encode([text, text])
    expected = Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids \
        if len(text) > 50 else _library(BYTES).encode(text, add_special_tokens=False).ids
    assert ids[:bounds[1]].tolist() == ids[bounds[1]:].tolist() == expected
    words = packing.word_tokenizer(WORDS)
    assert next(words.encode([text])).tolist() == _library(WORDS).encode(
        text, add_special_tokens=False).ids


_LIBRARY = {}


def _library(path):
    return _LIBRARY.setdefault(path, Tokenizer.from_file(path))


def test_long_words_merge_alike():
    words = bpe.vocabulary(BYTES)
    rng = np.random.default_rng(3)
    for n in (1, 2, 99, 100, 101, 700):
        word = bytes(rng.choice(list(b"abeinrst"), n))
        assert words._scan([word, b"a", word[:3]])[0].tolist() == words._heap(word)


def test_near_groups(docs, none):
    rows = found(simhash.near_groups(docs), "doc_id", "component_id", "fingerprint")
    by_id = {r[0]: r for r in rows}
    assert [r[1:] for r in rows if r[0] in (4, 5, 8)] == [(4, "0" * 16)] * 3
    assert [r[1] for r in rows if r[0] in (6, 7)] == [6, 6, 6]
    assert by_id[1][1] == by_id[3][1] == 1 and by_id[2][1] == 2
    assert simhash.near_groups(none).collect() == []
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert found(kept, "doc_id") == [(1,), (2,), (4,), (6,), (9,)]


def test_near_fingerprints_meet(spark):
    """Every pair within four bits is found, also in cells too large for one task."""
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 40, dtype=np.uint64)
    bits = [int(c) for c in centre]
    for c in centre:
        for n in range(40):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            bits.append(int(c) ^ sum(1 << int(b) for b in flips))
    bits = np.array(sorted(set(bits)), np.uint64)
    ids = np.arange(len(bits))
    nodes = spark.createDataFrame(
        [(int(i), int(b)) for i, b in zip(ids, bits.view(np.int64))], "id long, fp long")
    placed = nodes.mapInArrow(simhash._place, "cell long, id long, fp long")
    expected = {(int(i), int(j)) for i in ids
                for j in np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= 4) if j > i}
    for limit in (1024, 8):
        pairs = cells.pairs_in_cells(placed, ["fp"], simhash.within_bits(), limit=limit)
        assert {(min(p), max(p)) for p in pairs.collect()} == expected


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 500)]
    links = spark.createDataFrame([*chain, *star, *star, (5, 5), (9, 8)], "a long, b long")
    rows = dict(map(tuple, components.connected_components(links).collect()))
    assert rows == {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 500)}
    assert components.connected_components(links.where("a < 0")).collect() == []


def test_lookup_deals_a_hot_key(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 7, id) as k")
    facts = spark.range(4000).selectExpr("id as k", "id * 2 as twice")
    out = frames.lookup(rows, facts, "k", "id").collect()
    assert len(out) == 5000
    assert all(r.twice == (r.k * 2 if r.k < 4000 else None) for r in out)


def test_chat(spark):
    hard = "\\b \\l <turn x> </turn>\n\\ \\\\ \\n\\g <turn </turn"
    rows = [
        (1, 0, "system", hard), (1, 1, "user", None), (1, 2, "assistant", hard),
        (1, 3, "user", "q"), (1, 4, "assistant", "a"), (1, 5, "user", "last"),
        (2, 0, "user", "only"), (3, 0, "assistant", "only"), (3, 0, "assistant", "only"),
        (4, None, None, "x"), (4, 0, "odd>\n\\role", "y"), (None, 0, "user", "z"),
    ]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    given = given.selectExpr("*", "1 as parts", "2 as target", "3 as at")
    made = chat.examples(given)
    assert found(made.groupBy("conv_id").count(), "*") == [(1, 3), (2, 1), (3, 2), (4, 1)]
    turns = made.groupBy("conv_id").agg({"target_turn": "max"}).collect()
    assert {r[0]: r[1] for r in turns} == {1: 4, 2: None, 3: 1, 4: None}
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert {k: r.n_turns for k, r in back.items()} == {1: 6, 2: 1, 3: 2, 4: 2}
    assert back[1].loss_chars == len(hard) + 1 and back[3].loss_chars == 8
    whole = made.where("conv_id in (1, 4) and target_turn is null").withColumn(
        "turns", chat.read_turns(made.context)).collect()
    read = {r.conv_id: [tuple(t) for t in r.turns] for r in whole}
    assert read[1] == [(r[2], r[3] or "") for r in rows[:6]]
    assert read[4] == [("", "x"), ("odd>\n\\role", "y")]
    assert chat.read_back(chat.examples(given.where("conv_id > 9"))).collect() == []
    plan = chat.read_back(made)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rest_sizes():
    for rest, sizes in enumerate(packing.rest_sizes()):
        assert sum(sizes) == rest
        assert all(s < 32 or 2048 // (2048 // s) == s for s in sizes)


def test_packing(spark, docs, none):
    packed = packing.pack(docs, WORDS)
    rows = packed.collect()
    ids = {d: [] for d, *_ in ROWS if d is not None}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        if r.doc_id != 6:
            assert r.start == len(ids[r.doc_id])
            ids[r.doc_id] += r.ids
    for d, text, *_ in ROWS:
        if d is not None and d != 6:
            assert ids[d] == _library(WORDS).encode(text or "", add_special_tokens=False).ids + [1]
    assert sum(r.length for r in rows if r.doc_id == 6) == 2 * rows[0].asDict().get("x", 1) * next(
        r.doc_tokens for r in rows if r.doc_id == 6)
    assert packing.padding(packed).first().padded < 2048
    assert packing.pack(none, WORDS).collect() == []
    many = spark.range(3000).selectExpr(
        "id as doc_id", "repeat('word ', cast(id % 97 as int)) as text").repartition(130)
    packed = packing.pack(many, WORDS)
    stats = packing.padding(packed).first()
    assert stats.tokens == sum(i % 97 + 1 for i in range(3000))
    assert stats.padded <= 0.02 * stats.tokens + 2048
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").isEmpty()


def test_vectors(spark):
    near = [1.0, 0.0, 0.05]
    rows = [
        (1, [1.0, 0.0, 0.0], 1), (2, near, 1), (3, near, 1), (3, near, 1), (4, near, 2),
        (5, [2e200, 0.0, 0.0], 1), (6, [0.0, 0.0, 0.0], 1), (7, None, 1), (8, near, None),
        (9, [float("nan"), 0.0, 0.0], 1), (10, [1.0, None, 0.0], 1), (11, [1.0, 0.0], 1),
        (12, [], 1), (None, near, 1), (13, [float("inf"), 0.0, 1.0], 1), (14, [1e-200, 0.0, 0.0], 1),
    ]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = found(vectors.near_vectors(given.selectExpr("*", "1 as v", "2 as id", "3 as key")), "*")
    together = {1: 5, 2: 5, 3: 5, 5: 5, 14: 5}
    assert out == sorted(
        (v, together.get(v, 0), 1 if v in together else v, v not in together or v == 1)
        for v, *_ in rows if v is not None)
    assert vectors.near_vectors(given.where("vec_id > 99")).collect() == []


def test_blocks_miss_no_near_vector(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 20))
    x = np.concatenate([base + 0.07 * rng.standard_normal(base.shape) for _ in range(6)])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.98
    given = spark.createDataFrame(
        [(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    out = {r.vec_id: r.n_links for r in vectors.near_vectors(given).collect()}
    assert out == {i: int(n) - 1 for i, n in enumerate(near.sum(1))}
    assert near.sum() > len(x)


def test_quality(docs, none, labels):
    out = found(quality.quality_scores(docs, labels), "doc_id", "predicted", "score")
    assert len(out) == len(ROWS) - 1 and all(0 <= s <= 1 for *_, s in out)
    assert quality.quality_scores(none, labels).collect() == []
    constant = found(quality.quality_scores(docs, labels.where("quality = 1")), "score")
    assert len(set(constant)) == 1
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns


def test_trees_walk_as_they_were_fitted():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    trees = quality.fit(x[:2000], y[:2000], rounds=40)
    assert ((trees.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97

    def walk(row):
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            total += leaf[at - len(f)]
        return total
    assert np.allclose([walk(r) for r in x[:50]], trees.margin(x[:50]))


def test_toxicity(docs, none, labels):
    out = found(toxicity.toxicity_scores(docs, labels), "doc_id", "score", "predicted")
    assert len(out) == len(ROWS) - 1 and all(0 <= s <= 1 for _, s, _ in out)
    assert toxicity.toxicity_scores(none, labels).collect() == []
    assert {r[1] for r in found(
        toxicity.toxicity_scores(docs, labels.where("toxic = 0")), "doc_id", "predicted")} == {0}


def test_positive_unlabelled_risk():
    """Half the toxic rows stand unlabelled among the others, and still score high."""
    rng = np.random.default_rng(4)
    def rows(n, rate):
        return (rng.random((n, 6)) < rate).astype(float)
    toxic, clean = [0.5, 0.5, 0.5, 0.1, 0.1, 0.1], [0.01, 0.01, 0.01, 0.1, 0.1, 0.1]
    unlabelled = np.concatenate([rows(100, toxic), rows(900, clean)])
    weights, bias = toxicity.fit(rows(100, toxic), unlabelled, 0.1)
    score = toxicity.Model(list("abcdef"), weights, bias).score
    assert (score(rows(500, toxic)) > 0.5).mean() > 0.75
    assert (score(rows(500, clean)) > 0.5).mean() < 0.1


def test_toxicity_keeps_every_typical_word(spark):
    """600 insults of different words, each in thirty confirmed documents: all of them are known."""
    insults = ["".join(chr(97 + (i // 26**k + 7 * k) % 26) for k in range(3)) for i in range(600)]
    rows = [(i, " ".join(["plain", *(insults[x % 600] for x in (i, i * 7 + 1, i * 11 + 5))]), 1)
            for i in range(6000)]
    rows += [(6000 + i, f"plain text words{i % 50}", 0) for i in range(12000)]
    given = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(given.select("doc_id", "text"), given.select("doc_id", "toxic"))
    assert len(set(insults)) == 600 and set(insults) <= set(model.words)


def test_language(spark, docs, none):
    out = found(language.identify_documents(docs), "doc_id", "language", "accepted")
    assert len(out) == len(ROWS) - 1
    assert {r[0]: r[2] for r in out}[4] is False and {r[0]: r[2] for r in out}[5] is False
    assert language.identify_documents(none).collect() == []
    kept = language.accepted_documents(docs)
    assert kept.columns == docs.columns and kept.where("text is null").isEmpty()


def test_language_evidence(spark, sf_dir):
    model = language.learn_texts(language.known_texts(frames.table(spark, sf_dir, "documents")))
    german = frames.table(spark, sf_dir, "documents").where("lang = 'de'").first().text
    rows = [(i, german, "de-AT", "at", "at.example", "example") for i in range(40)]
    rows += [(100, "", "de", "at", "at.example", "example"), (101, None, None, None, None, None),
             (102, "", None, None, "at.example", "example"), (103, "", None, None, "new.example", "example"),
             (None, german, "de", "at", "h", "d")]
    given = spark.createDataFrame(
        rows, "id long, text string, declared string, suffix string, host string, domain string")
    out = {r.id: r for r in language.identify(given, model).collect()}
    assert len(out) == 44 and out[0].accepted and not out[100].accepted
    assert out[100].language == out[102].language == "de" and out[100].text_language is None
    assert out[101].probability < out[102].probability <= out[100].probability
    assert out[103].language == "de"


def test_every_language_is_learnt(spark):
    """150 languages with words of their own, some with a single text."""
    def text(i, k):
        rng = np.random.default_rng([i, k % 3])
        return " ".join("".join(map(chr, 0x4E00 + 40 * i + rng.integers(0, 40, 5))) for _ in range(60))

    rows = [(i * 10 + k, text(i, k), f"l{i:03}", "s") for i in range(150) for k in range(1 + 2 * (i < 40))]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language.learn_texts(language.known_texts(given))
    assert model.languages == [f"l{i:03}" for i in range(150)]
    out = {r.doc_id: r for r in language.identify_documents(given).collect()}
    assert all(out[i].language == out[i].text_language == name for i, _, name, _ in rows)
    assert language.learn_texts(language.known_texts(given), per_language=1).languages


def test_language_rejects_what_no_language_explains(spark):
    """Unlearnt scripts and random letters, also with a declaration; clean documents stay."""
    docs = frames.table(spark, "/root/testdata/sf0.01", "documents")
    rng = np.random.default_rng(3)
    junk = ["".join(map(chr, 97 + rng.integers(0, 26, n))) for n in rng.integers(3, 10, 200)]
    strange = [
        "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。" * 5,
        "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        " ".join(junk), " ".join(junk[:30]), "qzxvkj " * 300]
    given = docs.select("doc_id", "text", "lang", "source").union(spark.createDataFrame(
        [(-1 - i, t, "es", "web") for i, t in enumerate(strange)], "doc_id long, text string, lang string, source string"))
    out = {r.doc_id: r for r in language.identify_documents(given, docs).collect()}
    assert not any(out[-1 - i].accepted for i in range(len(strange)))
    for lang in ("en", "de", "fr", "es"):
        ids = [r.doc_id for r in docs.where("length(text) > 200").where(F.col("lang") == lang).collect()]
        assert np.mean([out[i].accepted and out[i].language == lang for i in ids]) > 0.99


@pytest.mark.parametrize("hidden", ["en", "de", "fr", "es"])
def test_language_rejects_an_unlearnt_language_of_the_same_script(spark, hidden):
    """Learnt from three languages, the fourth goes; Dutch, Italian and Portuguese as well. Unseen
    texts of the three stay, also when every eighth word is a name nobody has seen."""
    docs = frames.table(spark, "/root/testdata/sf0.01", "documents").where("length(text) > 200")
    aside = language.held_out("doc_id")
    model = language.learn_texts(language.known_texts(docs.where(~aside & (F.col("lang") != hidden))))
    assert hidden not in model.languages and len(model.languages) == 3
    rng = np.random.default_rng(5)
    sure = {name: [] for name in ("known", "named", "hidden")}
    for row in docs.where(aside).select("text", "lang").collect():
        if row.lang == hidden:
            sure["hidden"].append(model.likelihoods(row.text)[1])
            continue
        named = [w if i % 8 else "".join(map(chr, 97 + rng.integers(0, 26, 7)))
                 for i, w in enumerate(row.text.split())]
        sure["known"].append(model.likelihoods(row.text)[1])
        sure["named"].append(model.likelihoods(" ".join(named))[1])
    accepted = {k: np.mean(np.array(v) >= language.ACCEPT) for k, v in sure.items()}
    # Spanish and French share so many syllables that some of the one passes as the other.
    assert accepted["known"] > 0.99 and accepted["named"] > 0.97
    assert accepted["hidden"] < (0.35 if hidden == "es" else 0.1)
    for text in (
            "De regering heeft vandaag besloten dat de nieuwe wet over het onderwijs pas volgend jaar "
            "in werking zal treden, omdat de scholen meer tijd nodig hebben.",
            "Il governo ha deciso oggi che la nuova legge sulla scuola entrerà in vigore soltanto il "
            "prossimo anno, perché gli istituti hanno bisogno di più tempo.",
            "O governo decidiu hoje que a nova lei do ensino só entrará em vigor no próximo ano, "
            "porque as escolas precisam de mais tempo para se preparar."):
        assert model.likelihoods(text)[1] < language.ACCEPT


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 as digest", "2 as first_id", "3 as archive")


def test_warc(spark):
    same = "<p>é</p>" * 30
    rows = [
        (5, "http://a/ b\r\nX: y", same), (3, None, same), (9, "http://c/", same), (3, "http://d", same),
        (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", "x"),
        (7, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "x" * 200), (8, "u", "y" * 3_000_000),
    ]
    archives = warc.write_archives(pages_of(spark, rows), warc.new_folder(spark))
    records = warc.read_archives(archives)
    out = found(warc.page_records(records), "page_id", "payload_bytes", "record_type", "refers_to")
    n = len(same.encode())
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(out, key=key) == sorted([
        (3, n, "response", None), (3, n, "response", None), (5, n, "revisit", 3), (9, n, "revisit", 3),
        (1, 5, "response", None), (2, 5, "response", None), (4, 0, "response", None),
        (6, 0, "response", None), (7, len(rows[9][2]), "response", None), (8, 3_000_000, "response", None)], key=key)
    texts = {r.record_id: r.payload for r in records.where("record_type = 'response'").collect()}
    assert bytes(texts["<urn:page:7>"]).decode() == rows[9][2]
    assert records.where("gap is not null").isEmpty()
    empty = warc.write_archives(pages_of(spark, rows).where("page_id > 99"), warc.new_folder(spark))
    assert warc.read_archives(empty).collect() == []


def test_salvage():
    import hashlib

    def record(i, payload):
        return warc.make_record(i, "u", payload, hashlib.sha256(payload).hexdigest(), None)
    rng = np.random.default_rng(6)
    bodies = [bytes(rng.integers(0, 256, int(n), dtype=np.uint8)) for n in rng.integers(0, 90_000, 12)]
    for pack in (warc.gzip_member, bytes, lambda r: gzip.compress(r)):
        members = [pack(record(i, b)) for i, b in enumerate(bodies)]
        broken = list(members)
        broken[2] = broken[2][:60] + b"\x00" * 7 + broken[2][67:]
        broken[5] = broken[5][:len(broken[5]) // 2]
        broken[8] = b"junk \x1f\x8b\x08 WARC/1.0\r\n junk" + broken[8]
        data = b"".join(broken) + b"tail"
        rows = list(warc.salvage(io.BytesIO(data), "f"))
        good = [r for r in rows if "gap" not in r]
        assert [r["record_id"] for r in good] == [warc.record_uri(i) for i in range(12) if i not in (2, 5)]
        assert [r["payload"] for r in good] == [b for i, b in enumerate(bodies) if i not in (2, 5)]
        gaps = [(r["start"], r["stop"]) for r in rows if "gap" in r]
        places = np.cumsum([0, *map(len, broken)])
        assert gaps == [(places[2], places[3]), (places[5], places[6]),
                        (places[8], places[8] + len(broken[8]) - len(members[8])),
                        (places[12], len(data))]
        assert sorted(p for r in rows for p in (r["start"], r["stop"]))[0] == 0
    assert list(warc.salvage(io.BytesIO(b""))) == []
    assert [r["gap"] for r in warc.salvage(io.BytesIO(b"nothing"))] == ["no member or version line"]


def test_pipeline_stages(spark, docs, none, labels, tmp_path):
    for df, name in ((docs, "some"), (none, "none")):
        folder = tmp_path / name
        df.write.parquet(str(folder / "documents.parquet"))
        labels.write.parquet(str(folder / "labels.parquet"))
        given = spark.read.parquet(str(folder / "documents.parquet"))
        for stage, step in corpus_pipeline.STAGES:
            out = step(spark, given, str(folder))
            if stage != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == given.columns
            path = str(folder / stage)
            out.write.parquet(path)
            given = spark.read.parquet(path)
        assert json.dumps(sorted(given.columns))


def test_pipeline_keeps_what_its_stages_say(spark, sf_dir):
    """run() against the operators' own decisions, applied one after the other."""
    docs = frames.table(spark, sf_dir, "documents")
    rows = {r.doc_id: r for r in docs.collect()}

    def left(ids):
        return spark.createDataFrame([rows[i] for i in sorted(ids)], docs.schema)
    ids = {r.doc_id for r in language.identify_documents(docs).collect() if r.accepted}
    scored = quality.quality_scores(left(ids), frames.table(spark, sf_dir, "labels")).collect()
    ids = {r.doc_id for r in scored if r.predicted}
    best = {}
    for i in ids:
        key = "".join((rows[i].text or "").translate({ord(c): None for c in " \t\n\v\f\r"}))
        best[key] = min(best.get(key, (1, 0)), (-len(rows[i].text or ""), i))
    ids = {i for _, i in best.values()}
    ids = {r.doc_id for r in simhash.near_groups(left(ids)).collect() if r.doc_id == r.component_id}
    out = corpus_pipeline.run(spark, sf_dir)
    totals = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(
        {"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    words = _library(WORDS)
    assert totals == {
        i: len(words.encode(rows[i].text or "", add_special_tokens=False).ids) + 1 for i in ids}
    assert 0 < len(ids) < len(rows)


def test_waiting_pieces_do_not_hold_their_documents(monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(
        get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    waiting = []

    def pass_on(self):
        waiting.extend(piece[2] for pieces in self.open.values() for piece in pieces)

    monkeypatch.setattr(packing.Filler, "pass_on", pass_on)
    batch = pa.record_batch([pa.array([1, 2]), pa.array(["word " * 9_000, "a b"])], ["doc_id", "text"])
    list(packing._fill_documents(WORDS, 2048, 1, True)(iter([batch])))
    assert waiting and all(ids.base is None for ids in waiting)
