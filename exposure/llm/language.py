"""Language identification by Bayesian fusion of evidence.

A text's likelihood under each language comes from letter trigrams (hashed, smoothed, learnt on a
bounded sample of texts with a known language) and is tempered, because neighbouring trigrams
repeat each other. It is multiplied with what else is known of the row: the language its markup
declares, the suffix of its address, and a prior of its host. How far a declaration or suffix can
be trusted, and each host's prior, are counted over all rows from the texts' own languages; a host's
counts are smoothed towards those of its domain, and these towards all rows, so a host with few rows
says little.

Texts in none of the languages have a hypothesis of their own, with the prior UNKNOWN: the most
likely of trigrams spread evenly, of letters by themselves, and of trigrams put together from pairs
of letters, all languages pooled. A text whose letters and pairs are familiar, but not the ways in
which one language joins them, is in another language of the same script. The hypothesis stands
against the language that explains the text best, and by the text alone, so neither a declaration
nor a host can make up for text that no language explains.

A row is accepted when its text has LEAST_LETTERS letters and the best language's probability, times
the probability that the text is in one of the languages, reaches ACCEPT. Only texts that are surely
in one count towards the other evidence. Null and empty texts have no likelihood: their language comes from the other
evidence, and they are not accepted. Missing evidence says nothing. Rows without an id are left out;
repeated rows each get a result. Without any text to learn from, every row is undetermined. Long texts
are read whole, an empty table gives an empty result, and other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposure.llm.frames import keep_documents, lookup, text_slices
from exposure.session import materialize

TRAIN_TEXTS = 1_500
BUCKETS = 1 << 15
PAIRS = 1 << 14
LETTERS = 1 << 12
EVEN_PAIRS = 0.02
EVEN_LETTERS = 0.01
SMOOTHING = 0.5
COUNTED_AT_ONCE = 64
TEMPER = 100.0
LEAST_LETTERS = 3
SURE = 0.9
HOST_WEIGHT = 20.0
ACCEPT = 0.5
UNKNOWN = 0.9
UNDETERMINED = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def grams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams, pairs and letters of a text, words apart by a blank; empty without letters."""
    letters = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not letters:
        return (np.zeros(0, np.int64),) * 3
    points = np.frombuffer(f" {letters} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    two = points[:-1] * np.uint64(961_748_941) + points[1:] * np.uint64(29_986_577)
    three = two[:-1] + points[2:] * np.uint64(15_485_863)
    return (
        ((three ^ (three >> np.uint64(17))) % np.uint64(BUCKETS)).astype(np.int64),
        ((two ^ (two >> np.uint64(15))) % np.uint64(PAIRS)).astype(np.int64),
        (points % np.uint64(LETTERS)).astype(np.int64))


@dataclass
class TextModel:
    """Log shares of the trigrams of each language, and of pairs and letters of all."""
    languages: list[str]
    log_share: np.ndarray
    log_pairs: np.ndarray
    log_letters: np.ndarray

    def likelihoods(self, text: str) -> tuple[np.ndarray, float]:
        """Tempered log-likelihoods, the best at 0, and the probability that the text is in one of
        the languages (1 without letters)."""
        three, two, one = grams(text)
        if not len(three) or not self.languages:
            return np.zeros(len(self.languages)), 1.0
        # Each bucket once, so that a long text is not looked up again for every language.
        times = np.bincount(three, minlength=BUCKETS)
        at = np.flatnonzero(times)
        mean = np.einsum("lb,b->l", self.log_share[:, at], times[at] / len(three))
        weight = len(three) / (1 + len(three) / TEMPER)
        weighed = mean * weight
        letter, pair = self.log_letters[one], self.log_pairs[two]
        rival = max(
            -np.log(BUCKETS), (letter[:-2] + letter[1:-1] + letter[2:]).mean(),
            (pair[:-1] + pair[1:] - letter[1:-1]).mean())
        odds = np.log((1 - UNKNOWN) / UNKNOWN) + weighed.max() - rival * weight
        return weighed - weighed.max(), float(1 / (1 + np.exp(-np.clip(odds, -40, 40))))


def _pooled(counts: np.ndarray, even: float) -> np.ndarray:
    """Log shares over all languages, each counting alike, mixed with a part spread evenly."""
    shares = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    return np.log((1 - even) * shares.mean(0) + even / counts.shape[1])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for at, held in counts.items():
            buckets = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(buckets), at, np.int32)),
                 pa.array(buckets.astype(np.int32)), pa.array(held[buckets])], ["at", "bucket", "n"])
        counts.clear()

    for batch in batches:
        for at, text in zip(batch["at"].to_pylist(), batch["text"].to_pylist()):
            if at not in counts:
                if len(counts) >= COUNTED_AT_ONCE:
                    yield from flush()
                counts[at] = np.zeros(BUCKETS + PAIRS + LETTERS, np.int64)
            three, two, one = grams(text)
            counts[at] += np.bincount(
                np.concatenate([three, BUCKETS + two, BUCKETS + PAIRS + one]),
                minlength=BUCKETS + PAIRS + LETTERS)
    yield from flush()


def learn_texts(known: DataFrame, per_language: int = TRAIN_TEXTS) -> TextModel:
    """Shares of each language's trigrams, pairs and letters; ``known`` has id, text and language.

    Every language with letters in its texts is learnt, of each about ``per_language`` texts: those
    whose hash is below the share that gives this many. The names and BUCKETS shares of each are held
    on the driver and by each worker.
    """
    given = known.where("text is not null and language is not null and id is not null")
    sizes = {r["language"]: r["count"] for r in given.groupBy("language").count().collect()}
    if not sizes:
        return TextModel([], *(np.zeros(n) for n in ((0, BUCKETS), PAIRS, LETTERS)))
    names = sorted(sizes)
    facts = F.create_map(*[x for i, k in enumerate(names) for x in (
        F.lit(k), F.struct(F.lit(i).alias("at"), F.lit(min(1.0, per_language / sizes[k])).alias("part")))])
    chosen = given.select("id", "text", facts[F.col("language")].alias("fact")).where(
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0 < F.col("fact.part"))
    found = chosen.select("fact.at", "text").mapInArrow(
        _count, "at int, bucket int, n long").groupBy("at", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    at = found["at"].to_numpy()
    learnt = np.unique(at)
    if not len(learnt):
        return TextModel([], *(np.zeros(n) for n in ((0, BUCKETS), PAIRS, LETTERS)))
    counts = np.zeros((len(learnt), BUCKETS + PAIRS + LETTERS))
    counts[np.searchsorted(learnt, at), found["bucket"].to_numpy()] = found["n"].to_numpy()
    three, two, one = np.split(counts, [BUCKETS, BUCKETS + PAIRS], axis=1)
    three = three + SMOOTHING
    return TextModel(
        [names[i] for i in learnt], np.log(three / three.sum(1, keepdims=True)),
        _pooled(two, EVEN_PAIRS), _pooled(one, EVEN_LETTERS))


def text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """id, declared, suffix, domain, host and, from the text, letters, log_text, known (the
    probability that it is in one of the languages) and best: the number of the language, where the
    text alone makes it sure."""
    given = ["id", "declared", "suffix", "domain", "host"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                texts = part["text"].to_pylist()
                letters = [sum(map(len, _NOT_LETTERS.split(t))) for t in texts]
                found, known = zip(*[model.likelihoods(t) for t in texts])
                best = [int(x.argmax()) if n >= LEAST_LETTERS and k * _normal(x).max() >= SURE else None
                        for x, k, n in zip(found, known, letters)]
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in given), pa.array(letters, pa.int64()),
                     pa.array(found, pa.list_(pa.float64())), pa.array(known, pa.float64()),
                     pa.array(best, pa.int32())],
                    [*given, "letters", "log_text", "known", "best"])
    return rows.mapInArrow(
        run, "id long, declared string, suffix string, domain string, host string, letters long, "
        "log_text array<double>, known double, best int")


# --- fusion ------------------------------------------------------------------------------------

def _normal(logs: np.ndarray) -> np.ndarray:
    """Probabilities from log weights."""
    powers = np.exp(logs - logs.max())
    return powers / powers.sum()


def _counts(seen: DataFrame, key: str, *more: str) -> DataFrame:
    """Rows of each language for each key, as pairs; of ``more`` the smallest values."""
    each = seen.where(F.col("best").isNotNull() & F.col(key).isNotNull()).groupBy(key, "best").agg(
        F.count("*").alias("rows"), *[F.min(c).alias(c) for c in more])
    return each.groupBy(key).agg(
        F.collect_list(F.struct("best", "rows")).alias(f"{key}_counts"),
        *[F.min(c).alias(c) for c in more])


@dataclass
class Fusion:
    """What the counts over all rows say, for the languages of a model."""
    languages: list[str]
    counted: np.ndarray
    accept: float

    def __post_init__(self) -> None:
        self.overall = (self.counted + 1) / (self.counted.sum() + len(self.counted))

    def dense(self, pairs: list[dict]) -> np.ndarray:
        out = np.zeros(len(self.languages))
        for pair in pairs:
            out[pair["best"]] = pair["rows"]
        return out

    def share(self, pairs: list[dict] | None, toward: np.ndarray) -> np.ndarray:
        """Shares of the languages, smoothed; without counts those they are smoothed towards."""
        if pairs is None:
            return toward
        n = self.dense(pairs)
        return (n + HOST_WEIGHT * toward) / (n.sum() + HOST_WEIGHT)

    def logs(self, row: dict) -> np.ndarray:
        domain = row["home_counts"] if row["host_counts"] is not None else row["domain_counts"]
        prior = self.share(row["host_counts"], self.share(domain, self.overall))
        logs = np.array(row["log_text"]) + np.log(prior)
        for pairs in (row["declared_counts"], row["suffix_counts"]):
            if pairs is not None:
                # P(evidence | language)
                logs += np.log((self.dense(pairs) + 0.5) / (self.counted + 50.0))
        return logs

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                p, letters = _normal(self.logs(row)), row["letters"]
                top = float(p.max()) * row["known"]
                by_text = int(np.argmax(row["log_text"]))
                out.append((
                    row["id"], self.languages[int(p.argmax())], top,
                    self.languages[by_text] if letters else None,
                    letters >= LEAST_LETTERS and top >= self.accept))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, (
                    pa.int64(), pa.string(), pa.float64(), pa.string(), pa.bool_()))],
                ["id", "language", "probability", "text_language", "accepted"])


def identify(rows: DataFrame, model: TextModel, accept: float = ACCEPT) -> DataFrame:
    """id, language, probability, text_language and accepted for every row with an id.

    ``rows`` has id, text, and any evidence: declared, suffix, host and domain (null: none).
    """
    short = {"declared": 3, "suffix": 3}
    evidence = [
        F.col(c).cast("string").alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
        for c in ("declared", "suffix", "domain", "host")]
    given = rows.where("id is not null").select(
        F.col("id").cast("long").alias("id"), *evidence,
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Declarations and suffixes count by two or three letters, so their tables have a fixed bound.
    for c, most in short.items():
        given = given.withColumn(c, F.regexp_extract(F.lower(c), rf"^\s*([a-z]{{2,{most}}})(?![a-z])", 1))
        given = given.withColumn(c, F.when(F.col(c) != "", F.col(c)))
    n = len(model.languages)
    if not n:
        return given.select(
            "id", F.lit(UNDETERMINED).alias("language"), F.lit(0.0).alias("probability"),
            F.lit(None).cast("string").alias("text_language"), F.lit(False).alias("accepted"))

    seen = materialize(text_evidence(given, model), "language-texts")
    counted = np.zeros(n)
    for r in seen.where("best is not null").groupBy("best").count().collect():
        counted[r["best"]] = r["count"]

    domains = _counts(seen, "domain")
    hosts = _counts(seen, "host", "domain")
    hosts = materialize(
        hosts.join(domains.withColumnRenamed("domain_counts", "home_counts"), "domain", "left")
        .select("host", "host_counts", "home_counts"), "language-hosts")
    out = lookup(seen, hosts, "host", "id")
    if "domain" in rows.columns:
        out = lookup(out, domains, "domain", "id")
    else:
        out = out.withColumn("domain_counts", F.lit(None).cast(domains.schema["domain_counts"].dataType))
    for c in short:
        # One row for each of at most 26^2 + 26^3 values.
        out = out.join(F.broadcast(_counts(seen, c)), c, "left")
    return out.select(
        "id", "letters", "log_text", "known", "host_counts", "home_counts", "domain_counts",
        "declared_counts", "suffix_counts",
    ).mapInArrow(
        Fusion(model.languages, counted, accept),
        "id long, language string, probability double, text_language string, accepted boolean",
    ).withColumn("probability", F.round("probability", 6))


# --- tables ------------------------------------------------------------------------------------

def held_out(column: str) -> Column:
    """Whether a row is kept out of learning: a quarter of all ids."""
    return F.crc32(F.col(column).cast("long").cast("string").cast("binary")) % 4 == 2


def known_texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("language"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents: the lang column is the declaration, the source the host."""
    return docs.select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"),
        F.col("source").alias("host"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages: the lang attribute, the address's host, its last two labels and its suffix."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    labels = F.split(host, r"\.")
    lang = F.regexp_extract("html", r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<[^>]*>|&#?\w+;", " ")
    return pages.select(
        F.col("page_id").alias("id"), text.alias("text"),
        F.when(lang != "", lang).alias("declared"),
        F.when(host != "", host).alias("host"),
        F.when(host != "", F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."))
        .alias("domain"),
        F.when(F.size(labels) > 1, F.element_at(labels, -1)).alias("suffix"))


def identify_documents(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    found = identify(document_rows(docs), learn_texts(known_texts(docs if known is None else known)))
    return found.withColumnRenamed("id", "doc_id")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language could be told, with all their columns."""
    return keep_documents(docs, identify_documents(docs).where("accepted"))
