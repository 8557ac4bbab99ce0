"""Spelling groups against brute force, words of any length, and the odd inputs."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from exposure.llm import spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_force(counts):
    out, forms = [], {}
    for word, n in counts.items():
        others = [w for w in counts if near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form = best if best and counts[best] >= 2 * n else None
        forms[word] = form
        out.append([word, form, None, n, len(others), form and counts[form]])
    for row in out:
        row[2] = row[0]
        while forms[row[2]]:
            row[2] = forms[row[2]]
    return sorted(map(tuple, out))


def result(df):
    return sorted(tuple(r) for r in df.select(
        "word", "form", "root", "n", "n_near", "form_n").collect())


def test_forms_equal_brute_force(spark):
    rng = random.Random(5)
    counts = {"".join(rng.choices("ab", k=rng.randint(4, 8))): rng.choice([3, 6, 7, 12, 24, 50])
              for _ in range(300)}
    counts |= {"".join(rng.choices("aé×", k=5)): rng.randint(3, 90) for _ in range(40)}
    assert result(spelling.spelling_forms(spark.createDataFrame(
        list(counts.items()), "word string, n long"))) == brute_force(counts)


def test_long_words_and_the_border_to_short_ones(spark):
    base = "".join(random.Random(6).choices("abcde", k=400))
    counts = {base: 50}
    for size in range(spelling.LONG_WORD - 3, spelling.LONG_WORD + 4):
        counts[base[:size]] = size
        counts[base[:size - 2] + "z" + base[size - 1:size]] = 3
    for at in (0, 1, 200, 398, 399):
        counts[base[:at] + "y" + base[at + 1:]] = 4
        counts[base[:at] + "x" + base[at:]] = 5
        counts[base[:at] + base[at + 1:]] = 6
    counts["q" * 3000], counts["q" * 3001], counts["q" * 2999] = 3, 6, 12
    assert result(spelling.spelling_forms(spark.createDataFrame(
        list(counts.items()), "word string, n long"))) == brute_force(counts)


def test_documents(spark):
    texts = [
        (1, "Colour colour COLOUR, ÉTÉsé étésé? color", "w", 1), (1, "color color x1color", "w", 1),
        (2, None, "w", 1), (3, "", "w", 1), (None, "colour " * 9, "w", 1),
        (4, "b" * 30_000 + " " + ("straße " * 20_000), "w", 1),
        *((i, f"colour Colors {'b' * 30_000} niño", "w", 1) for i in range(5, 300))]
    docs = spark.createDataFrame(texts, "doc_id long, text string, word string, n int")
    words = Counter()
    for doc_id, text, *_ in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or "") if doc_id is not None else []:
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            words[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    counts = {w: n for w, n in words.items() if n >= 3 and len(w) >= 5}
    assert result(spelling.spelling_groups(docs, 97)) == brute_force(counts)
    assert spelling.spelling_groups(docs.limit(0), 97).collect() == []


def test_one_group_has_one_place_for_each_letter(spark):
    """However many words there are, no group of the scan outgrows the alphabet."""
    words = spark.range(20_000).select(
        F.concat(F.lit("word"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))
        .alias("word"), F.lit(3).cast("long").alias("n"))
    sizes = spelling._short_rotations(words).groupBy("key").count().agg(F.max("count")).first()[0]
    assert sizes <= 11
