"""Plain single-process versions of the operators, and messy inputs."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SIZE = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def shingles(text, n=5):
    w = words(text)
    if not w:
        return Counter()
    if len(w) < n:
        return Counter([tuple(w)])
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def probability_jaccard(v, w):
    total = 0.0
    for d in set(v) & set(w):
        total += 1 / sum(max(v.get(e, 0) / v[d], w.get(e, 0) / w[d]) for e in set(v) | set(w))
    return total


def roots(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def sentence(rng, n):
    vocab = ["the", "of", "Ándor", "ing", "tion", "re", "over", "und", "qué", "x1"]
    return " ".join(rng.choice(vocab) + rng.choice(["", "", "a", "Be", "ly", "é"]) for _ in range(n))


def messy_documents(seed=5, n=60):
    """Rows (doc_id, text, lang, source, n_chars) with nulls, empty and very
    long texts, ties, copies, near copies and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append([i, sentence(rng, rng.randint(1, 120)), "en", rng.choice(["b", "a", "ß", None]), 1])
    base = sentence(rng, 200)
    for i in range(n, n + 12):
        w = base.split()
        w[rng.randrange(len(w))] = f"edit{i}"
        rows.append([i, " ".join(w), "en", "hot", 1])
    for i in range(n + 12, n + 40):
        rows.append([i, base, "en", "hot", 1])
    k = n + 40
    rows += [[k, None, None, None, None], [k + 1, "", "en", "a", 0], [k + 2, " .,;\n", "en", "a", 0],
             [k + 3, "one", "en", "a", 0], [k + 4, "One!", "en", "a", 0], [k + 5, "one two three four", "en", "a", 0],
             [k + 6, (base + "\n") * 40, "en", "long", 0], [k + 7, "ß中文 " * 3, "zh", "b", 0],
             [k + 8, "word " * 4000, "en", "long", 0], [3, rows[3][1], "en", rows[3][3], 1], [3, rows[3][1], "en", rows[3][3], 1],
             [None, "no id here but some words to read", "en", "a", 0], [None, None, None, None, None]]
    return [tuple(r) for r in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["id", "key", "size", "block", "score", "target", "taken", "band", "item", "ord", "text_key", "row_key", "h"]


def frame(spark, rows, extra=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for i, c in enumerate(CLASHING):
            df = df.withColumn(c, F.lit(f"x{i}"))
    return df.repartition(3)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
