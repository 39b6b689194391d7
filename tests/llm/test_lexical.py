import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from newsgraph.llm import lexical
from tests.llm import brute

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate(brute.LOW))


def expected(docs, items, top=10):
    tf = [(i, Counter(terms_of(t))) for i, t, *_ in docs]
    tf = [(i, c) for i, c in tf if c]
    n, total = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in tf:
            m = 25 + 75 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms_of(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def benchmark(rows, seed=3):
    rng = random.Random(seed)
    items = [(i, " ".join(terms_of(rng.choice(rows)[1])[:rng.randrange(1, 40)])) for i in range(25)]
    return items + [(100, None), (101, ""), (102, "..."), (103, "word"), (104, "the the THE of zzzz"), (105, "unknown terms only"),
                    (0, items[0][1]), (7, "another text of item seven"), (None, "one two three four"), (106, "é ß 中文 x1 " * 5)]


def frame(spark, items, extra=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(items, "item_id long, text string")
    if extra:
        for c in ("item", "terms", "k", "doc_id", "rank"):
            df = df.withColumn(c, F.lit("y"))
    return df.repartition(2)


@pytest.mark.parametrize("small", [False, True])
def test_ranking_matches_brute_force(spark, monkeypatch, small):
    rng = random.Random(9)
    rows = brute.messy_documents() + [(2000 + i, brute.sentence(rng, rng.randrange(3, 60)), "en", "a", 0) for i in range(400)]
    rows += [(3000 + i, "hot copies of one text with the ing over", "en", "hot", 0) for i in range(150)]
    items = benchmark(rows)
    if small:  # many shards, short blocks, and several blocks of items
        monkeypatch.setattr(lexical, "CELLS", 3000)
        monkeypatch.setattr(lexical, "BLOCK", 2)
        monkeypatch.setattr(lexical, "CLUSTER", 4)
        monkeypatch.setattr(lexical, "SEED_SHARDS", 2)
        monkeypatch.setattr(lexical, "GROUP_TERMS", 60)
        rows, items = rows[:300] + rows[-30:], items[::3]
    got = lexical.op11(brute.frame(spark, rows, extra=not small), frame(spark, items, extra=not small)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows, items)


def random_shard(seed, docs=300, width=60):
    rng = np.random.default_rng(seed)
    w = lexical.Weights(5000, 400_000, rng.integers(1, 9000, width))
    topic = rng.integers(0, 6, docs)
    cols = [np.unique(np.append(rng.integers(0, 10, 4), 10 + topic[d] * 8 + rng.integers(0, 8, rng.integers(1, 6)))) for d in range(docs)]
    edge = np.append(0, np.cumsum([len(c) for c in cols]))
    tf = rng.integers(1, 6, edge[-1])
    items = [np.unique(rng.integers(0, width, rng.integers(1, 12))) for _ in range(40)]
    items = lexical.Items([str(i) for i in range(width)], items, [rng.integers(1, 4, len(t)) for t in items])
    row = lexical.build_shard(1, pa.array(np.arange(docs)), rng.integers(20, 300, docs), np.concatenate(cols), tf, edge, w, items.together())
    return lexical.Shard(row.to_pylist()[0], w), items


def test_bounds_hold_for_every_document_of_a_block(monkeypatch):
    monkeypatch.setattr(lexical, "LONG", 8)
    for seed in range(3):
        shard, items = random_shard(seed)
        for cols, times in zip(items.terms, items.times):
            spread = np.zeros(len(shard.largest), np.int64)
            spread[cols] = times
            score = times @ shard.x[cols]
            held = np.zeros(shard.size, bool)
            for bound, docs in shard.candidates(cols, cols, times, spread):
                assert (score[docs] <= bound).all()
                held[docs] = True
            assert (held == (score > 0)).all()  # every document stands in a block of some list


def test_blocks_are_skipped_and_nothing_is_lost():
    for seed in range(3):
        shard, items = random_shard(seed, docs=2000)
        for cols, times in zip(items.terms, items.times):
            score = times @ shard.x[cols]
            best = np.sort(score[score > 0])[::-1][:10]
            for least in (0, int(best[-1]) if len(best) else 1):
                got = shard.search(cols, times, least, 10)
                assert [s for s, _ in got] == best.tolist()
                assert all(score[d] == s for s, d in got)


def test_empty_tables(spark):
    docs = brute.frame(spark, brute.messy_documents())
    assert lexical.op11(docs, frame(spark, [])).collect() == []
    assert lexical.op11(brute.frame(spark, []).coalesce(1), frame(spark, [(1, "a b")])).collect() == []
    assert lexical.op11(brute.frame(spark, [(1, None, "a", "b", 0)]).coalesce(1), frame(spark, [(1, "a b")])).collect() == []
