import random

import pytest

from newsgraph.llm import mixing
from tests.llm import brute


def goals(rows):
    size = {}
    for _, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len(brute.SIZE.findall(t or ""))
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(size.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * size[s]]
        if not over:
            out.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            out[s] = 2 * size[s]
            left -= out[s]
            open_.discard(s)
    return size, out


@pytest.mark.parametrize("extra", [False, True])
def test_mix_meets_targets(spark, extra):
    rows = brute.messy_documents()
    got = mixing.op1(brute.frame(spark, rows, extra)).collect()
    size, target = goals(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (i is None, i or 0, len(brute.SIZE.findall(t or ""))) for i, t, *_ in rows)
    taken = {}
    for r in got:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - target[s]) <= 1
    again = mixing.op1(brute.frame(spark, rows, extra).repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_levels_for_many_sources(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([1, 5, 300]), "en", f"s{i % 17}", 0) for i in range(200)]
    got = mixing.op1(brute.frame(spark, rows)).collect()
    _, target = goals(rows)
    assert all(r.target == pytest.approx(target[r.source]) for r in got)


def test_slots_of_a_source_are_spread_evenly(spark):
    plan = spark.createDataFrame([("a", 100_000, 150_000.0), ("b", 40_000, 50_000.0)],
                                 "source string, source_size long, target double")
    slots = sorted(mixing.schedule(plan, 100).collect())
    assert sum(r.words for r in slots) == 200_000
    firsts = [r.source for r in slots][:400]
    assert abs(firsts.count("a") - 300) <= 4


def test_empty_and_wordless_tables(spark):
    assert mixing.op1(brute.frame(spark, []).coalesce(1)).collect() == []
    got = mixing.op1(brute.frame(spark, [(1, None, "en", "a", 0), (2, " ", "en", None, 0)])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_stage(spark):
    rows = brute.messy_documents()
    docs = brute.frame(spark, rows, True)
    out = mixing.mix_documents(spark, docs, "").collect()
    taken = {r.doc_id: r.taken for r in mixing.op1(docs).collect() if r.taken}
    assert {r.doc_id for r in out} == set(taken)
