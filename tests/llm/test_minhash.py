import numpy as np
import pyarrow as pa
import pytest

from newsgraph.llm import common as C
from newsgraph.llm import lsh, minhash
from tests.llm import brute


def expected(rows):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    sets = {i: brute.shingles(t) for t, i in first.items()}
    ids = sorted(sets)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and brute.probability_jaccard(sets[a], sets[b]) >= 0.8]
    root = brute.roots(ids, edges)
    return sorted((i, root[first[t or ""]]) for i, t, *_ in rows if i is not None)


@pytest.mark.parametrize("extra", [False, True])
def test_classes_match_brute_force(spark, extra):
    rows = brute.messy_documents()
    got = minhash.op3(brute.frame(spark, rows, extra)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got if r.doc_id is not None) == expected(rows)
    assert [(r.class_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert all(r.kept == (r.doc_id == r.class_id) for r in got if r.doc_id is not None)


def test_bucket_members_that_the_leader_misses_are_linked(spark):
    """a, b and c share a bucket, only b and c are alike."""
    base = [f"w{i}" for i in range(100)]
    texts = {1: base[:50] + [f"z{i}" for i in range(50)], 2: base, 3: base[:-1] + ["other"]}
    bands = spark.createDataFrame([(i, 7) for i in texts], "id long, band long")

    w = pa.array([" ".join(t) for t in texts.values()])
    sets = C.shingle_sets(C.scan_words(w), 3)
    marked = pa.RecordBatch.from_arrays([pa.array(list(texts)), *lsh.marks(*sets, 3)], ["id", "bits", "weight"])
    marked = spark.createDataFrame(marked.to_pylist(), f"id long, {lsh.MARKS}")

    def make_sets(ids):
        return spark.createDataFrame(lsh.pack_sets(pa.array(list(texts)), *sets).to_pandas(), lsh.SETS)

    got = lsh.classes(bands, marked, make_sets, 0.8, "t").collect()
    assert sorted((r.node, r.root) for r in got) == [(2, 2), (3, 2)]


def test_empty_table(spark):
    assert minhash.op3(brute.frame(spark, []).coalesce(1)).collect() == []


def test_stage_keeps_one_of_each_class_and_all_columns(spark):
    rows = brute.messy_documents()
    docs = brute.frame(spark, rows, True)
    out = minhash.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    kept = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert kept == sorted({i for i, c in expected(rows) if i == c})


def test_probability_jaccard_matches_definition():
    rng = np.random.default_rng(1)
    for _ in range(50):
        v = {int(k): int(c) for k, c in zip(rng.choice(40, 15, False), rng.integers(1, 5, 15))}
        w = {int(k): int(c) for k, c in zip(rng.choice(40, 20, False), rng.integers(1, 5, 20))}
        args = [np.array([k for k, _ in sorted(x.items())], np.uint64) if i == 0 else
                np.array([c for _, c in sorted(x.items())], np.uint32) for x in (v, w) for i in (0, 1)]
        assert lsh.probability_jaccard(*args) == pytest.approx(brute.probability_jaccard(v, w))


def test_registers_agree_as_often_as_the_sets():
    rng = np.random.default_rng(2)
    k = 4096
    v, w = {i: int(c) for i, c in enumerate(rng.integers(1, 4, 60))}, {i + 20: int(c) for i, c in enumerate(rng.integers(1, 4, 60))}
    rows, h, c = [], [], []
    for r, s in enumerate((v, w)):
        for e in sorted(s):
            rows.append(r), h.append(int(C.mix64(np.array([e + 1], np.uint64))[0])), c.append(s[e])
    sig = minhash.prob_minhash(np.array(rows), np.array(h, np.uint64), np.array(c), 2, k)
    assert abs((sig[0] == sig[1]).mean() - brute.probability_jaccard(v, w)) < 0.03


def test_bound_never_lies_below_the_similarity():
    rng = np.random.default_rng(3)
    for _ in range(300):
        v = {int(k): int(c) for k, c in zip(rng.choice(60, 30, False), rng.integers(1, 6, 30))}
        w = {k: c for k, c in v.items() if rng.random() < 0.9} | {int(k): 1 for k in rng.choice(60, rng.integers(1, 6))}
        a = sum(c for k, c in v.items() if k not in w) / sum(v.values())
        b = sum(c for k, c in w.items() if k not in v) / sum(w.values())
        assert brute.probability_jaccard(v, w) <= ((1 - a) / (1 + a) + (1 - b) / (1 + b)) / 2 + 1e-12


@pytest.mark.parametrize("rows", [1, 2, 3, 10000])
def test_bucket_members_across_batches(spark, rows):
    """Runs of a bucket that Arrow batches cut keep their leader."""
    rng = np.random.default_rng(rows)
    pairs = sorted({(int(i), int(b)) for i, b in zip(rng.integers(0, 400, 300), rng.integers(0, 60, 300))} | {(1, 99), (5, 98), (7, 98)})
    held = {}
    for i, b in pairs:
        held.setdefault(b, []).append(i)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        got = lsh.colliding(spark.createDataFrame(pairs, "id long, band long")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r.band, r.id, r.a) for r in got) == sorted((b, i, min(m)) for b, m in held.items() if len(m) > 1 for i in m)
