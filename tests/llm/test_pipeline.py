import pytest

import corpus_pipeline
from newsgraph.llm import common as C
from tests.llm import brute, test_decontaminate, test_minhash, test_mixing, test_suffix


def test_stages_apply_in_turn(spark, tmp_path):
    rows = brute.messy_documents()
    brute.frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, " ".join(rows[4][1].split()[:30]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    names = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = C.keep(stage(spark, docs, str(tmp_path)), f"test-{name}")
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == names
        docs = out
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, docs.collect()))
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 4 not in ids


def test_without_labels_or_benchmark_rows(spark, tmp_path):
    brute.frame(spark, brute.messy_documents()).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


@pytest.mark.parametrize("extra", [False, True])
def test_each_stage_against_its_plain_version(spark, tmp_path, extra):
    """The plain version of every stage on what its predecessor kept, with
    nulls, ties, repeated rows, very long texts and clashing columns."""
    rows = brute.messy_documents()
    items = [(1, " ".join(rows[4][1].split()[:30])), (2, None), (2, "the of"), (None, " ".join(rows[9][1].split()[-12:]))]
    brute.frame(spark, rows, extra).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = C.keep(stage(spark, docs, str(tmp_path)), f"plain-{name}")
        kept[name] = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
        if name != "mixing":
            assert docs.columns == before.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(map(key, kept["toxicity"])) == sorted(map(key, rows))  # nothing to learn from: all stay
    first = {i for i, c in test_minhash.expected(rows) if i == c}
    assert sorted(r[0] for r in kept["minhash"] if r[0] is not None) == sorted(first)
    assert sum(r[0] is None for r in kept["minhash"]) == 2
    cut = sorted(kept["minhash"], key=key)
    marks = test_suffix.covered([(r[1] or "").encode() for r in cut])
    left = {r[0]: bytes(x for x, m in zip((r[1] or "").encode(), k) if not m).decode(errors="ignore") for r, k in zip(cut, marks)}
    assert {r[0]: r[1] or "" for r in kept["suffix"] if r[0] is not None} == {i: t for i, t in left.items() if i is not None}
    hits = {r[0] for r in test_decontaminate.expected(kept["suffix"], items) if r[-1]}
    assert hits and sorted(r[0] for r in kept["decontaminate"] if r[0] is not None) == sorted(
        r[0] for r in kept["suffix"] if r[0] is not None and r[0] not in hits)
    size, target = test_mixing.goals(kept["decontaminate"])
    taken = {}
    own = [C.fresh(before, c) for c in ("taken", "size")]  # beside clashing columns the results get other names
    for source, n, length in docs.select("source", *own).collect():
        assert 0 < n <= 2 * length
        taken[source] = taken.get(source, 0) + n
    assert all(abs(taken.get(s, 0) - target[s]) <= 1 for s in target)


def test_empty_documents(spark, tmp_path):
    brute.frame(spark, []).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
