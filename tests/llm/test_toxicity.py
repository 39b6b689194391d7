import random
import zlib

import pytest

from newsgraph.llm import toxicity
from tests.llm import brute


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def corpus(spark, extra=False):
    rng = random.Random(4)
    rows, labels = brute.messy_documents(), []
    for i in range(500, 1100):
        bad = rng.random() < 0.3
        w = brute.sentence(rng, rng.randint(5, 60)).split()
        if bad:
            for x in ("vile", "you", "toad"):
                w.insert(rng.randrange(len(w)), x if x != "toad" else "toad face")
        rows.append((i, " ".join(w), "en", "a", 0))
        labels.append((i, None, int(bad)))
    labels += [(1, 1, None), (2, 1, 0), (2, 1, 0), (None, 1, 1), (99999, 1, 1)]
    return (brute.frame(spark, rows, extra), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
            rows, {i: t for i, _, t in labels if t is not None})


@pytest.mark.parametrize("extra", [False, True])
def test_held_out_rows_are_told_apart(spark, extra):
    docs, labels, rows, truth = corpus(spark, extra)
    got = toxicity.op8(docs, labels).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r[0] for r in rows), key=repr)
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    again = {r.doc_id: r.score for r in toxicity.op8(docs.repartition(7), labels).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in got if r.doc_id is not None)


def test_held_out_labels_are_not_used(spark):
    docs, labels, _, _ = corpus(spark)
    turned = labels.selectExpr("doc_id", "quality", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 "
                               "then 1 - toxic else toxic end as toxic")
    a = {r.doc_id: r.score for r in toxicity.op8(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.op8(docs, turned).collect()}
    assert a == pytest.approx(b)


def test_no_labels_and_no_documents(spark):
    docs, labels, _, _ = corpus(spark)
    assert all(r.predicted == 0 for r in toxicity.op8(docs, labels.limit(0)).collect())
    assert toxicity.op8(docs.limit(0), labels).collect() == []


def test_stage_keeps_columns_and_drops_toxic(spark, tmp_path):
    docs, labels, _, _ = corpus(spark, True)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = toxicity.drop_toxic(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    gone = {r.doc_id for r in toxicity.op8(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - gone
