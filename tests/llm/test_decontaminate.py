import random

import pytest

from newsgraph.llm import decontaminate
from tests.llm import brute


def expected(rows, items, window=10):
    out = []
    for i, text, *_ in rows:
        w = brute.words(text)
        hit, ids = set(), set()
        for item, t in items:
            k = brute.words(t)
            n = min(window, len(k))
            if not n:
                continue
            wins = {tuple(k[a:a + n]) for a in range(len(k) - n + 1)}
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in wins:
                    hit.update(range(p, p + n))
                    ids.add("null" if item is None else str(item))
        out.append((i, len(w), len(hit), len(ids), brute.sha(",".join(sorted(ids)).encode()), bool(hit)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(9)
    rows = brute.messy_documents()
    items = [(i, brute.sentence(rng, rng.choice([4, 9, 10, 11, 40]))) for i in range(20)]
    items += [(100, None), (101, ""), (102, "One"), (103, "word " * 12), (7, items[3][1]), (None, items[4][1]),
              (10, " ".join(rows[60][1].split()[5:40]))]
    rows = list(rows)
    for i in range(15):
        t = items[i][1].split()
        rows.append((1000 + i, brute.sentence(rng, 20) + " " + " ".join(t[:rng.choice([8, 10, 30])]).upper() + " ! "
                     + brute.sentence(rng, 3) + " " + " ".join(t[-12:]), "en", "a", 0))
    return rows, items


@pytest.mark.parametrize("extra", [False, True])
def test_hits_match_brute_force(spark, extra):
    rows, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.op5(brute.frame(spark, rows, extra), bench).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=repr)
    assert got == expected(rows, items)


def test_many_small_blocks(spark, monkeypatch):
    rows, items = cases()
    monkeypatch.setattr(decontaminate, "BLOCK_DOCS", 3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    got = decontaminate.op5(brute.frame(spark, rows), bench).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=repr)
    assert got == expected(rows, items)


def test_empty_tables(spark):
    rows, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.op5(brute.frame(spark, []).coalesce(1), bench).collect() == []
    got = decontaminate.op5(brute.frame(spark, rows), bench.limit(0)).collect()
    assert len(got) == len(rows) and not any(r.contaminated for r in got)


def test_near_counts_words_that_stand_apart(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, item, "", "", 0), (2, item.replace("gamma", "gamma big"), "", "", 0), (3, "alpha kappa", "", "", 0)]
    got = decontaminate.contamination(brute.frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    got = {r.doc_id: (r.n_hit, r.n_near > 0) for r in got.collect()}
    assert got[1][0] == 10 and got[2][0] == 0


def test_stage_drops_hit_documents(spark, tmp_path):
    rows, items = cases()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = brute.frame(spark, rows, True)
    out = decontaminate.drop_contaminated(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    clean = sorted((e[0] for e in expected(rows, items) if not e[-1]), key=repr)
    assert sorted((r.doc_id for r in out.collect()), key=repr) == clean
