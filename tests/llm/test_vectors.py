import numpy as np
import pytest

from newsgraph.llm import vectors
from tests.llm import brute


def expected(rows, threshold=0.9):
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and len(v) == 8 and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float) != 0)]
    u = np.array([v / np.abs(v).max() for _, v in good])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    ids = [i for i, _ in good]
    root = brute.roots(set(ids), [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    out = {}
    for k, (i, v) in enumerate(good):
        out.setdefault((i, tuple(map(float, v))), []).append((int(near[k].sum()) - 1, root[i]))
    return out


def table(seed=1, n=300):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + rng.normal(size=8) * (0.05 if i % 3 else 0.6)).astype(np.float32).tolist()) for i in range(n)]
    hot = rows[5][1]
    rows += [(1000 + i, hot) for i in range(40)]
    rows += [(2000 + i, (np.array(hot) * 2 + rng.normal(size=8) * 0.02).astype(np.float32).tolist()) for i in range(40)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 8), (3003, [float("nan")] + [1.0] * 7), (3004, [None] + [1.0] * 7),
             (3005, [float("inf")] + [1.0] * 7), (3006, [1.0, 2.0]), (None, hot), (7, rows[7][1]), (3007, [-0.0] * 7 + [1.0]),
             (3008, [0.0] * 7 + [1e30]), (3009, [0.0] * 7 + [1e-30])]
    return rows


@pytest.mark.parametrize("tile,extra", [(2048, False), (16, True)])
def test_links_match_brute_force(spark, monkeypatch, tile, extra):
    from pyspark.sql import functions as F

    monkeypatch.setattr(vectors, "TILE", tile)
    rows = table()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    if extra:
        for c in ("cid", "rep", "m", "v", "tile", "x", "label"):
            df = df.withColumn(c, F.lit("y"))
    got = vectors.op2(df.repartition(3)).collect()
    assert len(got) == len(rows)
    want = expected(rows)
    good = sorted((i, n, c) for (i, _), found in want.items() for n, c in found)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id in {i for i, _, _ in good}) == good
    for r in got:
        assert r.kept == (r.component_id is None or r.vec_id == r.component_id)
        if r.vec_id is None or r.vec_id in range(3000, 3007):
            assert r.n_links == 0 and r.component_id == r.vec_id


def test_a_tile_is_sent_once_per_pack(spark):
    assert vectors.pack_tiles(352, 64 * 4) == 16 and vectors.pack_tiles(352, 4096 * 8) == 1 and vectors.pack_tiles(3, 256) == 1
    blocks = spark.createDataFrame([(i, i / 40 - 0.01, i / 40 + 0.01) for i in range(40)], "tile int, lo double, hi double")
    rows = vectors.meetings(blocks, 5, 2.0).collect()
    assert len(rows) == 40 * 8  # by tiles it was 40 * 41
    met = {(r.pa, r.pb): set() for r in rows}
    for r in rows:
        met[r.pa, r.pb].add(r.tile)
    assert len(met) == 36 and all(tiles == {t for t in range(40) if t // 5 in pair} for pair, tiles in met.items())
    near = {(r.pa, r.pb) for r in vectors.meetings(blocks, 5, 0.1).collect()}
    assert near == {(a, b) for a in range(8) for b in (a, a + 1) if b < 8}


def test_early_stop_keeps_every_pair():
    rng = np.random.default_rng(4)
    a = vectors.unit(rng.normal(size=(200, 40)) * np.linspace(3, 0.1, 40))
    i, j = vectors.linked_pairs(a, a, 0.8, True)
    want = np.argwhere(np.triu(a @ a.T >= 0.8, 1))
    assert sorted(zip(i, j)) == sorted(map(tuple, want))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.op2(df).collect() == []
