"""Vector jobs against brute-force numpy on small fixtures."""

import numpy as np
from pyspark.sql import functions as F

from newsgraph.operators import density as D
from newsgraph.operators import vectors as V


def _points(spark, X, weights=None):
    w = weights if weights is not None else [1] * len(X)
    rows = [(i, [float(v) for v in x], int(wi)) for i, (x, wi) in enumerate(zip(X, w))]
    return spark.createDataFrame(rows, "id bigint, vec array<double>, weight bigint")


def _blobs(seed=0):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0, 0], [10, 0, 0], [0, 10, 0]], dtype=float)
    X = np.concatenate([c + rng.normal(scale=0.5, size=(30, 3)) for c in centres])
    noise = rng.uniform(-20, 30, size=(5, 3)) + np.array([0, 0, 40])
    return np.concatenate([X, noise])


def _brute_core(X, w, m=2):
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    out = []
    for i in range(len(X)):
        need = m - (w[i] - 1)
        if need <= 0:
            out.append(0.0)
            continue
        order = sorted((d[i, j], j) for j in range(len(X)) if j != i)
        s = 0
        for dist, j in order:
            s += w[j]
            if s >= need:
                out.append(dist)
                break
    return np.array(out), d


def test_core_distances_exact_across_blocks(spark):
    X = _blobs()
    w = [1] * len(X)
    w[3], w[40] = 3, 2                       # copies of a topic
    got = {r.id: r.core for r in D.core_distances(_points(spark, X, w), block_size=16).collect()}
    want, _ = _brute_core(X, w)
    assert np.allclose([got[i] for i in range(len(X))], want)


def test_density_components_match_brute_force(spark):
    X = _blobs(1)
    cut = 1.2
    out = {r.id: r.cluster for r in D.density_components(_points(spark, X), cut, block_size=16).collect()}
    core, d = _brute_core(X, [1] * len(X))
    n = len(X)
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i in range(n):
        for j in range(i + 1, n):
            if core[i] <= cut and core[j] <= cut and max(core[i], core[j], d[i, j]) <= cut:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(n):
        if core[i] <= cut:
            groups.setdefault(find(i), []).append(i)
    want = {i: -1 for i in range(n)}
    for members in groups.values():
        if len(members) >= 2:
            for i in members:
                want[i] = min(members)
    assert out == want
    assert len({c for c in out.values() if c >= 0}) == 3


def test_seeded_kmeans_matches_numpy_lloyd(spark):
    X = _blobs(2)[:90]
    seeds = [X[0].tolist(), X[35].tolist(), X[70].tolist()]
    labelled, centres = V.seeded_kmeans(_points(spark, X), seeds, fixed_iterations=4)
    got = {r.id: r.cluster for r in labelled.collect()}
    C = np.array(seeds)
    for _ in range(4):
        lab = ((X[:, None, :] - C[None]) ** 2).sum(-1).argmin(1)
        C = np.array([X[lab == k].mean(0) if (lab == k).any() else C[k] for k in range(3)])
    lab = ((X[:, None, :] - C[None]) ** 2).sum(-1).argmin(1)
    assert [got[i] for i in range(len(X))] == lab.tolist()
    assert np.allclose(np.array(centres), C)


def test_weighted_points_equal_copies(spark):
    X = _blobs(3)[:60]
    w = [1 + (i % 3) for i in range(len(X))]
    seeds = [X[0].tolist(), X[40].tolist()]
    a, ca = V.seeded_kmeans(_points(spark, X, w), seeds, weight_col="weight", fixed_iterations=3)
    rep = np.repeat(X, w, axis=0)
    b, cb = V.seeded_kmeans(_points(spark, rep), seeds, fixed_iterations=3)
    assert np.allclose(np.array(ca), np.array(cb))


def test_mean_word_vectors(spark):
    words = spark.createDataFrame([("red", [1.0, 2.0]), ("ring", [3.0, 4.0])], "word string, vec array<double>")
    topics = spark.createDataFrame([("red ring",), ("red",), ("blue",)], "topic string")
    got = {r.topic: r.vec for r in V.mean_word_vectors(topics, words).collect()}
    assert got == {"red ring": [2.0, 3.0], "red": [1.0, 2.0]}


def test_word2vec_repeatable(spark):
    df = spark.createDataFrame([("red plate",), ("hot plate",), ("blue ring",)], "topics string")
    v1 = V.topic_vectors(df.withColumnRenamed("topics", "topic"), V.train_word2vec(df, dim=8, partitions=1)).collect()
    v2 = V.topic_vectors(df.withColumnRenamed("topics", "topic"), V.train_word2vec(df, dim=8, partitions=1)).collect()
    assert [r.vec for r in v1] == [r.vec for r in v2] and len(v1[0].vec) == 8
    assert F is not None


def test_word2vec_puts_words_that_occur_together_near_each_other(spark):
    """Planted groups of words: each word's nearest other word is of its group."""
    import random

    from pyspark.ml.functions import vector_to_array

    rng = random.Random(2)
    groups = [[f"g{g}w{i}" for i in range(5)] for g in range(4)]
    rows = [(" ".join(rng.sample(groups[k % 4], 4)),) for k in range(1600)]
    model = V.train_word2vec(spark.createDataFrame(rows, "topics string"), dim=16, partitions=2)
    vecs = {r.word: np.array(r.v) for r in model.getVectors().select("word", vector_to_array("vector").alias("v")).collect()}
    assert len(vecs) == 20
    unit = {w: v / np.linalg.norm(v) for w, v in vecs.items()}
    for w, v in unit.items():
        best = max((x for x in unit if x != w), key=lambda x: v @ unit[x])
        assert best[:2] == w[:2]
