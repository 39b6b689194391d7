"""Density jobs against plain versions: neighbours, trees, components, and the
choice of clusters."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsgraph.operators import density as D
from newsgraph.operators import forest as FO
from newsgraph.operators import hierarchy as H
from newsgraph.operators import neighbours as N


def frame(spark, X, weights=None, ids=None):
    w = weights if weights is not None else [1] * len(X)
    ids = ids if ids is not None else range(len(X))
    rows = [(int(i), [float(v) for v in x], int(k)) for i, x, k in zip(ids, X, w)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>, weight bigint").repartition(3)


def blobs(seed, n=25, k=4, d=3, noise=8):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-12, 12, (k, d))
    X = [c + rng.normal(scale=rng.uniform(0.2, 1.2), size=(n, d)) for c in centres]
    return np.concatenate([*X, rng.uniform(-20, 20, (noise, d))])


# -- plain versions -----------------------------------------------------------

def reach(X, weights, m=2):
    """Copies written out: their owners, and the matrix of mutual reachability."""
    own = np.repeat(np.arange(len(X)), weights)
    P = np.asarray(X, float)[own]
    d = np.sqrt(((P[:, None] - P[None]) ** 2).sum(-1))
    near = np.sort(np.where(np.eye(len(P), dtype=bool), np.inf, d), axis=1)
    core = near[:, m - 1] if len(P) > m else np.full(len(P), np.inf)
    return own, np.maximum(np.maximum(d, core[:, None]), core[None])


def plain_clusters(X, weights, least=2):
    """Components at every distance, top down, then the choice bottom up."""
    own, r = reach(X, weights, least)
    n = len(r)

    def parts(members, d):
        left, out = set(members), []
        while left:
            todo, comp = [left.pop()], set()
            while todo:
                x = todo.pop()
                comp.add(x)
                got = {y for y in left if r[x, y] <= d}
                left -= got
                todo += got
            out.append(comp)
        return out

    def tree(members, birth):
        """(members at birth, stability, children) of the cluster born here."""
        stability, now = 0.0, set(members)
        levels = sorted({r[i, j] for i in members for j in members if i != j and np.isfinite(r[i, j])}, reverse=True)
        for k, d in enumerate(levels):
            under = levels[k + 1] if k + 1 < len(levels) else -1.0
            if any(r[i, j] == d for i in now for j in now if i != j) and len(parts(now, d)) == 1:
                split = parts(now, under)
                large = [p for p in split if len(p) >= least]
                if len(split) == 1:
                    continue
                level = math.inf if d == 0 else 1 / d
                if len(large) == 1:
                    stability += (level - birth) * (len(now) - len(large[0]))
                    now = large[0]
                else:
                    stability += (level - birth) * len(now)
                    return set(members), stability, [tree(p, level) for p in large]
        return set(members), stability, []

    def choose(c):
        members, stability, children = c
        below = [choose(x) for x in children]
        best = sum(b for b, _ in below) if below else -math.inf
        return (stability, [members]) if stability >= best else (best, [m for _, ms in below for m in ms])

    label = {i: -1 for i in range(len(X))}
    if n > 1:
        for child in tree(set(range(n)), 0.0)[2]:
            for members in choose(child)[1]:
                ids = {int(own[m]) for m in members}
                for i in ids:
                    label[i] = min(ids)
    return label


def plain_tree_weights(X, weights):
    n = len(X)
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    own, r = reach(X, weights)
    first = np.searchsorted(own, np.arange(n))
    m = r[np.ix_(first, first)]
    np.fill_diagonal(m, np.inf)
    inside, out = {0}, []
    while len(inside) < n:
        best = min((m[i, j], j) for i in inside for j in range(n) if j not in inside)
        out.append(best[0])
        inside.add(best[1])
    assert d.shape == m.shape
    return sorted(out)


# -- neighbours ---------------------------------------------------------------

@pytest.mark.parametrize("block", [7, 4096])
def test_neighbours_are_exact(spark, block):
    X = np.concatenate([blobs(1), np.tile([[1.0, 2.0, 3.0]], (20, 1))])  # a hot cell of equal points
    got = {r.id: [(x.d, x.nb) for x in r.nbrs] for r in N.knn(frame(spark, X), 3, block).collect()}
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    for i in range(len(X)):
        want = sorted((d[i, j], j) for j in range(len(X)) if j != i)[:3]
        assert [nb for _, nb in got[i]] == [j for _, j in want]
        assert np.allclose([x for x, _ in got[i]], [x for x, _ in want])


def test_a_distance_has_one_value():
    rng = np.random.default_rng(6)
    X = rng.normal(size=(300, 64)).astype(np.float32).astype(float)
    d = N.distances(X, X)
    assert (d == d.T).all() and np.allclose(d, np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)))
    for i in (0, 17, 299):
        assert (N.row_distances(np.ascontiguousarray(X.T), i) == d[i]).all()
        assert (N.distances(X[i:i + 1], X[5:60]) == d[i, 5:60]).all()


def test_few_points_have_fewer_neighbours(spark):
    assert N.knn(frame(spark, []), 2).collect() == []
    assert N.knn(frame(spark, [[1.0, 2.0]]), 2).collect() == []
    got = N.knn(frame(spark, [[0.0], [1.0], [3.0]]), 5).collect()
    assert {r.id: [x.nb for x in r.nbrs] for r in got} == {0: [1, 2], 1: [0, 2], 2: [1, 0]}


def test_far_cells_do_not_meet(spark, monkeypatch):
    """Visits, the rows that are shuffled, stay far from quadratic."""
    seen = {}
    put = N.Rounds.put

    def watch(self, name, df):
        out = put(self, name, df)
        if name == "visits":
            seen[len(seen)] = out.count()
        return out

    monkeypatch.setattr(N.Rounds, "put", watch)
    for n in (400, 1600):
        rng = np.random.default_rng(n)
        X = rng.uniform(-100, 100, (20, 4))[rng.integers(0, 20, n)] + rng.normal(scale=0.5, size=(n, 4))
        N.knn(frame(spark, X), 2, 16).collect()
    blocks = 1600 / 16
    assert seen[1] < 0.25 * 1600 * blocks and seen[1] < 9 * seen[0]


# -- components and trees -----------------------------------------------------

@pytest.mark.parametrize("finish", [0, None])
def test_components(spark, finish):
    rng = np.random.default_rng(4)
    e = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(40)] + [(200, 200)]
    up = {}
    for a, b in e:
        x, y = FO._root(up, a), FO._root(up, b)
        up[max(x, y)] = min(x, y)
    got = {r.id: r.comp for r in FO.edge_components(spark.createDataFrame(e, "a bigint, b bigint"), finish).collect()}
    assert got == {x: FO._root(up, x) for x in up}


def test_rounds_are_logarithmic_on_a_chain(spark, monkeypatch):
    made = []
    put = FO.Rounds.put
    monkeypatch.setattr(FO.Rounds, "put", lambda self, name, df: made.append(name) or put(self, name, df))
    n = 600
    rng = np.random.default_rng(0)
    at = rng.permutation(n).tolist()
    got = FO.edge_components(spark.createDataFrame(list(zip(at, at[1:])), "a bigint, b bigint"), 0).collect()
    assert len(got) == n and {r.comp for r in got} == {0}
    assert made.count("stars") <= 2 * math.log2(n)


def test_a_block_pair_emits_a_forest(spark):
    X = np.tile(blobs(2, n=20), (3, 1))   # dense: nearly every pair is under the cut
    pts = frame(spark, X)
    cores = D.core_distances(pts)
    emitted = FO.block_forests(pts, cores, 32, cut=50.0).count()
    blocks = -(-len(X) // 32)
    assert emitted <= blocks * (blocks - 1) / 2 * 2.6 * 32 < len(X) ** 2 / 2


@pytest.mark.parametrize("finish", [0, 40, None])
def test_tree_weight_equals_the_plain_tree(spark, finish):
    X = blobs(3, n=20)
    w = np.ones(len(X), int)
    w[[2, 30]] = 2, 4
    pts = frame(spark, X, w)
    cores = D.core_distances(pts).select("id", "weight", "core")
    tree = FO.reachability_tree(pts, cores, 16, finish).collect()
    assert len(tree) == len(X) - 1 and np.allclose(sorted(r.w for r in tree), plain_tree_weights(X, w))
    up = {}
    for r in tree:
        x, y = FO._root(up, r.a), FO._root(up, r.b)
        assert x != y and r.a < r.b
        up[max(x, y)] = min(x, y)


# -- the choice of clusters ---------------------------------------------------

@pytest.mark.parametrize("seed,least", [(1, 2), (2, 2), (3, 2), (4, 3), (5, 5)])
def test_clusters_match_the_plain_version(spark, seed, least):
    X = blobs(seed, n=10, noise=5)
    w = np.ones(len(X), int)
    if seed % 2:
        w[[1, 12, 13]] = 3, 2, 2
        X[20] = X[21]                     # two topics with one vector
    got = {r.id: r.cluster for r in D.density_clusters(frame(spark, X, w), least, block_size=16).collect()}
    assert got == plain_clusters(X, w, least)
    assert len(set(got.values())) > 2


def _numbers(tree):
    return [(int(a), int(b), float(w)) for a, b, w in tree]


@pytest.mark.parametrize("seed", range(4))
def test_ranges_do_not_change_the_result(spark, seed):
    """Small ranges, single-weight ranges by joins, and pointers over many
    ranges give what one range gives."""
    rng = np.random.default_rng(seed)
    n = 60
    weight = np.where(rng.random(n) < 0.2, rng.integers(2, 5, n), 1)
    core = rng.integers(0, 4, n) / 4
    at = rng.permutation(n)
    ends = [(at[i], at[rng.integers(max(0, i - 6), i)]) for i in range(1, n)]
    tree = [(min(a, b), max(a, b), max(core[a], core[b], rng.integers(0, 9) / 8)) for a, b in ends]
    nodes = spark.createDataFrame([(i, int(weight[i]), float(core[i])) for i in range(n)], "id bigint, weight bigint, core double")
    edges = spark.createDataFrame(_numbers(tree), "a bigint, b bigint, w double")
    whole = {r.id: r.cluster for r in H.condense(nodes, edges, 2).collect()}
    assert whole == {r.id: r.cluster for r in H.condense(nodes, edges, 2, size=2 if seed % 2 else 9).collect()}


def test_few_or_equal_points(spark):
    assert D.density_clusters(frame(spark, [])).collect() == []
    assert [tuple(r)[:2] for r in D.density_clusters(frame(spark, [[1.0, 1.0]])).collect()] == [(0, -1)]
    same = D.density_clusters(frame(spark, [[1.0, 1.0]] * 6)).collect()
    assert {r.cluster for r in same} == {-1} and all(r.core == 0 for r in same)
    assert F is not None


# -- points that distances do not tell apart ----------------------------------

def unstructured(n, dim=32):
    return np.random.default_rng(n).normal(size=(n, dim)).astype(np.float32).astype(float)


def test_a_point_is_sent_once_per_pack(spark, monkeypatch):
    seen = {}
    put = N.Rounds.put

    def watch(self, name, df):
        out = put(self, name, df)
        if name == "visits":
            seen[name] = out.count()
        return out

    monkeypatch.setattr(N.Rounds, "put", watch)
    X = unstructured(640)
    got = {r.id: [x.nb for x in r.nbrs] for r in N.knn(frame(spark, X), 3, 8).collect()}
    d = N.distances(X, X)
    np.fill_diagonal(d, np.inf)
    assert got == {i: np.lexsort((np.arange(640), d[i]))[:3].tolist() for i in range(640)}
    assert seen["visits"] <= 640 * 2 * N.LEAST_PACKS  # blocks of 8 would be 80


@pytest.mark.parametrize("scale", [1.0, 1e-150, 1e160])
@pytest.mark.parametrize("limited", [False, True])
def test_closest_is_exact(scale, limited):
    X = np.concatenate([unstructured(150, 5), np.tile(unstructured(1, 5), (30, 1)), np.round(unstructured(60, 5))]) * scale
    ids = np.random.default_rng(1).permutation(len(X))
    d = N.distances(X, X)
    np.fill_diagonal(d, np.inf)
    limit = np.sort(d, axis=1)[:, 3] if limited else None
    row, col, dist = N.closest(X, X, ids, 4, limit, same=True)
    assert (dist == d[row, col]).all()
    ok = np.isfinite(d)
    want = [[j for j in np.lexsort((ids, d[i]))[:4].tolist() if ok[i, j]] for i in range(len(X))]
    assert [col[row == i].tolist() for i in range(len(X))] == want


def test_block_tree_is_that_of_all_distances():
    for X in (unstructured(300, 8), np.round(unstructured(300, 2)), np.tile(unstructured(40, 3), (4, 1))):
        ids = np.random.default_rng(3).permutation(len(X)) + 5
        core = np.sort(N.distances(X, X), axis=1)[:, 2]
        reach = np.maximum(np.maximum(N.distances(X, X), core), core[:, None])
        up, want = {}, []
        for w, a, b in sorted((reach[i, j], min(ids[i], ids[j]), max(ids[i], ids[j])) for i in range(len(X)) for j in range(i)):
            x, y = FO._root(up, a), FO._root(up, b)
            if x != y:
                up[max(x, y)] = min(x, y)
                want.append((a, b, w))
        assert sorted(zip(*FO.block_tree(X, core, ids))) == sorted(want)


def _islands(n=6, dim=3):
    """Tight groups of more points than a list holds, loose points, equal points."""
    rng = np.random.default_rng(8)
    X = [rng.uniform(-20, 20, dim) + rng.normal(scale=0.05, size=(k, dim)) for k in rng.integers(10, 30, n)]
    return np.concatenate([*X, rng.uniform(-20, 20, (25, dim)), np.tile(rng.uniform(-20, 20, dim), (14, 1))])


@pytest.mark.parametrize("X", [_islands(), np.round(unstructured(90, 2) * 2)], ids=["islands", "ties"])
def test_tree_from_neighbour_lists(spark, monkeypatch, X):
    monkeypatch.setattr(FO, "SMALL", 0)
    monkeypatch.setattr(FO, "block_tree", lambda *a: 1 / 0)  # no row of distances after another
    monkeypatch.setattr(FO, "RANGE", 40)
    monkeypatch.setattr(N, "PACK_POINTS", 30)
    w = np.ones(len(X), int)
    w[[2, 30]] = 2, 4
    tree, cores = D.density_tree(frame(spark, X, w), block_size=16)
    tree = tree.collect()
    assert np.allclose(sorted(r.w for r in tree), plain_tree_weights(X, w)) and cores.count() == len(X)
    up = {}
    for r in tree:
        x, y = FO._root(up, r.a), FO._root(up, r.b)
        assert x != y and r.a < r.b
        up[max(x, y)] = min(x, y)


def test_components_from_neighbour_lists(spark, monkeypatch):
    X, cut = _islands(), 3.0
    want = {r.id: r.cluster for r in D.density_components(frame(spark, X), cut, block_size=16).collect()}
    monkeypatch.setattr(FO, "SMALL", 0)
    monkeypatch.setattr(D, "block_forests", lambda *a: 1 / 0)
    assert {r.id: r.cluster for r in D.density_components(frame(spark, X), cut, block_size=16).collect()} == want


def test_clusters_from_neighbour_lists(spark, monkeypatch):
    X = blobs(2, n=10, noise=5)
    w = np.ones(len(X), int)
    w[[1, 12]] = 3, 2
    monkeypatch.setattr(FO, "SMALL", 0)
    monkeypatch.setattr(D, "block_forests", lambda *a: 1 / 0)
    monkeypatch.setattr(FO, "block_forests", lambda *a: 1 / 0)
    got = {r.id: r.cluster for r in D.density_clusters(frame(spark, X, w), 2, block_size=16).collect()}
    assert got == plain_clusters(X, w, 2)


@pytest.mark.parametrize("scale", [1.0, 1e160])
def test_lightest_is_that_of_all_pairs(scale):
    rng = np.random.default_rng(2)
    X = np.concatenate([np.round(unstructured(80, 3)), unstructured(60, 3)]) * scale
    ids, part = rng.permutation(len(X)) + 3, rng.integers(0, 7, len(X))
    core = rng.choice([0.1, 0.7, 1.5, np.inf], len(X)) * scale
    d = N.distances(X, X)
    for most in (np.inf, 0.9 * scale):
        limit = np.where(part < 6, most, np.inf)
        want = {}
        for i in range(len(X)):
            for j in range(len(X)):
                w = max(d[i, j], core[i], core[j])
                if part[i] != part[j] and np.isfinite(w) and w <= limit[i]:
                    edge = (w, min(ids[i], ids[j]), max(ids[i], ids[j]))
                    want[part[i]] = min(want.get(part[i], edge), edge)
        got = FO.lightest(X, X, core, core, ids, ids, part, part, limit)
        assert {p: (w, a, b) for p, a, b, w in zip(*got)} == want


def test_blocks_follow_the_table(spark):
    X = unstructured(640, 4)
    pts = frame(spark, X)
    emitted = FO.block_forests(pts, D.core_distances(pts), 8).count()
    assert emitted <= N.LEAST_PACKS * len(X)  # blocks of 8 would emit 80 x 640
