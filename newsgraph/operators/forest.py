"""Connected components and minimum spanning trees as Spark jobs.

*Block pairs.*  Points are dealt into blocks (of ``neighbours.pack_size``); each
two blocks are one group that computes the minimum spanning forest of its own
points and emits only that: an edge less than its points, never its pairs.  An edge that is
the heaviest of a cycle in some group is in no spanning tree of the whole (edges
are ordered by weight, then ends, so there are no ties), hence the tree of all
points is the tree of what the groups emit.  A table of more than ``SMALL``
points, in which that is too much arithmetic, is joined from neighbour lists.

*Neighbour lists.*  An edge that is in no list is no lighter than the last
distance listed at either end, and of edges of one weight the listed ones come
first.  So the lightest listed edge that leaves a part is the lightest of all if
it is within the lists of the part's points.  The spanning forest of the listed
edges is taken, and its edges that are certain in this way are kept
(``certain_edges``).  The parts they form choose their lightest edge as in
Borůvka's rounds; a part that its lists do not settle is searched against all
points, except the largest, which waits to be chosen.

*Borůvka.*  Each round every component takes its lightest outgoing edge (a
grouped minimum), components hook onto each other along these, pointers
jump to the roots, and the edges are contracted to the lightest one between two
components.  A round at least halves the components.

*Components.*  Alternating large-star and small-star steps, as grouped
minima and joins; their number grows with the logarithm of the longest path.

Each round's tables are written to the shared folder and the superseded ones
dropped.  Once at most ``FINISH`` edges are left, which is counted, one bounded
task ends the job; the result is the same."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.operators.neighbours import (DEFAULT_BLOCK, knn, pack_size, pair_distances, product_bounds, product_error,
                                            vectors_of)
from newsgraph.session import Rounds

FINISH = 1 << 17
SMALL = 1 << 14       # points of a table whose block pairs are compared outright
LISTED = 8            # neighbours listed per point of a larger one
RANGE = 1 << 17       # edges that one task follows
EDGES = "a long, b long, w double"


def _root(up: dict, x):
    top = x
    while up.setdefault(top, top) != top:
        top = up[top]
    while up[x] != top:
        up[x], x = top, up[x]
    return top


def _in_one_task(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` on the whole of a table that was counted to be small."""
    return df.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(lambda t: fn(t.drop_columns(["_all"])), schema)


# -- components ---------------------------------------------------------------

def _label_small(t: pa.Table) -> pa.Table:
    up: dict[int, int] = {}
    for u, v in zip(t.column("u").to_pylist(), t.column("v").to_pylist()):
        x, y = _root(up, u), _root(up, v)
        up[max(x, y)] = min(x, y)
    return pa.table({"id": list(up), "comp": [_root(up, x) for x in up]}, schema=pa.schema([("id", pa.int64()), ("comp", pa.int64())]))


def edge_components(edges: DataFrame, finish: int | None = None) -> DataFrame:
    """``(id, comp)`` of the ends of ``edges`` (a, b): the smallest id of
    their component.  Loops and repeated edges are fine."""
    finish = FINISH if finish is None else finish
    rounds = Rounds(edges.sparkSession, "components")
    e = rounds.put("edges", edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    alone = e.where("u = v").select(F.col("u").alias("id"), F.col("v").alias("comp"))
    e = e.where("u > v")
    before = None
    while True:
        n, mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if n <= finish:
            found = _in_one_task(e, _label_small, "id long, comp long")
            break
        if (n, mark) == before:  # stars: nothing moved
            found = (e.select(F.col("u").alias("id"), F.col("v").alias("comp"))
                     .union(e.select(F.col("v").alias("id"), F.col("v").alias("comp"))).distinct())
            break
        before = (n, mark)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
                 .union(low2.select("u", F.col("m").alias("v"))).distinct())
        e = rounds.put("stars", small)
        rounds.drop("stars")
    return found.union(alone.join(found, "id", "left_anti"))


def connected_components(vertices: DataFrame, edges: DataFrame, finish: int | None = None) -> DataFrame:
    """``(id, comp)`` of all ``vertices`` (id), those without an edge included."""
    found = edge_components(edges, finish)
    return vertices.select("id").join(found, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))


# -- spanning trees -----------------------------------------------------------

def block_tree(v: np.ndarray, core: np.ndarray, ids: np.ndarray, cut: float | None = None):
    """(a, b, w) of the minimum spanning forest of a group's points under
    mutual reachability, edges over ``cut`` left out; a row of distances at a
    time.  A matrix product bounds the row, and only points that the bound
    and the cores leave are measured, exactly."""
    n = len(ids)
    norm = np.einsum("ij,ij->i", v, v)
    bounded = bool(np.isfinite(norm).all()) and norm.max(initial=0) < 1e300
    slack = product_error(v.shape[1]) * (np.sqrt(norm) + math.sqrt(norm.max(initial=0))) ** 2 if bounded else None
    # the points that are not in the tree yet
    rest = np.arange(1, n)
    columns, own = np.ascontiguousarray(v[1:].T), norm[1:]
    best, out = np.full(len(rest), np.inf), np.ones(len(rest), bool)
    low, high = np.full(len(rest), np.iinfo(np.int64).max), np.full(len(rest), np.iinfo(np.int64).max)
    a, b, w = [], [], []
    at = 0
    for step in range(n - 1):
        if bounded:
            least = own - 2 * (v[at] @ columns) + (norm[at] - slack[at])
            with np.errstate(over="ignore"):
                maybe = np.flatnonzero(out & (least <= best * best * (1 + 1e-9)) & (np.maximum(core[rest], core[at]) <= best))
        else:
            maybe = np.flatnonzero(out)
        some = rest[maybe]
        reach = np.maximum(np.maximum(pair_distances(v[at][:, None], columns, np.zeros(len(some), np.int64), maybe), core[some]), core[at])
        lo, hi = np.minimum(ids[some], ids[at]), np.maximum(ids[some], ids[at])
        nearer = (reach < best[maybe]) | ((reach == best[maybe]) & ((lo < low[maybe]) | ((lo == low[maybe]) & (hi < high[maybe]))))
        new = maybe[nearer]
        best[new], low[new], high[new] = reach[nearer], lo[nearer], hi[nearer]
        tied = np.flatnonzero(best == best.min())
        tied = tied[out[tied]]
        to = int(tied[np.lexsort((high[tied], low[tied]))[0]])
        if cut is None or best[to] <= cut:
            a.append(low[to]), b.append(high[to]), w.append(best[to])
        at = int(rest[to])
        out[to], best[to] = False, np.inf
        if 2 * (left := n - 2 - step) <= len(rest) - 64:  # most are in the tree: read them no more
            rest, own, best, low, high = (x[out] for x in (rest, own, best, low, high))
            columns, out = np.ascontiguousarray(columns[:, out]), np.ones(left, bool)
    return np.array(a, np.int64), np.array(b, np.int64), np.array(w, np.float64)


def block_forests(points: DataFrame, cores: DataFrame, block_size: int = DEFAULT_BLOCK, cut: float | None = None) -> DataFrame:
    """``(a, b, w)``, a < b: the edges that block pairs emit.  ``points``:
    (id, vec), ``cores``: (id, core)."""
    pts = points.select("id", F.col("vec").cast("array<double>").alias("vec")).join(cores.select("id", "core"), "id")
    if cut is not None:
        pts = pts.where(F.col("core") <= cut)
    n = cores.count()
    blocks = max(1, math.ceil(n / pack_size(block_size, n)))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_o")
    dealt = pts.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).select("*", other)
    # a block meets itself inside its pairs with others
    dealt = dealt.where("_b != _o") if blocks > 1 else dealt
    pairs = dealt.select(F.least("_b", "_o").alias("g1"), F.greatest("_b", "_o").alias("g2"), "id", "vec", "core")

    def tree(t: pa.Table) -> pa.Table:
        a, b, w = block_tree(vectors_of(t.column("vec")), t.column("core").to_numpy(), t.column("id").to_numpy(), cut)
        return pa.table({"a": a, "b": b, "w": w})

    return pairs.groupBy("g1", "g2").applyInArrow(tree, EDGES)


def _tree_small(t: pa.Table) -> pa.Table:
    w, a, b = (t.column(c).to_numpy() for c in ("w", "a", "b"))
    ca, cb = t.column("ca").to_pylist(), t.column("cb").to_pylist()
    up: dict[int, int] = {}
    kept = []
    for i in np.lexsort((b, a, w)).tolist():
        x, y = _root(up, ca[i]), _root(up, cb[i])
        if x != y:
            up[max(x, y)] = min(x, y)
            kept.append(i)
    return pa.table({"a": a[kept], "b": b[kept], "w": w[kept]})


def minimum_spanning_forest(edges: DataFrame, finish: int | None = None) -> DataFrame:
    """The minimum spanning forest of ``edges`` (a, b, w), a < b, ordered by
    (w, a, b); repeated edges are fine."""
    finish = FINISH if finish is None else finish
    spark = edges.sparkSession
    rounds = Rounds(spark, "tree")
    e = rounds.put("edges", edges.dropDuplicates(["a", "b"]).select(
        F.col("a").alias("ca"), F.col("b").alias("cb"), "w", "a", "b"))
    done: list[DataFrame] = []
    while True:
        n = e.count()
        if n <= finish:
            done.append(_in_one_task(e, _tree_small, EDGES))
            break
        ends = e.select(F.col("ca").alias("c"), F.col("cb").alias("o"), "w", "a", "b").union(
            e.select(F.col("cb").alias("c"), F.col("ca").alias("o"), "w", "a", "b"))
        best = rounds.put("best", ends.groupBy("c").agg(F.min(F.struct("w", "a", "b", "o")).alias("m")))
        done.append(rounds.put("chosen", best.select("m.a", "m.b", "m.w").dropDuplicates(["a", "b"])))
        # hooks: of two components that chose each other the smaller is the root
        hook = best.select("c", F.col("m.o").alias("p"))
        back = hook.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        up = rounds.put("up", hook.join(back, "p", "left").select(
            "c", F.when((F.col("pp") == F.col("c")) & (F.col("c") < F.col("p")), F.col("c")).otherwise(F.col("p")).alias("p")))
        while True:
            far = up.select(F.col("c").alias("p"), F.col("p").alias("pp"))
            jumped = rounds.put("up", up.join(far, "p", "left").select("c", F.coalesce("pp", "p").alias("p"), (F.coalesce("pp", "p") != F.col("p")).alias("moved")))
            moved = not jumped.where("moved").isEmpty()
            up = jumped.select("c", "p")
            rounds.drop("up")
            if not moved:
                break
        left, right = up.select(F.col("c").alias("ca"), F.col("p").alias("x")), up.select(F.col("c").alias("cb"), F.col("p").alias("y"))
        inner = (e.join(left, "ca").join(right, "cb").where("x != y")
                 .groupBy(F.least("x", "y").alias("ca"), F.greatest("x", "y").alias("cb"))
                 .agg(F.min(F.struct("w", "a", "b")).alias("m")).select("ca", "cb", "m.w", "m.a", "m.b"))
        e = rounds.put("edges", inner)
        rounds.drop("edges", "best")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return rounds.put("tree", out)


# -- spanning trees from neighbour lists --------------------------------------

def listed_edges(neighbours: DataFrame, cores: DataFrame, cut: float | None = None) -> DataFrame:
    """``(a, b, w)``, a < b: every point and its listed neighbours under mutual
    reachability."""
    pair = neighbours.select("id", F.explode("nbrs").alias("n")).select("id", F.col("n.nb").alias("nb"), F.col("n.d").alias("d"))
    there = cores.select(F.col("id").alias("nb"), F.col("core").alias("there"))
    w = F.greatest("core", "there", "d")
    edges = (pair.where("id != nb").join(cores.select("id", "core"), "id").join(there, "nb")
             .select(F.least("id", "nb").alias("a"), F.greatest("id", "nb").alias("b"), w.alias("w")))
    return (edges if cut is None else edges.where(F.col("w") <= cut)).dropDuplicates(["a", "b"])


def _follow(t: pa.Table) -> pa.Table:
    """Merges of one range of edges in ascending order; rows without ``a`` are
    parts with their ``low``.  Kind 0: the part that ``a`` is in at the end;
    kind 1: that part's low; kind 2: an edge that is certain."""
    part = t.filter(pc.is_null(t["a"]))
    low = dict(zip(part["ca"].to_pylist(), part["low"].to_pylist()))
    edge = t.filter(pc.is_valid(t["a"])).sort_by([("w", "ascending"), ("a", "ascending"), ("b", "ascending")])
    up: dict[int, int] = {x: x for x in low}
    sure = []
    for i, (ca, cb, w) in enumerate(zip(*(edge[c].to_pylist() for c in ("ca", "cb", "w")))):
        x, y = _root(up, ca), _root(up, cb)
        if max(low[x], low[y]) >= w:
            sure.append(i)
        x, y = min(x, y), max(x, y)
        up[y] = x
        low[x] = min(low[x], low[y])
    top = [_root(up, x) for x in up]
    last = sorted(set(top))
    sure = edge.take(pa.array(sure, pa.int64()))
    out = [pa.table({"kind": [0] * len(top), "a": list(up), "b": top, "w": [0.0] * len(top)}, schema=_FOLLOWED),
           pa.table({"kind": [1] * len(last), "a": last, "b": last, "w": [low[x] for x in last]}, schema=_FOLLOWED),
           pa.table({"kind": [2] * len(sure), "a": sure["a"], "b": sure["b"], "w": sure["w"]}, schema=_FOLLOWED)]
    return pa.concat_tables(out)


_FOLLOWED = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("w", pa.float64())])


def certain_edges(forest: DataFrame, lows: DataFrame, size: int | None = None) -> DataFrame:
    """Edges of the spanning ``forest`` (a, b, w) of the listed edges that are
    in the tree of all points: where two parts meet, the lists of one of
    them, of which the shortest ends at ``low``, reach as far as the edge.
    ``lows``: (id, low).  The edges are followed in ranges of about ``size``,
    one bounded task each; edges of one weight may be taken in any order."""
    size = RANGE if size is None else size
    rounds = Rounds(forest.sparkSession, "certain")
    if forest.count() <= size:
        ranked = forest.withColumn("r", F.lit(0))
    else:  # by place in the order, so that edges of one weight do not fill a range
        placed = rounds.put("placed", forest.orderBy("w", "a", "b").withColumn("at", F.monotonically_increasing_id()))
        part = F.shiftright("at", 33)
        held, before = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)), F.min("at")).orderBy("part").collect(), 0
        starts = []   # one row per partition
        for p, k, first in held:
            starts.append((p, before - first))
            before += k
        starts = forest.sparkSession.createDataFrame(starts, "part long, shift long")
        ranked = placed.withColumn("part", part).join(F.broadcast(starts), "part").select(
            "a", "b", "w", F.floor((F.col("at") + F.col("shift")) / size).cast("int").alias("r"))
    where, sure = lows.select("id", F.col("id").alias("c")), []
    low = lows.select(F.col("id").alias("ca"), "low")
    ranges = [r["r"] for r in ranked.select("r").distinct().orderBy("r").collect()]  # one per range
    for r in ranges:
        edges = rounds.put("joined", ranked.where(F.col("r") == r)
                           .join(where.select(F.col("id").alias("a"), F.col("c").alias("ca")), "a")
                           .join(where.select(F.col("id").alias("b"), F.col("c").alias("cb")), "b")
                           .select("a", "b", "w", "ca", "cb"))
        touched = edges.select("ca").union(edges.select("cb")).distinct()
        rows = edges.withColumn("low", F.lit(None).cast("double")).unionByName(
            low.join(touched, "ca"), allowMissingColumns=True)
        found = rounds.put("found", _in_one_task(rows, _follow, "kind int, a long, b long, w double"))
        sure.append(rounds.put("sure", found.where("kind = 2").select("a", "b", "w")))
        if r != ranges[-1]:
            moved = found.where("kind = 0").select(F.col("a").alias("c"), F.col("b").alias("into"))
            where = rounds.put("where", where.join(moved, "c", "left").select("id", F.coalesce("into", "c").alias("c")))
            low = rounds.put("low", low.join(moved.select(F.col("c").alias("ca")), "ca", "left_anti").unionByName(
                found.where("kind = 1").select(F.col("a").alias("ca"), F.col("w").alias("low"))))
            rounds.drop("where", "low")
        rounds.drop("joined", "found")
    out = sure[0] if sure else forest.select("a", "b", "w")
    for x in sure[1:]:
        out = out.unionByName(x)
    return out


def lightest(a: np.ndarray, b: np.ndarray, a_core: np.ndarray, b_core: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray,
             a_part: np.ndarray, b_part: np.ndarray, limit: np.ndarray):
    """(part, a, b, w): for each part of the points ``a`` its lightest edge to a
    point of ``b`` of another part, at most ``limit``, by (w, a, b).  A matrix
    product bounds the distances; what the bounds leave is measured exactly."""
    parts, of = np.unique(a_part, return_inverse=True)
    most = np.full(len(parts), np.inf)   # no lightest edge of the part is over the root of this
    x, y = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    found = []
    with np.errstate(over="ignore"):
        b_floor, a_floor, top = b_core * b_core, a_core * a_core, limit * limit
    for at, square, slack in product_bounds(a, b):
        rows = np.arange(at, at + len(square))
        apart = a_part[rows][:, None] != b_part[None]
        np.maximum(square, b_floor[None], out=square)
        square[~apart] = np.inf
        np.minimum.at(most, of[rows], np.maximum(square.min(1, initial=np.inf), a_floor[rows]) * (1 + 1e-9) + 2 * slack)
        bar = np.minimum(most[of[rows]], top[rows]) * (1 + 1e-9) + 2 * slack
        row, col = np.nonzero((square <= bar[:, None]) & apart)
        row += at
        w = np.maximum(np.maximum(pair_distances(x, y, row, col), a_core[row]), b_core[col])
        ok = np.isfinite(w) & (w <= limit[row])
        row, col, w = row[ok], col[ok], w[ok]
        lo, hi = np.minimum(a_ids[row], b_ids[col]), np.maximum(a_ids[row], b_ids[col])
        order = np.lexsort((hi, lo, w, of[row]))
        first = order[np.unique(of[row][order], return_index=True)[1]]
        found.append((of[row][first], lo[first], hi[first], w[first]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0)
    of, lo, hi, w = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((hi, lo, w, of))
    first = order[np.unique(of[order], return_index=True)[1]]
    return parts[of[first]], lo[first], hi[first], w[first]


def _search(seekers: DataFrame, points: DataFrame, packs: tuple[int, int]) -> DataFrame:
    """``(part, a, b, w)``: lightest edges out of the parts of ``seekers`` (id,
    vec, core, part, most), one per part and pair of packs; ``points``: (id,
    vec, core, part)."""
    left, right = packs
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    s = seekers.select(deal(left).alias("p"), every(right).alias("q"), "id", "vec", "core", "part", "most")
    t = points.select(every(left).alias("p"), deal(right).alias("q"), "id", "vec", "core", "part")

    def meet(g: pa.Table, h: pa.Table) -> pa.Table:
        if not g.num_rows or not h.num_rows:
            return pa.table({"part": [], "a": [], "b": [], "w": []}, schema=_FOUND)
        num = lambda f, c: f.column(c).to_numpy()
        got = lightest(vectors_of(g.column("vec")), vectors_of(h.column("vec")), num(g, "core"), num(h, "core"), num(g, "id"),
                       num(h, "id"), num(g, "part"), num(h, "part"), num(g, "most"))
        return pa.table(dict(zip(("part", "a", "b", "w"), got)), schema=_FOUND)

    return s.groupBy("p", "q").cogroup(t.groupBy("p", "q")).applyInArrow(meet, "part long, a long, b long, w double")


_FOUND = pa.schema([("part", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("w", pa.float64())])


def listed_tree(points: DataFrame, cores: DataFrame, neighbours: DataFrame, listed: int, block_size: int = DEFAULT_BLOCK,
                cut: float | None = None, finish: int | None = None) -> DataFrame:
    """``(a, b, w)``: the minimum spanning tree of ``points`` (id, vec) under
    mutual reachability, with ``cut`` the forest of its edges up to that.
    ``neighbours``: (id, nbrs), the ``listed`` nearest of each point."""
    spark = points.sparkSession
    rounds = Rounds(spark, "listed")
    far = F.when(F.size("nbrs") >= listed, F.element_at("nbrs", listed)["d"]).otherwise(math.inf)
    pts = points.select("id", F.col("vec").cast("array<double>").alias("vec")).join(cores.select("id", "core"), "id")
    if cut is not None:
        pts = pts.where(F.col("core") <= cut)
    pts = rounds.put("points", pts.join(neighbours.select("id", far.alias("far")), "id", "left").select(
        "id", "vec", "core", F.greatest("core", F.coalesce("far", F.lit(math.inf))).alias("low")))
    n = pts.count()
    if n == 0:
        return spark.createDataFrame([], EDGES)
    dim = pts.select(F.max(F.size("vec"))).first()[0]
    size = pack_size(block_size, n, dim)
    edges = minimum_spanning_forest(listed_edges(neighbours, cores, cut), finish)
    lows = pts.groupBy("id").agg(F.min("low").alias("low"))
    tree = rounds.put("tree", certain_edges(edges, lows))
    where = rounds.put("where", connected_components(lows, tree, finish))
    closed = None
    while True:
        held = rounds.put("held", where.groupBy("comp").count())
        if held.count() == 1:
            break
        largest = held.orderBy(F.desc("count"), "comp").first()["comp"]
        ends = lambda c, d: where.select(F.col("id").alias(c), F.col("comp").alias(d))
        open_ = edges.join(ends("a", "ca"), "a").join(ends("b", "cb"), "b").where("ca != cb")
        known = open_.select(F.col("ca").alias("part"), "a", "b", "w").union(open_.select(F.col("cb").alias("part"), "a", "b", "w"))
        known = rounds.put("known", known.groupBy("part").agg(F.min(F.struct("w", F.lit(0).alias("seen"), "a", "b")).alias("m")))
        parts = held.where(F.col("comp") != largest).select(F.col("comp").alias("part"))
        if closed is not None:
            parts = parts.join(closed, "part", "left_anti")
        parts = rounds.put("parts", parts.join(known, "part", "left"))
        every = pts.join(where.withColumnRenamed("comp", "part"), "id")
        most = F.coalesce("m.w", F.lit(math.inf if cut is None else cut))
        seekers = rounds.put("seekers", every.join(parts.select("part", most.alias("most"), F.col("m").isNotNull().alias("has")), "part")
                             .where(F.when(F.col("has"), F.col("low") < F.col("most")).otherwise(F.col("low") <= F.col("most"))))
        sought = seekers.count()
        chosen = parts.where("m is not null").select("part", "m")
        if sought:
            packs = max(1, -(-sought // size)), max(1, -(-n // size))
            got = _search(seekers, every, packs).select("part", F.struct("w", F.lit(1).alias("seen"), "a", "b").alias("m"))
            chosen = chosen.unionByName(got)
        chosen = rounds.put("chosen", chosen.groupBy("part").agg(F.min("m").alias("m")))
        more = rounds.put("more", chosen.select("m.a", "m.b", "m.w").dropDuplicates(["a", "b"]))
        if more.isEmpty():
            break
        # what found nothing has no edge at all, from either side
        ended = parts.select("part").join(chosen, "part", "left_anti")
        closed = rounds.put("closed", ended if closed is None else closed.unionByName(ended))
        joins = more.join(ends("a", "ca"), "a").join(ends("b", "cb"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        moved = edge_components(joins, finish).select(F.col("id").alias("comp"), F.col("comp").alias("into"))
        tree = rounds.put("tree", tree.unionByName(more))
        where = rounds.put("where", where.join(moved, "comp", "left").select("id", F.coalesce("into", "comp").alias("comp")))
        rounds.drop("tree", "where", "held", "known", "parts", "seekers", "chosen", "more", "closed")
    if cut is None:  # distances that are not finite
        roots = held.select("comp")
        first = roots.agg(F.min("comp").alias("a"))
        tree = tree.unionByName(first.join(roots.select(F.col("comp").alias("b")), F.col("a") < F.col("b")).select(
            "a", "b", F.lit(math.inf).alias("w")))
    return tree


def reachability_tree(points: DataFrame, cores: DataFrame, block_size: int = DEFAULT_BLOCK,
                      finish: int | None = None, neighbours: DataFrame | None = None, listed: int = LISTED) -> DataFrame:
    """``(a, b, w)``: the minimum spanning tree of all points under mutual
    reachability ``max(core_a, core_b, distance)``.  ``neighbours``: the
    ``listed`` nearest of each point, as ``knn`` gives them, if they are known."""
    if cores.count() <= SMALL:
        return minimum_spanning_forest(block_forests(points, cores, block_size), finish)
    if neighbours is None:
        neighbours = Rounds(points.sparkSession, "lists").put("near", knn(points, listed, block_size))
    return listed_tree(points, cores, neighbours, listed, block_size, None, finish)
