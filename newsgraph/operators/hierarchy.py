"""Condensed cluster hierarchy of a spanning tree, and the choice of clusters
by stability.

Components grow as the tree's edges are taken in ascending order; edges of
equal weight act at once.  A part is *large* if its weight reaches the least
cluster size.  Where large parts meet, their clusters end and a new one begins;
a cluster that only takes in small parts goes on.  With level(x) = 1 / distance,
a cluster's stability sums level(leaving) - level(birth) over its copies, and
one that is at least as stable as the best choice below it is selected instead
of that.  The last cluster, which holds everything, is never selected.

All a component carries upwards is a few numbers (size, level-weighted
leavings, the best choice below its open cluster), so the edges are handled in
ranges of ascending weight, about ``RANGE`` edges each: one bounded task per
range joins the states of the components it touches and emits the new states,
and a pointer from every point or cluster that ended to the cluster it is in,
with the outermost selected one on the way.  A single weight with more edges
than a range is a range of its own, taken by connected components and grouped
sums.  At the end the pointers, a chain no longer than the number of ranges,
are joined by jumping."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.operators.forest import connected_components
from newsgraph.session import Rounds

RANGE = 1 << 17
_STATE = "comp long, size long, level double, large boolean, g int, k long, left double, below double"
_OUT = "kind int, comp long, size long, level double, large boolean, g int, k long, left double, below double, pg int, pk long, sg int, sk long"
_NONE = -1   # generation of "no node"


def _inverse(d: float) -> float:
    return math.inf if d == 0 else 1.0 / d


class _Range:
    """The merges of one range of edges; nodes are (generation, number), the
    points' own being (0, id)."""

    def __init__(self, generation: int, least: int):
        self.generation, self.least, self.made = generation, least, 0
        self.up: dict = {}       # a node that ended -> (its cluster, was it selected)

    def new(self):
        self.made += 1
        return self.generation, self.made

    def merge(self, parts: list[dict], d: float) -> dict:
        """The component that ``parts`` form at distance ``d``."""
        level = _inverse(d)
        large = [p for p in parts if p["large"] and p["level"] < d]
        small = [p for p in parts if not (p["large"] and p["level"] < d)]
        size = sum(p["size"] for p in parts)
        out = {"comp": min(p["comp"] for p in parts), "size": size, "level": d, "large": size >= self.least}
        if not out["large"]:
            out |= {"node": self.new(), "left": 0.0, "below": -math.inf}
        elif len(large) == 1:
            gone = size - large[0]["size"]
            out |= {"node": large[0]["node"], "left": large[0]["left"] + level * gone, "below": large[0]["below"]}
        else:
            below = -math.inf
            for p in large:
                own = p["left"] - level * p["size"]
                chosen = own >= p["below"]
                p["chosen"] = chosen
                best = own if chosen else p["below"]
                below = best if below == -math.inf else below + best
            out |= {"node": self.new(), "left": level * size, "below": below}
        for p in (*small, *(large if len(large) != 1 else ())):
            self.up[p["node"]] = (out["node"], p.get("chosen", False))
        return out

    def pointers(self):
        """(node, outermost cluster reached in this range, outermost selected
        one from the node on) of every node that ended and was known before."""
        found: dict = {}
        for node in self.up:
            path, at = [], node
            while at in self.up and at not in found:
                path.append(at)
                at = self.up[at][0]
            top, chosen = found.get(at, (at, None))
            for x in reversed(path):
                if chosen is None and self.up[x][1]:
                    chosen = x
                found[x] = (top, chosen)
        return [(n, *found[n]) for n in self.up if n[0] != self.generation]


def _walk(t: pa.Table, generation: int, least: int) -> pa.Table:
    """One range: rows with ``a`` are edges between components, the others
    states."""
    rows = t.to_pylist()
    state = {r["comp"]: r | {"node": (r["g"], r["k"])} for r in rows if r["a"] is None}
    edges = sorted(((r["w"], r["a"], r["b"]) for r in rows if r["a"] is not None))
    run = _Range(generation, least)
    up: dict[int, int] = {}

    def root(x):
        top = x
        while up.get(top, top) != top:
            top = up[top]
        while up.get(x, x) != top:
            up[x], x = top, up[x]
        return top

    at = 0
    while at < len(edges):
        to = at
        while to < len(edges) and edges[to][0] == edges[at][0]:
            to += 1
        meets: dict[int, set] = {}   # of this distance: smallest component -> those that meet
        for _, a, b in edges[at:to]:
            x, y = root(a), root(b)
            if x == y:
                continue
            x, y = min(x, y), max(x, y)
            up[y] = x
            meets[x] = meets.get(x, {x}) | meets.pop(y, {y})
        for x, members in meets.items():
            state[x] = run.merge([state[m] for m in sorted(members)], edges[at][0]) if len(members) > 1 else state[x]
            for m in members - {x}:
                del state[m]
        at = to
    out = []
    nothing = (_NONE, 0)
    for r in rows:
        if r["a"] is None:  # kind 0: where a component went
            out.append((0, r["comp"], None, None, None, None, root(r["comp"]), None, None, None, None, None, None))
    for s in state.values():
        out.append((1, s["comp"], s["size"], s["level"], s["large"], *s["node"], s["left"], s["below"], None, None, None, None))
    for node, top, chosen in run.pointers():
        out.append((2, None, None, None, None, *node, None, None, *top, *(chosen or nothing)))
    cols = list(zip(*out))
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int32(), pa.int64(), pa.float64(), pa.float64(),
             pa.int32(), pa.int64(), pa.int32(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=[c.split()[0] for c in _OUT.split(", ")])


def _walker(generation: int, least: int):
    return lambda t: _walk(t.drop_columns(["_all"]), generation, least)


def _one_level(joined: DataFrame, states: DataFrame, d: float, generation: int, least: int) -> DataFrame:
    """A range whose edges have one weight, of any number: the components that
    meet are found by joins and merged by grouped sums.  Rows as ``_walk``'s."""
    level = F.lit(_inverse(d))
    meet = connected_components(states.select(F.col("comp").alias("id")), joined.select("a", "b")).select(
        F.col("id").alias("comp"), F.col("comp").alias("into"))
    s = states.join(meet, "comp").withColumn("big", F.col("large") & (F.col("level") < d))
    own = F.col("left") - level * F.col("size")
    s = s.withColumn("chosen", F.col("big") & (own >= F.col("below"))).withColumn(
        "best", F.when(F.col("big"), F.greatest(own, F.col("below"))))
    total = s.groupBy("into").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("members"), F.sum(F.col("big").cast("int")).alias("bigs"),
        F.max(F.when(F.col("big"), F.struct("size", "left", "below", "g", "k"))).alias("one"), F.sum("best").alias("sum"))
    new = F.struct(F.lit(generation).alias("g"), F.col("into").alias("k"))
    total = total.withColumn("goes_on", F.col("bigs") == 1).withColumn(
        "node", F.when(F.col("goes_on"), F.struct(F.col("one.g").alias("g"), F.col("one.k").alias("k"))).otherwise(new))
    merged = total.where("members > 1")
    none = lambda kind: F.lit(None).cast(kind)
    away = s.select(F.lit(0).alias("kind"), "comp", none("long").alias("size"), none("double").alias("level"),
                    none("boolean").alias("large"), none("int").alias("g"), F.col("into").alias("k"), none("double").alias("left"),
                    none("double").alias("below"), none("int").alias("pg"), none("long").alias("pk"), none("int").alias("sg"), none("long").alias("sk"))
    is_large = F.col("size") >= least
    after = merged.select(
        F.lit(1).alias("kind"), F.col("into").alias("comp"), "size", F.lit(d).alias("level"), is_large.alias("large"), "node.g", "node.k",
        F.when(~is_large, 0.0).when(F.col("goes_on"), F.col("one.left") + level * (F.col("size") - F.col("one.size")))
        .otherwise(level * F.col("size")).alias("left"),
        F.when(F.col("goes_on"), F.col("one.below")).otherwise(F.coalesce("sum", F.lit(-math.inf))).alias("below"),
        none("int").alias("pg"), none("long").alias("pk"), none("int").alias("sg"), none("long").alias("sk"))
    ended = (s.join(merged.select("into", "node", "goes_on"), "into").where("not (big and goes_on)")
             .select(F.lit(2).alias("kind"), none("long").alias("comp"), none("long").alias("size"), none("double").alias("level"),
                     none("boolean").alias("large"), "g", "k", none("double").alias("left"), none("double").alias("below"),
                     F.col("node.g").alias("pg"), F.col("node.k").alias("pk"),
                     F.when(F.col("chosen"), F.col("g")).otherwise(_NONE).alias("sg"),
                     F.when(F.col("chosen"), F.col("k")).otherwise(F.lit(0)).cast("long").alias("sk")))
    return away.unionByName(after).unionByName(ended)


def _ranges(tree: DataFrame, size: int) -> list[tuple[float, float]]:
    """(lowest, highest] weights of ranges of about ``size`` edges; a weight
    with more edges than that is alone in its range."""
    n = tree.count()
    if n == 0:
        return []
    if n <= size:
        return [(-1.0, math.inf)]
    parts = -(-n // size)
    edges = tree.select("w")
    cuts = sorted(set(edges.approxQuantile("w", [i / parts for i in range(1, parts)], 1 / (4 * parts))))
    bounds = [-1.0, *cuts, math.inf]
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        part = edges.where((F.col("w") > lo) & (F.col("w") <= hi))
        low, high, k = part.agg(F.min("w"), F.max("w"), F.count(F.lit(1))).first()
        if k > 2 * size and low < high:  # one weight fills the quantiles: it gets a range of its own
            heavy = part.groupBy("w").count().where(F.col("count") > size).orderBy("w").select("w").collect()  # few: each has over size edges
            for (w,) in heavy:
                below = float(np.nextafter(w, -math.inf))
                out += [(lo, below), (below, w)]
                lo = w
        out.append((lo, hi))
    return [r for r in out if r[0] < r[1]]


def condense(nodes: DataFrame, tree: DataFrame, least: int, size: int | None = None) -> DataFrame:
    """``(id, cluster)`` for ``nodes`` (id, weight, core) and the spanning
    tree ``tree`` (a, b, w): the smallest id of the selected cluster, -1 for
    points in none."""
    size = RANGE if size is None else size
    spark = nodes.sparkSession
    rounds = Rounds(spark, "hierarchy")
    lone = F.col("weight") >= least   # a point of so many copies is a cluster from its core distance on
    below = F.when(F.col("core") == 0, F.lit(math.inf)).otherwise(1.0 / F.col("core"))
    state = rounds.put("state", nodes.select(
        F.col("id").alias("comp"), F.col("weight").alias("size"), F.when(lone, F.col("core")).otherwise(-1.0).alias("level"),
        lone.alias("large"), F.lit(0).alias("g"), F.col("id").alias("k"),
        F.when(lone, F.col("weight") * below).otherwise(0.0).alias("left"), F.lit(-math.inf).alias("below")))
    where = state.select(F.col("comp").alias("id"), "comp")
    ranges = _ranges(tree, size)
    pointers = []
    for generation, (lo, hi) in enumerate(ranges, 1):
        edges = tree.where((F.col("w") > lo) & (F.col("w") <= hi))
        left, right = where.select(F.col("id").alias("a"), F.col("comp").alias("ca")), where.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
        joined = rounds.put("joined", edges.join(left, "a").join(right, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"), "w"))
        touched = joined.select(F.col("a").alias("comp")).union(joined.select(F.col("b").alias("comp"))).distinct()
        states = state.join(touched, "comp")
        low, high, k = joined.agg(F.min("w"), F.max("w"), F.count(F.lit(1))).first()
        if k > 2 * size and low == high:
            found = _one_level(joined, rounds.put("states", states), low, generation, least)
        else:
            rows = states.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("a", "long"), ("b", "long"), ("w", "double"))]).unionByName(
                joined, allowMissingColumns=True).withColumn("_all", F.lit(0))
            found = rows.groupBy("_all").applyInArrow(_walker(generation, least), _OUT)
        found = rounds.put("found", found)
        pointers.append(rounds.put("pointers", found.where("kind = 2").select("g", "k", "pg", "pk", "sg", "sk")))
        if generation < len(ranges):
            moved = found.where("kind = 0").select("comp", F.col("k").alias("into"))
            where = rounds.put("where", where.join(moved, "comp", "left").select("id", F.coalesce("into", "comp").alias("comp")))
            state = rounds.put("state", state.join(moved, "comp", "left_anti").unionByName(
                found.where("kind = 1").select(*[c.split()[0] for c in _STATE.split(", ")])))
            rounds.drop("state", "where")
        rounds.drop("joined", "states", "found")
    if not pointers:
        return nodes.select("id", F.lit(-1).cast("long").alias("cluster"))
    up = pointers[0]
    for p in pointers[1:]:
        up = up.unionByName(p)
    if len(ranges) > 1:
        up = rounds.put("up", up)
    for _ in range(math.ceil(math.log2(max(len(ranges), 1)))):
        far = up.select(F.col("g").alias("pg"), F.col("k").alias("pk"), F.col("pg").alias("g2"), F.col("pk").alias("k2"),
                        F.col("sg").alias("sg2"), F.col("sk").alias("sk2"))
        outer = F.coalesce("sg2", F.lit(_NONE)) != _NONE
        up = rounds.put("up", up.join(far, ["pg", "pk"], "left").select(
            "g", "k", F.coalesce("g2", "pg").alias("pg"), F.coalesce("k2", "pk").alias("pk"),
            F.when(outer, F.col("sg2")).otherwise(F.col("sg")).alias("sg"),
            F.when(outer, F.col("sk2")).otherwise(F.col("sk")).alias("sk")))
        rounds.drop("up")
    own = nodes.select("id").join(up.where("g = 0").select(F.col("k").alias("id"), "sg", "sk"), "id", "left").withColumn(
        "sg", F.coalesce("sg", F.lit(_NONE)))
    own = rounds.put("own", own)
    names = own.where(F.col("sg") != _NONE).groupBy("sg", "sk").agg(F.min("id").alias("cluster"))
    return own.join(names, ["sg", "sk"], "left").select("id", F.coalesce("cluster", F.lit(-1)).cast("long").alias("cluster"))
