"""Exact nearest neighbours by pivot cells.

A bounded number of points, taken in order of a hash, are pivots; every point
belongs to the cell of its nearest pivot, and a cell keeps its radius.  Near
cells share a pack of bounded size (a cell of more points has several), the
unit in which points meet.  Points first meet the rest of their own pack,
which bounds how far their ``k``-th neighbour can be.  By the triangle
inequality no point of another cell is nearer than the distance to its pivot
less its radius, so a point goes only to the packs with a cell for which that
is within its bound.  A pack receives its visitors in salted parts, so no
task holds more than two packs whatever the cell, and what leaves one is at
most ``k`` rows per visitor; they are ranked per point with a limit that
applies before the shuffle.

Where distances do not tell points apart (random points of many dimensions)
every point meets every pack: a point is then sent once per ``PACK_POINTS``
points, and the meeting is a matrix product whose bounds leave few pairs to
measure."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsgraph.session import Rounds

MAX_PIVOTS = 1024
DEFAULT_BLOCK = 2048
PACK_POINTS = 1 << 15     # points in a pack at most, unless a block is given as larger
PACK_VALUES = 1 << 21     # coordinates in a pack at most
LEAST_PACKS = 16          # a table of fewer points than that fills has smaller packs
_CHUNK_CELLS = 1 << 16    # distances computed at once: what stays in a core's cache
_PRODUCT_CELLS = 1 << 20  # products computed at once
_GUEST_PACKS = 1          # a task's visitors, in packs
_SLACK = 1e-9             # the bounds are taken this much wider, for rounding


def vectors_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """(n, d) doubles of an Arrow list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def row_distances(columns: np.ndarray, at: int) -> np.ndarray:
    """Distances of all points from one, points being the columns."""
    diff = columns - columns[:, at:at + 1]
    diff *= diff
    return np.sqrt(np.add.reduce(diff, axis=0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact Euclidean distances (no |a|²+|b|²-2ab error), summed over the
    coordinates in order: two points have one distance, bit for bit, from
    either side and from every kernel, so that ties stay ties."""
    out = np.zeros((len(a), len(b)))
    step = max(1, _CHUNK_CELLS // max(len(b), 1))
    x, y = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    for s in range(0, len(a), step):
        part = out[s:s + step]
        diff = np.empty_like(part)
        for j in range(len(x)):
            np.subtract(x[j, s:s + step, None], y[j], out=diff)
            diff *= diff
            part += diff
    return np.sqrt(out, out=out)


def pair_distances(a: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """``distances`` of the stated pairs of points, points being the columns."""
    out = np.zeros(len(row))
    for x, y in zip(a, b):
        diff = x[row] - y[col]
        diff *= diff
        out += diff
    return np.sqrt(out, out=out)


def product_error(dim: int) -> float:
    """How far |a|^2 + |b|^2 - 2ab can be from the exact squared distance, as
    a share of (|a| + |b|)^2; far on the safe side."""
    return 16 * (dim + 8) * float(np.finfo(np.float64).eps)


def closest(a: np.ndarray, b: np.ndarray, ids: np.ndarray, k: int, limit: np.ndarray | None = None,
            same: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``a``, row of ``b``, distance): the ``k`` nearest of ``b`` for
    each of ``a`` (ties by ``ids``), those that are surely beyond ``limit``
    left out.  With ``same`` the two are one table and no row meets itself.

    One matrix product bounds all distances of a chunk; what the bounds leave
    is measured exactly, so the result is that of ``distances``."""
    limit = np.full(len(a), np.inf) if limit is None else limit
    na, nb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    bounded = bool(len(b)) and bool(np.isfinite(na).all() and np.isfinite(nb).all() and max(na.max(initial=0), nb.max()) < 1e300)
    x, y = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    if bounded:
        slack = product_error(a.shape[1]) * (np.sqrt(na) + math.sqrt(nb.max())) ** 2
        wide = np.vstack([y, -nb / 2])  # (a, 1) times this is (|a|^2 - distance^2) / 2
        with np.errstate(over="ignore"):
            need = (na - limit * limit * (1 + _SLACK)) / 2 - slack
    found = []
    step = max(1, _PRODUCT_CELLS // max(len(b), 1))
    for s in range(0, len(a) if len(b) else 0, step):
        part = a[s:s + step]
        if bounded:
            score = np.hstack([part, np.ones((len(part), 1))]) @ wide
            if same:
                score[np.arange(len(part)), s + np.arange(len(part))] = -np.inf
            least = need[s:s + step]
            open_ = np.flatnonzero(np.isneginf(least))
            if len(open_) and k < len(b):
                least = least.copy()
                least[open_] = np.partition(score[open_], len(b) - k, axis=1)[:, len(b) - k] - 2 * slack[s:s + step][open_]
            row, col = np.divmod(np.flatnonzero(score >= least[:, None]), len(b))
        else:
            row, col = np.divmod(np.arange(len(part) * len(b)), len(b))
        if same:
            row, col = row[row + s != col], col[row + s != col]
        row += s
        d = pair_distances(x, y, row, col)
        ok = np.isfinite(d)
        row, col, d = row[ok], col[ok], d[ok]
        order = np.lexsort((ids[col], d, row))
        row, col, d = row[order], col[order], d[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < k
        found.append((row[first], col[first], d[first]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*found))


def _found(visitors: np.ndarray, ids: np.ndarray, weights: np.ndarray, row: np.ndarray, col: np.ndarray,
           d: np.ndarray) -> pa.Table:
    return pa.table({"id": visitors[row], "nb": ids[col], "d": d, "w": weights[col]})


def _pivots(points: DataFrame, n: int) -> np.ndarray:
    most = min(MAX_PIVOTS, max(1, math.isqrt(n)))
    rows = points.select(F.xxhash64("id").alias("h"), "id", F.col("vec").cast("array<double>").alias("vec")).orderBy("h", "id").limit(most).collect()
    return np.array([r["vec"] for r in rows], np.float64)


def pack_size(block_size: int, n: int, dim: int = 64) -> int:
    """Points of ``n`` that are handled as one.  What is sent to each pack is
    sent once per pack, so the packs are as large as a task's memory easily
    holds, but not so few that cores are idle."""
    return max(block_size, min(PACK_POINTS, PACK_VALUES // max(dim, 1), n // LEAST_PACKS))


def product_bounds(a: np.ndarray, b: np.ndarray):
    """(first row, squared distances, slack) of a chunk of the rows of ``a``
    from all of ``b`` at a time: one matrix product each, within ``slack`` of
    the exact squares; zeros if the points are too large for a product."""
    na, nb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    bounded = bool(len(b)) and bool(np.isfinite(na).all() and np.isfinite(nb).all() and max(na.max(initial=0), nb.max()) < 1e300)
    wide = np.vstack([-2 * b.T, nb]) if bounded else None
    step = max(1, _PRODUCT_CELLS // max(len(b), 1))
    for s in range(0, len(a) if len(b) else 0, step):
        part = a[s:s + step]
        if bounded:
            square = np.hstack([part, np.ones((len(part), 1))]) @ wide
            square += na[s:s + step, None]
            yield s, square, product_error(a.shape[1]) * (np.sqrt(na[s:s + step]) + math.sqrt(nb.max())) ** 2
        else:
            yield s, np.zeros((len(part), len(b))), np.full(len(part), np.inf)


def _packs(centre: np.ndarray, held: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first pack, packs) of each cell: near cells share a pack of at most
    ``most`` points, a larger cell has several of its own."""
    d = np.nan_to_num(distances(centre, centre), nan=1e308, posinf=1e308)
    first, parts = np.zeros(len(held), np.int64), -(-held // most)
    made = room = at = 0
    for _ in range(len(held)):
        d[:, at] = np.inf
        if held[at] <= room:
            first[at] = made - 1
            room -= held[at]
        else:
            first[at] = made
            made += parts[at]
            room = most - held[at] if parts[at] == 1 else 0
        at = int(d[at].argmin())
    return first, parts


def placed(points: DataFrame, block_size: int, rounds: Rounds) -> tuple[DataFrame, np.ndarray, tuple]:
    """The points with their cell, their distance from its pivot and their
    pack; the pivots; the cells' (number, points, radius, first pack, packs)."""
    spark = points.sparkSession
    n = points.count()
    pivots = _pivots(points, n)
    sent = spark.sparkContext.broadcast(pivots)

    def run(batches):
        for b in batches:
            if b.num_rows:
                d = distances(vectors_of(b.column("vec")), sent.value)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                    [*b.schema.names, "cell", "far"])

    base = points.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"),
                         F.coalesce("weight", F.lit(1)).cast("long").alias("weight"))
    cells = rounds.put("cells", base.mapInArrow(run, "id long, vec array<double>, weight long, cell int, far double"))
    size = sorted(map(tuple, cells.groupBy("cell").agg(F.count(F.lit(1)), F.max("far")).collect()))  # one row per pivot
    if not size:
        return cells, pivots, ()
    cell, held, radius = (np.array(c) for c in zip(*size))
    first, parts = _packs(pivots[cell], held, pack_size(block_size, n, pivots.shape[1]))
    table = spark.createDataFrame(list(zip(cell.tolist(), first.tolist(), parts.tolist())), "cell int, first int, parts int")
    packed = cells.join(F.broadcast(table), "cell").withColumn(
        "pack", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int")).drop("first", "parts")
    return packed, pivots, (cell, held, radius, first, parts)


def knn(points: DataFrame, k: int, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``(id, nbrs array<struct<d double, nb bigint, w bigint>>)``: the ``k``
    nearest other points of every point (ties by id).  ``points``: ``id
    bigint, vec array<float|double>, weight bigint``.  Points without any
    other point have no row."""
    spark = points.sparkSession
    rounds = Rounds(spark, "knn")
    packed, pivots, size = placed(points, block_size, rounds)
    if not size:
        return spark.createDataFrame([], "id long, nbrs array<struct<d:double,nb:long,w:long>>")
    packed = rounds.put("packs", packed)
    found = "id long, nb long, d double, w long"

    def own(t: pa.Table) -> pa.Table:
        v, ids = vectors_of(t.column("vec")), t.column("id").to_numpy()
        return _found(ids, ids, t.column("weight").to_numpy(), *closest(v, v, ids, k, same=True))

    inner = rounds.put("inner", packed.groupBy("pack").applyInArrow(own, found))
    bound = inner.groupBy("id").agg(F.max("d").alias("bound"), F.count(F.lit(1)).alias("near"))
    sent = spark.sparkContext.broadcast((pivots[size[0]], *size))

    def send(batches):
        centre, cells, held, radius, first, parts = sent.value
        # the packs of each cell, cell after cell
        of = np.repeat(np.arange(len(cells)), parts)
        pack = np.repeat(first, parts) + np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        for b in batches:
            if not b.num_rows:
                continue
            d = distances(vectors_of(b.column("vec")), centre)
            home = np.searchsorted(cells, b.column("cell").to_numpy())
            # so many points are within reach of a cell's far side, itself left out
            far = d + radius
            order = np.argsort(far, axis=1)
            count = held[order] - (order == home[:, None])
            reach = np.cumsum(count, axis=1) >= k
            loose = np.where(reach.any(1), np.take_along_axis(far, order, 1)[np.arange(len(d)), reach.argmax(1)], np.inf)
            tight = b.column("bound").fill_null(np.inf).to_numpy(zero_copy_only=False)
            near = b.column("near").fill_null(0).to_numpy(zero_copy_only=False)
            most = np.minimum(loose, np.where(near >= k, tight, np.inf)) * (1 + _SLACK) + _SLACK
            there = np.zeros((len(d), int(pack.max()) + 1), bool)
            row, at = np.nonzero((d - radius <= most[:, None])[:, of])
            there[row, pack[at]] = True
            there[np.arange(len(d)), b.column("pack").to_numpy()] = False
            row, to = np.nonzero(there)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(row)), pa.array(to.astype(np.int32)), pa.array(most[row])],
                ["id", "pack", "most"])

    visits = rounds.put("visits", packed.join(bound, "id", "left").mapInArrow(send, "id long, pack int, most double"))
    salts = visits.groupBy("pack").agg(F.ceil(F.count(F.lit(1)) / (_GUEST_PACKS * pack_size(block_size, int(size[1].sum()), pivots.shape[1]))).cast("int").alias("salts"))
    key = ["pack", "salt"]
    guests = (visits.join(salts, "pack").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
              .select(*key, "id", "most").join(packed.select("id", "vec"), "id")
              .select(*[F.col(c).alias(f"g_{c}") for c in (*key, "id", "most", "vec")]))
    hosts = (packed.join(salts, "pack").select(
        "pack", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "id", "vec", "weight"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, weights = right.column("id").to_numpy(), right.column("weight").to_numpy()
        if not left.num_rows or not right.num_rows:
            none = np.zeros(0, np.int64)
            return _found(none, none, none, none, none, np.zeros(0))
        got = closest(vectors_of(left.column("g_vec")), vectors_of(right.column("vec")), ids, k, left.column("g_most").to_numpy())
        return _found(left.column("g_id").to_numpy(), ids, weights, *got)

    outer = guests.groupBy(*[f"g_{c}" for c in key]).cogroup(hosts.groupBy(*key)).applyInArrow(meet, found)
    rank = F.row_number().over(Window.partitionBy("id").orderBy("d", "nb"))
    best = inner.unionByName(outer).withColumn("_r", rank).where(F.col("_r") <= k)
    return best.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("d", "nb", "w"))).alias("nbrs"))
