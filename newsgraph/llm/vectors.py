"""Near-duplicate embeddings: PCA-ordered tiled comparison.

Distinct unit vectors are rotated into the principal axes of the table, so
that leading coordinates carry most of a product, and ordered by the first
of them into tiles.  A pair of tiles is skipped if the first coordinate
alone keeps all its cosines under the threshold.  Otherwise the products
are accumulated over the leading coordinates first: what the rest can add
is at most the product of the two suffix norms, and a pair whose sum cannot
reach the threshold stops there.  Tiles meet in packs of bounded size: a
tile is sent once per pack, not once per tile.  A pair of packs returns link
counts per vector and a spanning forest of its links, never the links
themselves, so a group of near copies stays small.

Edge cases: vectors that are null, empty, zero, of another length than most
or hold null or non-finite components link with nothing; equal vectors are
compared once and counted as often as they occur; rows that repeat a vec_id
are versions of one vector in the components; a row with a null vec_id
links with nothing and has no component (null), it is kept; other columns
are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.llm import common as C

COSINE = 0.9
TILE = 2048           # vectors per tile
PACK_BYTES = 8 << 20  # vectors of the tiles that are sent together
LEAST_PACKS = 16      # a table of fewer bytes than that fills has smaller packs
CHUNKS = 64           # most ranges of the first coordinate in which tiles are cut
STEP = 16             # coordinates accumulated at a time
SLACK = 1e-9          # rounding of the partial sums


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision without overflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def distinct_vectors(df: DataFrame) -> DataFrame:
    """(cid, rep, m, v): the distinct comparable vectors, the smallest
    vec_id that has each and how many rows do."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = F.col("embedding")
    good = (df.select(F.col("vec_id").cast("long").alias("vec_id"), v).where("vec_id is not null")
            .where(F.forall(v, number) & F.exists(v, lambda x: x != 0)))
    length = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        length = {"d": 1}
    return (good.where(F.size("embedding") == length["d"]).groupBy("embedding")
            .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"))
            .select(F.xxhash64("embedding").alias("cid"), "rep", "m", F.col("embedding").alias("v")))


def principal_axes(vectors: DataFrame, d: int) -> np.ndarray:
    """(d, d) rotation, most telling axis first, from the second moments of
    the unit vectors (summed per partition, then by a grouped sum)."""
    def moments(batches):
        total = np.zeros((d, d))
        for b in batches:
            if b.num_rows:
                u = unit(_matrix(b.column("v"), d))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d * d, dtype=np.int32)), pa.array(total.ravel())], ["i", "x"])

    sums = vectors.select("v").mapInArrow(moments, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
    total = np.zeros(d * d)
    total[sums["i"]] = sums["x"]
    values, axes = np.linalg.eigh(total.reshape(d, d))
    return axes[:, np.argsort(-values, kind="stable")]


def tiles(vectors: DataFrame, axes: np.ndarray, d: int, name: str) -> DataFrame:
    """(tile, lo, hi, ids, rows): tiles in order of the first coordinate."""
    def first(b: pa.RecordBatch):
        yield b.append_column("x", pa.array(unit(_matrix(b.column("v"), d)) @ axes[:, 0]))

    placed = C.keep(C.map_arrow(vectors, first, T.StructType(
        [*vectors.schema.fields, T.StructField("x", T.DoubleType())])), f"{name}-placed")
    # ranges of several tiles each, as the last tile of a range is not full
    n = max(1, min(CHUNKS, placed.count() // (8 * TILE)))
    cuts = sorted(set(placed.approxQuantile("x", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []
    chunk = F.lit(0)
    for c in cuts:  # at most CHUNKS of them
        chunk = chunk + (F.col("x") > c).cast("int")
    placed = placed.withColumn("chunk", chunk)
    counts = {r["chunk"]: r["count"] for r in placed.groupBy("chunk").count().collect()}
    base, at = {}, 0
    for c in sorted(counts):
        base[c], at = at, at + -(-counts[c] // TILE)
    start = F.element_at(F.create_map(*[F.lit(x) for c in sorted(base) for x in (c, base[c])]), F.col("chunk"))
    rank = F.row_number().over(Window.partitionBy("chunk").orderBy("x", "cid")) - 1
    numbered = placed.withColumn("tile", start + F.floor(rank / TILE).cast("int"))
    vector_type = np.float32 if dict(vectors.dtypes)["v"] == "array<float>" else np.float64

    def pack(t: pa.Table) -> pa.Table:
        x = t["x"].to_numpy()
        rows = t["v"].combine_chunks().flatten().to_numpy().astype(vector_type)
        return pa.table({"tile": t["tile"].slice(0, 1).cast(pa.int32()), "lo": [x.min()], "hi": [x.max()],
                         "cid": pa.array([t["cid"].to_numpy().tobytes()], pa.binary()),
                         "rep": pa.array([t["rep"].to_numpy().tobytes()], pa.binary()),
                         "m": pa.array([t["m"].to_numpy().tobytes()], pa.binary()),
                         "rows": pa.array([rows.tobytes()], pa.binary())})

    return C.keep(numbered.groupBy("tile").applyInArrow(
        pack, "tile int, lo double, hi double, cid binary, rep binary, m binary, rows binary"), f"{name}-tiles")


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of rotated unit rows with cosine >= threshold (i < j
    within one tile)."""
    d = a.shape[1]
    rest_a = np.sqrt(np.maximum(np.cumsum((a * a)[:, ::-1], 1)[:, ::-1], 0))
    rest_b = np.sqrt(np.maximum(np.cumsum((b * b)[:, ::-1], 1)[:, ::-1], 0))
    k = min(STEP, d)
    part = a[:, :k] @ b[:, :k].T
    most = part if k == d else part + np.outer(rest_a[:, k], rest_b[:, k])
    i, j = np.nonzero(most >= threshold - SLACK)
    if same:
        i, j = i[i < j], j[i < j]
    s = part[i, j]
    while k < d:
        z = min(k + STEP, d)
        out = np.empty(len(s))
        for lo in range(0, len(s), 1 << 16):  # gathered rows at a time
            p = slice(lo, lo + (1 << 16))
            out[p] = np.einsum("ij,ij->i", a[i[p], k:z], b[j[p], k:z])
        s, k = s + out, z
        reach = s if k == d else s + rest_a[i, k] * rest_b[j, k]
        alive = reach >= threshold - SLACK
        i, j, s = i[alive], j[alive], s[alive]
    return i, j


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that join the same nodes of 0..n-1 as the pairs."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def pack_tiles(tiles_held: int, row_bytes: int) -> int:
    """Tiles that are sent as one.  A tile is sent once per pack, so packs are
    as large as a task easily holds, but not so few that cores are idle."""
    return max(1, min(PACK_BYTES // (TILE * row_bytes), tiles_held // LEAST_PACKS))


def meetings(blocks: DataFrame, size: int, reach: float) -> DataFrame:
    """(pa, pb, tile columns): the tiles of each two packs of ``size`` tiles
    that have vectors within ``reach`` on the first axis."""
    packed = blocks.withColumn("pack", F.floor(F.col("tile") / size).cast("int"))
    meta = packed.groupBy("pack").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    pairs = (meta.select(F.col("pack").alias("pa"), F.col("hi").alias("from"))
             .join(meta.select(F.col("pack").alias("pb"), F.col("lo").alias("to")), F.col("pa") <= F.col("pb"))
             .where(F.col("to") - F.col("from") <= reach).select("pa", "pb"))
    sides = pairs.withColumn("pack", F.col("pa")).unionByName(pairs.where("pa != pb").withColumn("pack", F.col("pb")))
    return packed.join(F.broadcast(sides), "pack").drop("pack")  # two numbers per pair of packs


def links(blocks: DataFrame, axes: np.ndarray, d: int, threshold: float, vector_type) -> DataFrame:
    """(kind, a, b): kind 0 rows are link counts b of class a, kind 1 rows
    edges of spanning forests between representatives."""
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6   # unit vectors further apart on any axis do not link
    size = pack_tiles(blocks.count(), d * np.dtype(vector_type).itemsize)

    def compare(t: pa.Table) -> pa.Table:
        rows = sorted(t.select(["tile", "lo", "hi"]).to_pylist(), key=lambda r: r["tile"])
        at = np.argsort(t.column("tile").to_numpy())
        read = lambda c, kind: [np.frombuffer(t.column(c)[i].as_py(), kind) for i in at.tolist()]
        ids, reps, copies = (read(c, np.int64) for c in ("cid", "rep", "m"))
        units = [unit(x.reshape(-1, d)) for x in read("rows", vector_type)]
        turned = [u @ axes for u in units]
        start = np.cumsum([0, *[len(x) for x in ids]])
        pack = [r["tile"] // size for r in rows]
        counts, nodes, roots = np.zeros(start[-1], np.int64), [], []
        for x in range(len(rows)):
            for y in range(x, len(rows)):
                # two tiles of one pack meet where the pack meets itself
                if (pack[x] == pack[y]) != (pack[0] == pack[-1]) or rows[y]["lo"] - rows[x]["hi"] > reach:
                    continue
                i, j = linked_pairs(turned[x], turned[y], threshold, x == y)
                # rotated sums are rounded: settle the ones next to the threshold by the plain product
                s = np.empty(len(i))
                for lo in range(0, len(i), 1 << 16):
                    p = slice(lo, lo + (1 << 16))
                    s[p] = np.einsum("ij,ij->i", units[x][i[p]], units[y][j[p]])
                i, j = i[s >= threshold], j[s >= threshold]
                if not len(i):
                    continue
                counts[start[x]:start[x + 1]] += np.bincount(i, weights=copies[y][j], minlength=len(ids[x])).astype(np.int64)
                counts[start[y]:start[y + 1]] += np.bincount(j, weights=copies[x][i], minlength=len(ids[y])).astype(np.int64)
                i, j = start[x] + i, start[y] + j
                held, of = np.unique(np.concatenate([i, j]), return_inverse=True)
                node, root = forest(of[:len(i)], of[len(i):], len(held))
                nodes.append(held[node]), roots.append(held[root])
        rep, cid = np.concatenate(reps), np.concatenate(ids)
        node, root = forest(np.concatenate(nodes), np.concatenate(roots), len(rep)) if nodes else (np.zeros(0, np.int64),) * 2
        some = np.flatnonzero(counts)
        return pa.table({"kind": np.repeat(np.array([0, 1], np.int32), [len(some), len(node)]),
                         "a": np.concatenate([cid[some], rep[node]]), "b": np.concatenate([counts[some], rep[root]])})

    # packs are small beside the work on them: their pairs are spread, not coalesced by size
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = meetings(blocks, size, reach).repartition(parts, "pa", "pb")
    return C.keep(both.groupBy("pa", "pb").applyInArrow(compare, "kind int, a long, b long"), "vec-links")


def near_vectors(df: DataFrame, threshold: float = COSINE) -> DataFrame:
    """(vec_id, embedding key cid, n_links, component_id) of the comparable
    vectors, per distinct vector: (cid, v, m, n_links, component_id)."""
    C.use_small_batches(df.sparkSession, 4096)
    vectors = C.keep(distinct_vectors(df), "vec-distinct")
    head = vectors.select(F.size("v").alias("d")).first()
    d = head["d"] if head else 1
    if head is None:
        return vectors.select("cid", "v", "m", F.lit(0).cast("long").alias("n_links"), F.col("rep").alias("component_id"))
    axes = principal_axes(vectors, d)
    blocks = tiles(vectors, axes, d, "vec")
    vector_type = np.float32 if dict(vectors.dtypes)["v"] == "array<float>" else np.float64
    found = links(blocks, axes, d, threshold, vector_type)
    counts = found.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("n"))
    root = C.components(found.where("kind = 1"), name="vec-cc")
    return (vectors.join(counts, "cid", "left").join(root.withColumnRenamed("node", "rep"), "rep", "left")
            .select("cid", "v", "m", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                    F.coalesce("root", "rep").alias("component_id")))


def op2(df: DataFrame) -> DataFrame:
    """The registered query: vec_id, n_links, component_id, kept."""
    per = C.keep(near_vectors(df).select(F.col("v").alias("u"), "n_links", "component_id"), "vec-result")
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    # a hot vector's rows are one key of this join, which AQE splits
    out = rows.join(per, (rows["embedding"] == per["u"]) & rows["vec_id"].isNotNull(), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
