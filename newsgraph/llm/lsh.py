"""From band keys to classes: candidate pairs, exact verification, links.

Every pair of items that shares a band is either verified or already in one
class, without emitting all pairs of a bucket: each bucket first verifies
its members against one leader; only members left outside the bucket's main
class are then compared with the members of other classes, each two of them
once whatever the number of buckets they share, and of those pairs only the
ones that an exact bound lets through.

The bound: a mark sets one of 1024 bits per element, so each bit that A has
and B lacks stands for at least one element of A outside B, of weight one or
more.  With a the share of A's weight outside B and b that of B's outside A,
the similarity is at most ((1 - a) / (1 + a) + (1 - b) / (1 + b)) / 2: its
i-th term 1 / sum_j max(p_j / p_i, q_j / q_i) is at most 1 / (1 / p_i + b / q_i)
and 1 / (1 / q_i + a / p_i), hence at most the mean of p_i / (1 + a) and
q_i / (1 + b)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsgraph.llm import common as C

SETS = "id long, h binary, c binary"
MARK_WORDS = 16
MARKS = "bits array<long>, weight long"


def marks(rows: np.ndarray, h: np.ndarray, count: np.ndarray, n: int) -> list[pa.Array]:
    """The MARKS columns of n sets given as (row, hash, count)."""
    bits = np.zeros((n, MARK_WORDS), C.U64)
    x = C.mix64(h + C.U64(77))
    np.bitwise_or.at(bits, (rows, (x & C.U64(MARK_WORDS - 1)).astype(np.int64)), C.U64(1) << (x >> C.U64(58)))
    weight = np.bincount(rows, weights=count, minlength=n).astype(np.int64)
    return [C.list_of(bits.view(np.int64).ravel(), np.full(n, MARK_WORDS)), pa.array(weight)]


def _marked(marked: DataFrame) -> DataFrame:
    """Marks as plain columns: the words, how many bits are set, the weight."""
    words = [F.col("bits")[i].alias(f"w{i}") for i in range(MARK_WORDS)]
    ones = sum((F.bit_count(F.col("bits")[i]) for i in range(1, MARK_WORDS)), F.bit_count(F.col("bits")[0]))
    return marked.select("id", *words, ones.alias("ones"), "weight")


def _may_link(threshold: float):
    """The bound as a join condition between sides l and r; with both = the
    bits they share it reads 1 / (1 + a) + 1 / (1 + b) >= 1 + threshold."""
    share = [F.bit_count(F.col(f"l.w{i}").bitwiseAND(F.col(f"r.w{i}"))) for i in range(MARK_WORDS)]
    both = sum(share[1:], share[0])
    part = lambda s: F.col(f"{s}.weight") / (F.col(f"{s}.weight") + F.col(f"{s}.ones") - both)
    return part("l") + part("r") >= 1 + threshold - 1e-9


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """(items, bands) 64-bit keys of an (items, bands * rows) signature."""
    n, k = signature.shape
    parts = signature.reshape(n, k // rows, rows).astype(C.U64)
    key = np.broadcast_to(np.arange(1, k // rows + 1, dtype=C.U64), (n, k // rows)).copy()
    for j in range(rows):
        key = C.mix64(key * C.U64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key.view(np.int64)


def pack_sets(ids: pa.Array, rows: np.ndarray, h: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """One row per item: its sorted shingle hashes and their counts as bytes."""
    edge = np.searchsorted(rows, np.arange(len(ids) + 1))
    counts = count.astype(np.uint32)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([h[a:b].tobytes() for a, b in zip(edge, edge[1:])], pa.binary()),
         pa.array([counts[a:b].tobytes() for a, b in zip(edge, edge[1:])], pa.binary())], ["id", "h", "c"])


def probability_jaccard(h1, c1, h2, c2) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted hashes and
    weights).  With equal weights it is the plain Jaccard similarity."""
    if not len(h1) or not len(h2):
        return 0.0
    at = np.minimum(np.searchsorted(h1, h2), len(h1) - 1)
    both = h1[at] == h2
    shared = int(both.sum())
    if shared == 0:
        return 0.0
    if c1.max() == c1.min() and c2.max() == c2.min():
        return shared / (len(h1) + len(h2) - shared)
    v = np.concatenate([c1.astype(float), np.zeros(len(h2) - shared)])
    w = np.zeros(len(v))
    w[at[both]] = c2[both]
    w[len(h1):] = c2[~both]
    with np.errstate(divide="ignore"):
        ratio = v / w  # infinite where only the first has it
    order = np.argsort(ratio, kind="stable")
    r, vs, ws = ratio[order], v[order], w[order]
    common = (vs > 0) & (ws > 0)
    left = np.searchsorted(r, r[common], "left")
    above_v = vs.sum() - np.concatenate([[0], np.cumsum(vs)])[left]
    below_w = np.concatenate([[0], np.cumsum(ws)])[left]
    return float((1 / (above_v / vs[common] + below_w / ws[common])).sum())


def verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches ``threshold``.  Both
    joins are plain equi-joins, so a hot ``a`` is split by AQE."""
    wide = (pairs.join(sets.select(F.col("id").alias("b"), F.col("h").alias("hb"), F.col("c").alias("cb")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("h").alias("ha"), F.col("c").alias("ca")), "a")
            .select("a", "b", "ha", "ca", "hb", "cb"))

    def run(b: pa.RecordBatch):
        keep = []
        sides = [b.column(i) for i in range(2, 6)]
        for i in range(b.num_rows):
            ha, ca, hb, cb = (s[i].as_buffer() for s in sides)
            keep.append(probability_jaccard(
                np.frombuffer(ha, np.uint64), np.frombuffer(ca, np.uint32),
                np.frombuffer(hb, np.uint64), np.frombuffer(cb, np.uint32)) >= threshold - 1e-12)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return C.map_arrow(wide, run, "a long, b long")


def colliding(bands: DataFrame) -> DataFrame:
    """(band, id, a) of the buckets with two items or more, ``a`` being their
    smallest id: one shuffle of (id, band), sorted, and a run of equal bands at
    a time; what is alone in its bucket ends here."""
    def run(batches):
        last, lead, told = None, None, True
        for b in batches:
            if not b.num_rows:
                continue
            band, ids = b.column("band").to_numpy(), b.column("id").to_numpy()
            start = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
            length = np.diff(np.append(start, len(band)))
            first = ids[start]
            goes_on = last is not None and band[0] == last
            many = length > 1
            if goes_on:
                first = np.append(lead, first[1:])
                many = np.append(True, many[1:])
            keep = np.repeat(many, length)
            out = [band[keep], ids[keep], np.repeat(first[many], length[many])]
            if goes_on and not told:  # the run's first row ended the batch before
                out = [np.append(x, y) for x, y in zip((last, lead, lead), out)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["band", "id", "a"])
            last, lead, told = band[-1], first[-1], bool(many[-1])

    return (bands.select("band", "id").repartition("band").sortWithinPartitions("band", "id")
            .mapInArrow(run, "band long, id long, a long"))


def _marks_of(sets: DataFrame) -> DataFrame:
    """The MARKS columns of the sets (id, h, c)."""
    def run(b: pa.RecordBatch):
        h = [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column("h")]
        rows = np.repeat(np.arange(len(h)), [len(x) for x in h])
        count = [np.frombuffer(x.as_buffer(), np.uint32) for x in b.column("c")]
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), *marks(rows, join(h, np.uint64), join(count, np.uint32), len(h))], ["id", "bits", "weight"])

    return C.map_arrow(sets.select("id", "h", "c"), run, f"id long, {MARKS}")


def _labelled(members: DataFrame, found: DataFrame) -> DataFrame:
    """(band, id, root, main) of the members of buckets that hold more than
    one class; ``main`` is the class with the most members there."""
    own = members.join(found.withColumnRenamed("node", "id"), "id", "left").select("band", "id", F.coalesce("root", "id").alias("root"))
    sizes = own.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = (sizes.groupBy("band").agg(F.count(F.lit(1)).alias("k"), F.max_by("root", F.struct("n", "root")).alias("main"))
             .where("k > 1").select("band", "main"))
    return own.join(mixed, "band")


def _once() -> Column:
    """Each two members of different classes in one bucket, the first of those
    they share, and on one side only."""
    first = F.array_min(F.array_intersect(F.col("l.own"), F.col("r.own"))) == F.col("l.band")
    return ((F.col("r.root") == F.col("r.main")) | (F.col("l.id") < F.col("r.id"))) & first


def classes(bands: DataFrame, marked: DataFrame | None, make_sets, threshold: float, name: str) -> DataFrame:
    """(node, root) for the items that link with another one.

    ``bands``: (id, band), one row per item and band key.
    ``marked``: (id and the MARKS columns), one row per item, if they are at
    hand; else they are made of the sets, where they are needed.
    ``make_sets(ids)``: the shingle sets (id, h, c) of the items in ``ids``."""
    members = C.keep(colliding(bands), f"{name}-members")
    pairs = C.keep(members.where("a != id").select("a", F.col("id").alias("b")).distinct(), f"{name}-pairs")
    sets = C.keep(make_sets(members.select("id").distinct()), f"{name}-sets")
    edges = C.keep(verify(pairs, sets, threshold), f"{name}-edges")
    found = C.components(edges, name=f"{name}-cc")
    # what is still apart: each two members of different classes once, under the bound
    rest = C.keep(_labelled(members, found), f"{name}-apart")
    own = rest.groupBy("id").agg(F.collect_list("band").alias("own"))  # at most all bands of an item
    made = marked if marked is not None else _marks_of(sets.join(own.select("id"), "id", "left_semi"))
    near = C.keep(rest.join(own.join(_marked(made), "id"), "id"), f"{name}-mixed")
    left, right = near.where("root != main").alias("l"), near.alias("r")
    late = (left.join(right, (F.col("l.band") == F.col("r.band")) & (F.col("l.root") != F.col("r.root"))
                      & _may_link(threshold) & _once())
            .select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")).distinct()
            .join(pairs, ["a", "b"], "left_anti"))
    late = C.keep(late, f"{name}-more")
    if late.isEmpty():
        return found
    links = C.keep(verify(late, sets, threshold), f"{name}-late")
    if links.isEmpty():
        return found
    return C.components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links), name=f"{name}-cc2")
