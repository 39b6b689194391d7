"""Substring dedup by paragraph MinHash banding.

Paragraphs are the lines of a text; those with at least one word take part.
Equal word sequences are one paragraph; each distinct one gets a MinHash
signature over its runs of five words, banded for high recall (12 bands of
3: a pair at 0.8 shares none with probability 2e-4).  A set too small to
reach the threshold with any other set has its whole content as its one band,
and a line under five words, one shingle of its own, needs none.  Colliding
paragraphs are verified by exact Jaccard similarity, linked paragraphs
cluster as components, and of each cluster the first occurrence (smallest
doc_id, then position) stays, the others are removed.

A passage that several texts share need not be a line of theirs, so every run
of 50 words, across line ends too, is a paragraph as well: its set are its
11 pieces of 40 words, its signature the one smallest.  Equal runs have equal
minima and neighbouring runs mostly the same one, so a text hands on each
minimum once, and one that stands in two documents is a repeated passage: a
verbatim repeat of 50 words or more is never missed, and none under 40 words
is reported, however many short lines repeat.

Edge cases: a null or empty text has one empty paragraph, which never takes
part; a repeat within one document counts like any other; rows that repeat
one another are documents of their own; null doc_ids come last in the
order; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.llm import common as C
from newsgraph.llm import lsh

SIMILARITY = 0.8
SHINGLE_WORDS = 5
MIN_WORDS = 1
BANDS, ROWS = 12, 3
PASSAGE_WORDS, PIECE_WORDS = 50, 40
_ENTRY = ("kind int, rid long, doc_id long, n int, at array<int>, pids array<long>, pieces array<long>, src long, "
          "pid long, bands array<long>")


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All paragraphs of a string column, and how many each text has."""
    lists = pc.split_pattern(texts.fill_null(""), "\n")
    return lists.flatten(), lists.value_lengths().to_numpy()


def identities(words: C.Words, n: int) -> np.ndarray:
    """64-bit identity of each paragraph's word sequence."""
    counts = C.row_counts(words.row, n)
    place = np.arange(len(words.row)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.zeros(n, C.U64)
    some = np.flatnonzero(counts)
    if len(some):
        each = C.mix64(words.hash + place.astype(C.U64) * C.U64(0x9E3779B97F4A7C15))
        out[some] = C.mix64(np.add.reduceat(each, (np.cumsum(counts) - counts)[some]))
    return out


def minhash(rows: np.ndarray, h: np.ndarray, n: int, k: int) -> np.ndarray:
    """(n, k) minima of k hashes over each row's elements, each mixed anew:
    the registers of multiples of one number would agree too often."""
    out = np.full((n, k), np.iinfo(np.uint64).max, C.U64)
    if len(rows):
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        own = rows[first]
        h = C.mix64(h)
        for j in range(k):
            step = C.U64(0x9E3779B97F4A7C15 * (j + 1) & 0xFFFFFFFFFFFFFFFF)
            out[own, j] = np.minimum.reduceat(C.mix64(h + step), first)
    return out


def bands(rows: np.ndarray, h: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of n sets, flat, and how many each has.  A set of s shingles
    with s / (s + 1) under the threshold only links with an equal one: its
    one key is a hash of the whole set."""
    size = C.row_counts(rows, n)
    small = size < threshold * (size + 1) - 1e-9
    keys = np.zeros((n, BANDS), np.int64)
    large = np.flatnonzero(~small)
    new = np.full(n, -1)
    new[large] = np.arange(len(large))
    own = ~small[rows]
    keys[large] = lsh.band_keys(minhash(new[rows[own]], h[own], len(large), BANDS * ROWS), ROWS)
    key = np.zeros(n, C.U64)
    if len(rows):
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        key[rows[first]] = C.mix64(np.add.reduceat(C.mix64(h), first))
    keys[small, 0] = key[small].view(np.int64)
    lengths = np.where(small, 1, BANDS)
    return keys[np.arange(BANDS) < lengths[:, None]], lengths


def distinct_shingles(rows: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, shingle) once, sorted by row and hash (cut to 48 bits)."""
    h = h >> C.U64(64 - C.SHINGLE_BITS)
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])) if len(rows) else np.zeros(0, bool)
    return rows[new], h[new]


def _runs(x: np.ndarray, size: int, join) -> np.ndarray:
    """``join`` over each ``size`` neighbours of x, from runs of doubling length."""
    out, have, step = None, 0, 1
    while True:
        if size & step:
            out = x if out is None else join(out[:len(x) - have], x[have:])
            have += step
        if have == size:
            return out
        x, step = join(x[:len(x) - step], x[step:]), 2 * step


def pieces(rows: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest hash of a piece in each run of PASSAGE_WORDS words of a
    row, each (row, hash) once, by row.  ``rows`` and ``h``: all words in order."""
    if len(h) < PASSAGE_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, C.U64)
    chain = lambda a, b: C.mix64(a * C.U64(0x9E3779B97F4A7C15) + b)
    low = _runs(_runs(h, PIECE_WORDS, chain), PASSAGE_WORDS - PIECE_WORDS + 1, np.minimum)
    first = rows[:len(low)]
    at = np.flatnonzero(first == rows[PASSAGE_WORDS - 1:])
    rows, low = first[at], low[at]
    new = np.append(True, (rows[1:] != rows[:-1]) | (low[1:] != low[:-1])) if len(rows) else np.zeros(0, bool)
    rows, low = rows[new], low[new]
    order = np.lexsort((low, rows))
    rows, low = rows[order], low[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (low[1:] != low[:-1])) if len(rows) else np.zeros(0, bool)
    return rows[new], low[new]


def _scan(batches, threshold: float):
    rid = TaskContext.get().partitionId() << 32
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    names = ["kind", "rid", "doc_id", "n", "at", "pids", "pieces", "src", "pid", "bands"]
    for b in batches:
        if not b.num_rows:
            continue
        flat, per = split(b.column("text"))
        words = C.scan_words(flat)
        counts = C.row_counts(words.row, len(flat))
        pid = identities(words, len(flat)).view(np.int64)
        used = counts >= MIN_WORDS
        owner = np.repeat(np.arange(b.num_rows), per)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(per) - per, per)
        lengths = np.bincount(owner[used], minlength=b.num_rows)
        m = b.num_rows
        text, piece = pieces(owner[words.row], words.hash)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(m, np.int32)), pa.array(rid + np.arange(m)), b.column("doc_id"),
             pa.array(per.astype(np.int32)), C.list_of(place[used].astype(np.int32), lengths),
             C.list_of(pid[used], lengths), C.list_of(piece.view(np.int64), C.row_counts(text, m)),
             pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, longs)],
            names)
        rid += m
        at = np.flatnonzero(counts >= SHINGLE_WORDS)  # a shorter one equals no other's set
        _, first = np.unique(pid[at], return_index=True)
        at = at[np.sort(first)]
        if not len(at):
            continue
        new = np.full(len(flat), -1)
        new[at] = np.arange(len(at))
        rows, h = C.shingles(words, len(flat), SHINGLE_WORDS)
        rows = new[rows]
        rows, h = distinct_shingles(rows[rows >= 0], h[rows >= 0])
        m = len(at)
        keys = bands(rows, h, m, threshold)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(m, np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
             pa.nulls(m, pa.int32()), pa.nulls(m, ints), pa.nulls(m, longs), pa.nulls(m, longs),
             b.column("src").take(pa.array(owner[at])), pa.array(pid[at]),
             C.list_of(*keys)], names)


def _sets(b: pa.RecordBatch):
    """Shingle sets of the wanted paragraphs of each text."""
    flat, per = split(b.column("text"))
    words = C.scan_words(flat)
    pid = identities(words, len(flat)).view(np.int64)
    owner = np.repeat(np.arange(b.num_rows), per)
    wanted = [set(x) for x in b.column("wanted").to_pylist()]
    use = np.array([p in wanted[o] for p, o in zip(pid.tolist(), owner.tolist())], bool)
    use &= np.bincount(words.row, minlength=len(flat)) > 0
    at = np.flatnonzero(use)
    new = np.full(len(flat), -1)
    new[at] = np.arange(len(at))
    rows, h = C.shingles(words, len(flat), SHINGLE_WORDS)
    rows = new[rows]
    rows, h = distinct_shingles(rows[rows >= 0], h[rows >= 0])
    yield lsh.pack_sets(pa.array(pid[at]), rows, h, np.ones(len(h)))


def clusters(docs: DataFrame, threshold: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The documents (rid, doc_id, n, pieces) and their paragraphs that have a
    twin: (rid, doc_id, at, cluster, first)."""
    spark = docs.sparkSession
    C.use_small_batches(spark)
    # a paragraph's words are read again from one text that has it, found by id and content
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("src", F.xxhash64("doc_id", "text"))
    scan = C.keep(base.mapInArrow(lambda it: _scan(it, threshold), _ENTRY), "para-scan")
    distinct = C.keep(scan.where("kind = 1").groupBy("pid").agg(F.min(F.struct("src", "bands")).alias("m"))
                      .select("pid", "m.src", "m.bands"), "para-distinct")
    banded = distinct.select(F.col("pid").alias("id"), F.explode("bands").alias("band"))

    def make_sets(ids: DataFrame) -> DataFrame:
        where = (distinct.join(ids, distinct["pid"] == ids["id"]).groupBy("src")
                 .agg(F.collect_set("pid").alias("wanted")))
        found = base.join(where, "src").select("text", "wanted")
        return C.map_arrow(found, _sets, lsh.SETS).dropDuplicates(["id"])

    linked = lsh.classes(banded, None, make_sets, threshold, "para")
    docs_table = scan.where("kind = 0").select("rid", "doc_id", "n", "pieces")
    each = (scan.where("kind = 0").select("rid", "doc_id", F.explode(F.arrays_zip("at", "pids")).alias("x"))
            .select("rid", "doc_id", "x.at", F.col("x.pids").alias("pid"))
            .join(linked.withColumnRenamed("node", "pid"), "pid", "left")
            .select("rid", "doc_id", "at", F.coalesce("root", "pid").alias("cluster")))
    each = C.keep(each, "para-each")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", "at")
    # one join, on the written table: AQE splits a line that stands in many documents
    first = (each.groupBy("cluster").agg(F.count(F.lit(1)).alias("k"), F.min(order).alias("f")).where("k > 1")
             .select("cluster", F.col("f.rid").alias("first_rid"), F.col("f.at").alias("first_at")))
    twins = (each.join(first, "cluster").select(
        "rid", "doc_id", "at", "cluster",
        ((F.col("rid") == F.col("first_rid")) & (F.col("at") == F.col("first_at"))).alias("first")))
    return docs_table, C.keep(twins, "para-twins")


def repeated_passages(table: DataFrame) -> DataFrame:
    """(rid, n_repeated_passages) of the documents (rid, pieces) with a piece
    that stands in another one too."""
    met = lsh.colliding(table.select(F.col("rid").alias("id"), F.explode("pieces").alias("band")))
    return met.groupBy(F.col("id").alias("rid")).agg(F.count(F.lit(1)).alias("n_repeated_passages"))


def _lines(table: DataFrame, twins: DataFrame) -> DataFrame:
    per = twins.groupBy("rid").agg(
        F.count(F.lit(1)).alias("n_repeated"), F.sum(F.when(F.col("first"), 0).otherwise(1)).alias("n_removed"),
        F.sort_array(F.collect_list(F.when(~F.col("first"), F.col("at")))).alias("removed"))
    return table.select("rid", "doc_id", "n").join(per, "rid", "left").select(
        "rid", "doc_id", F.col("n").cast("long").alias("n_paragraphs"),
        F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.array_join(F.coalesce("removed", F.array().cast("array<int>")).cast("array<string>"), ",").alias("removed"))


def op9(docs: DataFrame) -> DataFrame:
    """The lines: doc_id, n_paragraphs, n_repeated (paragraphs with a twin),
    n_removed, removed (positions)."""
    return _lines(*clusters(docs)).drop("rid")


def op9_passages(docs: DataFrame) -> DataFrame:
    """The registered query: the columns of ``op9`` and n_repeated_passages
    (pieces of long passages that another document has as well)."""
    table, twins = clusters(docs)
    return (_lines(table, twins).join(repeated_passages(table), "rid", "left").drop("rid")
            .withColumn("n_repeated_passages", F.coalesce("n_repeated_passages", F.lit(0)).cast("long")))
