"""Ranked lexical search with per-term geometric blocking.

*Scores.*  A document's impact for a term is a whole number that no query
changes: w * ((10^9 tf) div (1000 tf + 8 m)).  An item's score for it sums the
impacts of the item's terms, repeats included.

*Index.*  Documents are cut into shards of bounded size.  Each shard orders
its documents by clusters of similar ones (cosine of their impacts), so that
every term's posting list is laid out by similarity and is cut into blocks of
near documents.  A block of a short list stores the coordinatewise maximum of
its documents' impacts, over all terms that some item names together with the
list's term.  A list that runs through much of the shard has one block per
cluster and shares the cluster's own maximum, over all terms.  Maxima are
kept in units of 16, rounded up, so a block's product with an item is never
below the score of a document in it.  The index is a table in the shared
folder, a row per shard.

*Search.*  Lists are needed only for an item's terms beyond those whose
largest impacts together stay under the item's threshold.  Their blocks are
taken in order of their bounds; the documents of a block are scored exactly,
and the rest is skipped only when the bound is under the tenth best score so
far.  A first pass over a sixteenth of the shards gives each item a threshold
that every shard starts from; the result does not depend on it.

The item set is handled in blocks of about GROUP_TERMS terms, so what is
broadcast is bounded whatever its size; every block meets every document.

Edge cases: a null or empty text has no terms and is never found; equal rows
of the item table are one item, items that share an id are ranked each by
itself; items without terms have no rows; rows that repeat a doc_id are
documents of their own, with equal ranks in no given order; null doc_ids come
last among equal scores; other columns are ignored."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsgraph.llm import common as C
from newsgraph.llm import terms
from newsgraph.session import scratch_path

TOP = 10
GROUP_TERMS = 1 << 14   # terms of the items that are searched for at once
CELLS = 1 << 23         # documents x terms of a shard
CLUSTER = 32            # documents in a cluster, on average
BLOCK = 16              # documents in a block of a short list
LONG = 16               # a list of more than 1 / LONG of the shard is long
SEED_SHARDS = 16        # one shard in so many sets the thresholds
UNIT = 4                # maxima are kept in units of 2 ** UNIT
_VECTOR = "kind int, doc_id long, n long, cols array<int>, tf array<int>"
_SHARD = ("shard long, doc_id array<long>, n array<long>, cols binary, tf binary, edge binary, clusters binary, "
          "cluster_edge binary, cluster_cols binary, cluster_max binary, blocks binary, block_edge binary, "
          "block_cols binary, block_max binary")


class Items(NamedTuple):
    """A block of items: plain values, bounded by GROUP_TERMS."""
    vocabulary: list[str]
    terms: list[np.ndarray]     # of each item, ascending columns
    times: list[np.ndarray]     # how often each stands in the item

    def together(self) -> list[np.ndarray]:
        """For each term the terms that some item names beside it."""
        near: list[set[int]] = [set() for _ in self.vocabulary]
        for t in self.terms:
            for x in t.tolist():
                near[x].update(t.tolist())
        return [np.array(sorted(s), np.int64) for s in near]


def item_table(benchmark: DataFrame) -> DataFrame:
    """(item_id, item, terms) of the items that have terms; ``item`` tells
    items apart by id and text."""
    base = benchmark.select("item_id", F.col("text").cast("string").alias("text")).dropDuplicates()
    base = base.withColumn("item", F.sha2(F.concat_ws("/", F.coalesce(F.col("item_id").cast("string"), F.lit("-")),
                                                      F.col("item_id").isNull().cast("string"), "text"), 256))

    def run(batches):
        for b in batches:
            for part in terms.slices(b, "text"):
                rows, flat = terms.split_terms(part.column("text"), terms.NOT_WORD)
                lists = pa.LargeListArray.from_arrays(
                    pa.array(np.searchsorted(rows, np.arange(part.num_rows + 1))), flat.cast(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column("item"), lists.cast(pa.list_(pa.string()))], ["item", "terms"])

    found = base.select("item", "text").mapInArrow(run, "item string, terms array<string>")
    return base.select("item_id", "item").join(found, "item").where("size(terms) > 0")


def vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Kind 1: the documents that have a term of ``vocabulary``, with the
    columns they have and how often.  Kind 0, a row per slice of the table:
    how many documents have terms (doc_id), how many terms there are (n), and
    in how many documents each column stands (cols, tf)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = pa.array(sent.value, pa.large_string())
        names = ["kind", "doc_id", "n", "cols", "tf"]
        for b in batches:
            for part in terms.slices(b, "text"):
                m = part.num_rows
                rows, flat = terms.split_terms(part.column("text"), terms.NOT_WORD)
                n = np.bincount(rows, minlength=m)
                col = pc.fill_null(pc.index_in(flat, known), -1).to_numpy()
                r, c, tf = terms.row_term_counts(rows[col >= 0], col[col >= 0], len(known))
                df = np.bincount(c, minlength=len(known))
                some = np.flatnonzero(df)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int32()), pa.array([int((n > 0).sum())]), pa.array([int(n.sum())]),
                     C.list_of(some.astype(np.int32), np.array([len(some)])),
                     C.list_of(df[some].astype(np.int32), np.array([len(some)]))], names)
                length = np.bincount(r, minlength=m)
                own = np.flatnonzero(length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(len(own), np.int32)), part.column("doc_id").take(pa.array(own)), pa.array(n[own]),
                     C.list_of(c.astype(np.int32), length[own]), C.list_of(tf.astype(np.int32), length[own])], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, _VECTOR)


class Weights(NamedTuple):
    documents: int
    total: int
    term: np.ndarray    # w of each column


def weights(table: DataFrame, n_terms: int) -> Weights:
    """Corpus statistics over all documents; a row per term of the block of
    items comes to the driver."""
    slices = table.where("kind = 0")
    n, total = slices.agg(F.coalesce(F.sum("doc_id"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(n_terms, np.int64)
    for r in (slices.select(F.explode(F.arrays_zip("cols", "tf")).alias("x")).groupBy("x.cols")
              .agg(F.sum("x.tf").alias("df")).collect()):
        df[r["cols"]] = r["df"]
    return Weights(n, total, np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64))


def impacts(w: Weights, n: np.ndarray, cols: np.ndarray, tf: np.ndarray, row: np.ndarray) -> np.ndarray:
    m = 25 + (75 * n * w.documents) // w.total
    tf = tf.astype(np.int64)
    return w.term[cols] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))


def similar_order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (columns of the term-major ``x``) ordered by clusters of
    similar ones, and where each cluster begins."""
    n = x.shape[1]
    k = -(-n // CLUSTER)
    if k == 1:
        return np.arange(n), np.zeros(1, np.int64)
    unit = x.T.astype(np.float32)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-30)
    first = np.lexsort((unit.max(1), unit.argmax(1)))[np.arange(k) * n // k]  # spread over the leading terms
    centre = unit[first]
    for last in (False, True):
        near = unit @ centre.T
        own = near.argmax(1)
        if not last:
            order = np.argsort(own, kind="stable")
            begin = np.flatnonzero(np.append(True, np.diff(own[order]) > 0))
            centre = np.add.reduceat(unit[order], begin, axis=0)
            centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-30)
    alike = centre @ centre.T
    chain, left = [0], set(range(1, len(centre)))
    while left:  # near clusters side by side
        chain.append(max(left, key=lambda j: (alike[chain[-1], j], -j)))
        left.remove(chain[-1])
    place = np.argsort(chain)[own]
    order = np.lexsort((-near[np.arange(n), own], place))
    return order, np.flatnonzero(np.append(True, np.diff(place[order]) > 0))


def _maxima(values: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of maxima as edges, columns and rounded-up units; zeros left out."""
    r, c = np.nonzero(values)
    up = (values[r, c] + (1 << UNIT) - 1) >> UNIT
    return np.searchsorted(r, np.arange(len(values) + 1)), c.astype(kind), up.astype(np.uint32)


def build_shard(number: int, doc_id: pa.Array, n: np.ndarray, cols: np.ndarray, tf: np.ndarray, edge: np.ndarray,
                w: Weights, together: list[np.ndarray]) -> pa.RecordBatch:
    """One row of the index."""
    docs, width = len(n), len(w.term)
    small = np.uint16 if width <= 1 << 16 else np.uint32
    length = np.diff(edge)
    row = np.repeat(np.arange(docs), length)
    x = np.zeros((width, docs), np.int64)
    x[cols, row] = impacts(w, n, cols, tf, row)
    order, clusters = similar_order(x)
    x = x[:, order]
    cluster = _maxima(np.maximum.reduceat(x, clusters, axis=1).T, small)
    blocks, edges, block_cols, block_max, at = [], [0], [], [], 0
    for t in np.unique(cols).tolist():
        found = np.flatnonzero(x[t])
        if not len(found) or len(found) * LONG > docs:
            continue
        near = together[t]
        top = np.maximum.reduceat(x[np.ix_(near, found)], np.arange(0, len(found), BLOCK), axis=1).T
        e, c, up = _maxima(top, np.int64)
        blocks.append(np.full(len(top), t))
        edges.extend((e[1:] + at).tolist())
        block_cols.append(near[c].astype(small))
        block_max.append(up)
        at += len(c)
    # the documents' own rows, in the new order
    place = np.argsort(order)
    by = np.argsort(place[row], kind="stable")
    join = lambda parts, kind: (np.concatenate(parts) if parts else np.zeros(0, np.int64)).astype(kind)
    binary = [cols[by].astype(small), tf[by].astype(np.int32), np.append(0, np.cumsum(length[order])).astype(np.int64),
              clusters.astype(np.int64), cluster[0].astype(np.int64), cluster[1], cluster[2],
              join(blocks, np.int64), np.array(edges, np.int64), join(block_cols, small), join(block_max, np.uint32)]
    one = np.array([docs])
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, docs], pa.int32()), doc_id.take(pa.array(order))),
         C.list_of(n[order], one), *[pa.array([b.tobytes()], pa.binary()) for b in binary]],
        [c.split()[0] for c in _SHARD.split(", ")])


def build_index(table: DataFrame, w: Weights, items: Items) -> DataFrame:
    """The index of all documents in ``table`` for a block of items."""
    spark = table.sparkSession
    sent = spark.sparkContext.broadcast((tuple(w), items.together()))
    most = max(CELLS // max(len(items.vocabulary), 1), 1)

    def run(batches):
        own, together = sent.value
        own = Weights(*own)
        number, held, rows = TaskContext.get().partitionId() << 32, [], 0

        def flush(n):
            nonlocal held, rows, number
            whole = pa.Table.from_batches(held)
            part, rest = whole.slice(0, n).combine_chunks(), whole.slice(n)
            cols = part.column("cols").combine_chunks()
            edge = np.append(0, np.cumsum(pc.list_value_length(cols).to_numpy()))
            yield build_shard(number, part.column("doc_id").combine_chunks(), part.column("n").to_numpy(),
                              cols.flatten().to_numpy(), part.column("tf").combine_chunks().flatten().to_numpy(), edge,
                              own, together)
            held, rows, number = rest.to_batches(), rest.num_rows, number + 1

        for b in batches:
            held.append(b)
            rows += b.num_rows
            while rows >= most:
                yield from flush(most)
        if rows:
            yield from flush(rows)

    path = scratch_path(spark, "llm-lexical-index")
    # a row is some megabytes: pages and row groups end by size, not by rows
    (table.where("kind = 1").select("doc_id", "n", "cols", "tf").mapInArrow(run, _SHARD)
     .write.option("parquet.page.size.row.check.min", "1").option("parquet.page.size.row.check.max", "1")
     .option("parquet.block.size.row.check.min", "1").option("parquet.block.size", str(32 << 20)).parquet(path))
    return spark.read.parquet(path)


class Shard:
    """A row of the index, ready to be searched."""

    def __init__(self, row: dict, w: Weights):
        width = len(w.term)
        small = np.uint16 if width <= 1 << 16 else np.uint32
        get = lambda name, kind=np.int64: np.frombuffer(row[name], kind)
        self.doc_id = row["doc_id"]
        self.size = len(self.doc_id)
        edge, cols = get("edge"), get("cols", small)
        at = np.repeat(np.arange(self.size), np.diff(edge))
        self.x = np.zeros((width, self.size), np.int64)
        self.x[cols, at] = impacts(w, np.array(row["n"]), cols, get("tf", np.int32), at)
        self.largest = self.x.max(1)
        self.length = np.bincount(cols, minlength=width)
        self.clusters = np.append(get("clusters"), self.size)
        e = get("cluster_edge")
        self.cluster_max = np.zeros((len(e) - 1, width), np.int64)
        self.cluster_max[np.repeat(np.arange(len(e) - 1), np.diff(e)), get("cluster_cols", small)] = get("cluster_max", np.uint32)
        self.blocks = get("blocks")      # the term of each block, ascending
        self.edge, self.cols = get("block_edge"), get("block_cols", small)
        self.max = get("block_max", np.uint32)

    def candidates(self, needed: np.ndarray, cols: np.ndarray, times: np.ndarray, spread: np.ndarray):
        """(bound, documents) of the blocks in the lists of the ``needed`` terms."""
        long = needed[self.length[needed] * LONG > self.size]
        if len(long):
            bounds = (self.cluster_max[:, cols] @ times) << UNIT
            has = (self.x[long] > 0).any(0)
            for k in np.flatnonzero(bounds):
                a, z = self.clusters[k], self.clusters[k + 1]
                yield int(bounds[k]), a + np.flatnonzero(has[a:z])
        for t in needed[self.length[needed] * LONG <= self.size].tolist():
            a, z = np.searchsorted(self.blocks, [t, t + 1])
            if a == z:
                continue
            e = self.edge[a:z + 1]
            part = self.max[e[0]:e[-1]].astype(np.int64) * spread[self.cols[e[0]:e[-1]]]
            bounds = np.add.reduceat(part, e[:-1] - e[0]) << UNIT
            found = np.flatnonzero(self.x[t])
            for i, bound in enumerate(bounds.tolist()):
                yield bound, found[i * BLOCK:(i + 1) * BLOCK]

    def search(self, cols: np.ndarray, times: np.ndarray, least: int, top: int) -> list[tuple[int, int]]:
        """The (score, document) pairs that can be among the first ``top`` of
        all shards, whose ``top``-th score is known to be ``least`` or more."""
        least = max(least, 1)
        most = self.largest[cols] * times
        order = np.argsort(most, kind="stable")
        needed = cols[order[np.cumsum(most[order]) >= least]]
        if not len(needed):
            return []
        spread = np.zeros(len(self.largest), np.int64)
        spread[cols] = times
        waiting = [c for c in self.candidates(needed, cols, times, spread) if c[0] >= least]
        waiting.sort(key=lambda c: -c[0])
        seen = np.zeros(self.size, bool)
        found: list[tuple[int, int]] = []
        scores = np.zeros(0, np.int64)
        for at in range(0, len(waiting), 8):
            if waiting[at][0] < least:
                break
            docs = np.unique(np.concatenate([d for bound, d in waiting[at:at + 8] if bound >= least]))
            docs = docs[~seen[docs]]
            seen[docs] = True
            got = times @ self.x[np.ix_(cols, docs)]
            good = got >= least
            found += zip(got[good].tolist(), docs[good].tolist())
            scores = np.append(scores, got[good])
            if len(scores) >= top:
                scores = np.partition(scores, len(scores) - top)[-top:]
                least = max(least, int(scores.min()))
        ids = self.doc_id
        found = sorted((f for f in found if f[0] >= least), key=lambda f: (-f[0], ids[f[1]] is None, ids[f[1]] or 0))
        return found[:top]


def _search(index: DataFrame, w: Weights, items: Items, least: list[int], top: int) -> DataFrame:
    """(k, doc_id, score): the best of each shard for each item number k."""
    sent = index.sparkSession.sparkContext.broadcast((tuple(w), items.terms, items.times, least))

    def run(batches):
        own, cols, times, floor = sent.value
        own = Weights(*own)
        for b in batches:
            for i in range(b.num_rows):
                shard = Shard(b.slice(i, 1).to_pylist()[0], own)
                rows = [(k, shard.doc_id[d], s) for k in range(len(cols))
                        for s, d in shard.search(cols[k], times[k], floor[k], top)]
                k, d, s = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.int32()), pa.array(d, pa.int64()), pa.array(s, pa.int64())], ["k", "doc_id", "score"])

    return index.mapInArrow(run, "k int, doc_id long, score long")


def _first(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("k").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents with a
    score above 0 for each item."""
    spark = docs.sparkSession
    table = C.keep(item_table(benchmark), "lexical-items")
    size = table.agg(F.sum(F.size(F.array_distinct("terms")))).first()[0] or 0
    groups = -(-size // GROUP_TERMS)
    kind = dict(benchmark.dtypes)["item_id"]
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for g in range(groups):  # the stated items in blocks, each against all documents
        own = (table.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).select("item", "terms")
               .orderBy("item").collect())
        if not own:
            continue
        vocabulary = sorted({t for r in own for t in r["terms"]})
        place = {t: i for i, t in enumerate(vocabulary)}
        counted = [np.unique([place[t] for t in r["terms"]], return_counts=True) for r in own]
        items = Items(vocabulary, [c for c, _ in counted], [n for _, n in counted])
        vecs = C.keep(vectors(docs, vocabulary), "lexical-vectors")
        w = weights(vecs, len(vocabulary))
        if not w.total:
            return out
        index = build_index(vecs, w, items)
        seeds = index.where(F.pmod(F.xxhash64("shard"), F.lit(SEED_SHARDS)) == 0)
        least = [0] * len(own)
        for r in (_first(_search(seeds, w, items, least, top), top).groupBy("k")
                  .agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n")).where(F.col("n") == top).collect()):
            least[r["k"]] = r["s"]
        names = spark.createDataFrame([(k, r["item"]) for k, r in enumerate(own)], "k int, item string")
        best = _first(_search(index, w, items, least, top), top)
        out = out.unionByName(best.join(names, "k").join(table.select("item", "item_id"), "item")
                              .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


def op11(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The registered query: item_id, rank, doc_id, score."""
    return search(docs, benchmark)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
n AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM n),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY item_id, term),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) SEMI JOIN q USING (term) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
c AS (
  SELECT q.item_id, n.r, n.doc_id,
         CAST(sum(q.times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * n.n * s.docs) // s.total)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n ON n.r = tf.r, s
  GROUP BY q.item_id, n.r, n.doc_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM c WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
