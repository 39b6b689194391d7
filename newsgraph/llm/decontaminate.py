"""Benchmark decontamination with a distributed positional inverted index.

The index is a table in the shared folder: per block of documents and term
one row with the documents (numbers in the block) and positions where the
term stands.  It holds every posting of every term of the benchmark (terms
are prefiltered by a bitmap of fixed size, so its size does not follow the
benchmark).  A window of an item is found from its two rarest terms by
corpus frequency: their lists, adjusted by the terms' offsets, are
intersected per block; what is left is checked against the lists of all
terms of the item, and runs of a window's length are exact phrase matches.
The same intersection counts proximity matches: both rarest terms, near
each other but not at their offsets.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z;
a window is 10 consecutive words of an item, or a whole shorter item.

Edge cases: a null or empty text has no words and no hits; items without
words match nothing; items that share an item_id count once; an item whose
id is null is listed as ``null``; rows that repeat one another are judged
each by itself; other columns are ignored, and kept by the pipeline stage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.llm import common as C

WINDOW = 10
NEAR = 5             # words by which a proximity match may be off
BLOCK_DOCS = 4096    # documents per block of the index
BLOCK_BYTES = 16 << 20
BITMAP_BITS = 22
BLOCKS = 10_000       # blocks whose document lists are broadcast; beyond that, a join
_ENTRY = "kind int, block long, ord int, doc_id long, n_words long, term long, ords array<int>, poss array<int>"


def item_table(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, terms) of the items that have words."""
    base = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text").dropDuplicates()
    base = base.withColumn("item", F.xxhash64("item_id", "text"))

    def run(b: pa.RecordBatch):
        w = C.scan_words(b.column("text"))
        yield pa.RecordBatch.from_arrays(
            [b.column("item"), b.column("item_id"),
             C.list_of(w.hash.view(np.int64), C.row_counts(w.row, b.num_rows))], ["item", "item_id", "terms"])

    return C.map_arrow(base, run, "item long, item_id string, terms array<long>").where("size(terms) > 0")


def build_index(docs: DataFrame, items: DataFrame, name: str = "index") -> DataFrame:
    """The index table; kind 0 rows are documents, kind 1 rows postings."""
    spark = docs.sparkSession
    shift = 64 - BITMAP_BITS
    bits = (items.select(F.explode("terms").alias("t")).select(F.shiftrightunsigned("t", shift).alias("bit"))
            .distinct().toPandas()["bit"].to_numpy().astype(np.int64))  # at most 2 ** BITMAP_BITS of them
    packed = np.zeros(1 << BITMAP_BITS, bool)
    packed[bits] = True
    sent = spark.sparkContext.broadcast(np.packbits(packed))

    def run(batches):
        wanted = np.unpackbits(sent.value).view(bool)
        number, held, size, base = 0, [], 0, TaskContext.get().partitionId() << 32
        for b in batches:
            held.append(b)
            size += b.nbytes
            if sum(x.num_rows for x in held) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                yield from _block(base + number, held, wanted, shift)
                number, held, size = number + 1, [], 0
        if held:
            yield from _block(base + number, held, wanted, shift)

    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ENTRY)
    return C.keep(table, name)


def _block(block: int, batches, wanted: np.ndarray, shift: int):
    ords, poss, terms, ids, n_words, first = [], [], [], [], [], 0
    for b in batches:
        w = C.scan_words(b.column("text"))
        counts = C.row_counts(w.row, b.num_rows)
        pos = np.arange(len(w.row)) - np.repeat(np.cumsum(counts) - counts, counts)
        use = wanted[w.hash >> C.U64(shift)]
        ords.append(w.row[use] + first)
        poss.append(pos[use])
        terms.append(w.hash[use])
        ids += b.column("doc_id").to_pylist()
        n_words.append(counts)
        first += b.num_rows
    none = lambda n, kind: pa.nulls(n, kind)
    lists = pa.list_(pa.int32())
    names = ["kind", "block", "ord", "doc_id", "n_words", "term", "ords", "poss"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(first, np.int32)), pa.array(np.full(first, block)), pa.array(np.arange(first, dtype=np.int32)),
         pa.array(ids, pa.int64()), pa.array(np.concatenate(n_words).astype(np.int64)), none(first, pa.int64()),
         none(first, lists), none(first, lists)], names)
    ords, poss, terms = np.concatenate(ords), np.concatenate(poss), np.concatenate(terms)
    order = np.argsort(terms, kind="stable")  # documents and positions stay ascending
    ords, poss, terms = ords[order].astype(np.int32), poss[order].astype(np.int32), terms[order]
    at = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
    lengths, n = np.diff(np.append(at, len(terms))), len(at)
    for lo in range(0, n, 256):  # small batches: a list can be long
        s = slice(lo, min(lo + 256, n))
        k, a, z = s.stop - lo, at[lo], at[lo] + lengths[s].sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(k, np.int32)), pa.array(np.full(k, block)), none(k, pa.int32()), none(k, pa.int64()),
             none(k, pa.int64()), pa.array(terms[at[s]].view(np.int64)), C.list_of(ords[a:z], lengths[s]),
             C.list_of(poss[a:z], lengths[s])], names)


def window_anchors(items: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, j1, t1, j2, t2): for each window that can occur the places of
    its two rarest terms, each pair once."""
    freq = (index.where("kind = 1").groupBy("term").agg(F.sum(F.size("ords")).alias("freq")))
    places = items.select("item", F.posexplode("terms").alias("j", "term")).join(freq, "term", "left")
    lists = (places.groupBy("item").agg(F.sort_array(F.collect_list(F.struct(
        "j", "term", F.coalesce("freq", F.lit(0)).alias("freq")))).alias("p"))
        .select("item", F.col("p.term").alias("terms"), F.col("p.freq").alias("freqs")))

    def run(b: pa.RecordBatch):
        out = []
        for item, terms, freqs in zip(*(b.column(c).to_pylist() for c in ("item", "terms", "freqs"))):
            f, size, seen = np.array(freqs), min(window, len(terms)), set()
            for s in range(len(terms) - size + 1):
                part = f[s:s + size]
                if part.min() == 0:
                    continue  # a word the corpus does not have
                best = np.argsort(part, kind="stable")
                j1 = s + int(best[0])
                j2 = s + int(next((x for x in best if terms[s + x] != terms[j1]), best[-1]))
                if (j1, j2) not in seen:
                    seen.add((j1, j2))
                    out.append((item, j1, terms[j1], j2, terms[j2]))
        cols = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()))],
            ["item", "j1", "t1", "j2", "t2"])

    return C.map_arrow(lists, run, "item long, j1 int, t1 long, j2 int, t2 long")


def _keys(ords: np.ndarray, poss: np.ndarray) -> np.ndarray:
    return (ords.astype(np.int64) << 32) | poss


def _intersect(b: pa.RecordBatch):
    """Offset-adjusted intersection of two posting lists per row."""
    flat = {c: b.column(c).flatten().to_numpy() for c in ("o1", "p1", "o2", "p2")}
    edge = {c: np.append(0, np.cumsum(b.column(c).value_lengths().to_numpy())) for c in ("o1", "o2")}
    k1, k2 = _keys(flat["o1"], flat["p1"]), _keys(flat["o2"], flat["p2"])
    j1, j2 = b.column("j1").to_numpy(), b.column("j2").to_numpy()
    row, key, near = [], [], []
    for i in range(b.num_rows):
        a = k1[edge["o1"][i]:edge["o1"][i + 1]]
        c = k2[edge["o2"][i]:edge["o2"][i + 1]]
        want = a + (int(j2[i]) - int(j1[i]))
        at = np.searchsorted(c, want)
        after, before = np.minimum(at, len(c) - 1), np.maximum(at - 1, 0)
        hit = c[after] == want
        close = ~hit & ((np.abs(c[after] - want) <= NEAR) | (np.abs(c[before] - want) <= NEAR))
        some = hit | close
        row.append(np.full(int(some.sum()), i))
        key.append(a[some])
        near.append(close[some])
    row, key, near = np.concatenate(row), np.concatenate(key), np.concatenate(near)
    delta = (key & 0xFFFFFFFF) - j1[row]
    yield pa.RecordBatch.from_arrays(
        [b.column("block").take(pa.array(row)), b.column("item").take(pa.array(row)),
         pa.array((key >> 32).astype(np.int32)), pa.array(delta.astype(np.int64)), pa.array(near)],
        ["block", "item", "ord", "delta", "near"])


def _of_documents(b: pa.RecordBatch):
    """Posting rows cut down to the wanted documents of their block."""
    lengths = b.column("ords").value_lengths().to_numpy()
    ords, poss = b.column("ords").flatten().to_numpy(), b.column("poss").flatten().to_numpy()
    row = np.repeat(np.arange(b.num_rows), lengths)
    wanted = b.column("wanted")
    pairs = (np.repeat(np.arange(b.num_rows), wanted.value_lengths().to_numpy()) << 32) | wanted.flatten().to_numpy()
    use = np.isin((row << 32) | ords, pairs)
    left = np.bincount(row[use], minlength=b.num_rows)
    yield pa.RecordBatch.from_arrays(
        [b.column("block"), b.column("term"), C.list_of(ords[use], left), C.list_of(poss[use], left)],
        ["block", "term", "ords", "poss"]).filter(pa.array(left > 0))


def _phrases(window: int):
    """Cogroup function per block: posting rows and alignments to hits."""
    def run(postings: pa.Table, found: pa.Table) -> pa.Table:
        schema = pa.schema([("block", pa.int64()), ("ord", pa.int32()), ("n_hit", pa.int64()),
                            ("items", pa.list_(pa.int64()))])
        if not found.num_rows or not postings.num_rows:
            return schema.empty_table()
        terms = found["terms"].combine_chunks()
        length = terms.value_lengths().to_numpy()
        which = np.repeat(np.arange(found.num_rows), length)
        j = np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length)
        term = terms.flatten().to_numpy()
        pos = found["delta"].to_numpy()[which] + j
        ords = found["ord"].to_numpy()
        key = (ords[which].astype(np.int64) << 32) | np.maximum(pos, 0)
        # look each wanted place up in the list of its term
        ok = np.zeros(len(which), bool)
        order = np.argsort(term, kind="stable")
        edges = np.flatnonzero(np.append(True, term[order][1:] != term[order][:-1]))
        lists = {t: i for i, t in enumerate(postings["term"].to_pylist())}
        po, pp = postings["ords"].combine_chunks(), postings["poss"].combine_chunks()
        for a, z in zip(edges, np.append(edges[1:], len(order))):
            i = lists.get(int(term[order[a]]))
            if i is None:
                continue
            have = _keys(po[i].values.to_numpy(), pp[i].values.to_numpy())
            ask = key[order[a:z]]
            ok[order[a:z]] = have[np.minimum(np.searchsorted(have, ask), len(have) - 1)] == ask
        ok &= pos >= 0
        # runs of matching words within one alignment
        begin = np.append(True, (which[1:] != which[:-1]) | ~ok[:-1]) & ok if len(ok) else ok
        stop = np.append((which[1:] != which[:-1]) | ~ok[1:], True) & ok if len(ok) else ok
        b, e = np.flatnonzero(begin), np.flatnonzero(stop)
        long_enough = e - b + 1 >= np.minimum(window, length[which[b]])
        b, e = b[long_enough], e[long_enough]
        if not len(b):
            return schema.empty_table()
        lo, hi, o, item = pos[b], pos[e] + 1, ords[which[b]], found["item"].to_numpy()[which[b]]
        order = np.lexsort((lo, o))
        lo, hi, o, item = lo[order], hi[order], o[order], item[order]
        rows = []
        at = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
        for a, z in zip(at, np.append(at[1:], len(o))):
            reach = np.maximum.accumulate(np.append(0, hi[a:z]))
            n_hit = int(np.maximum(hi[a:z] - np.maximum(lo[a:z], reach[:-1]), 0).sum())
            rows.append({"block": found["block"][0].as_py(), "ord": int(o[a]), "n_hit": n_hit,
                         "items": np.unique(item[a:z]).tolist()})
        return pa.Table.from_pylist(rows, schema)
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_near, items), one row per row of ``docs``;
    ``items`` are the ids of the items with a window in the text, sorted."""
    spark = docs.sparkSession
    C.use_small_batches(spark)
    items = C.keep(item_table(benchmark), "bench-items")
    index = build_index(docs, items)
    C.use_small_batches(spark, 128)  # rows of posting lists
    posting = index.where("kind = 1").select("block", "term", "ords", "poss")
    anchors = C.keep(window_anchors(items, index, window), "bench-anchors")
    first = posting.select("block", F.col("term").alias("t1"), F.col("ords").alias("o1"), F.col("poss").alias("p1"))
    second = posting.select("block", F.col("term").alias("t2"), F.col("ords").alias("o2"), F.col("poss").alias("p2"))
    # lists of other terms, the frequent ones among them, stay where they are
    first = first.join(C.small_side(anchors.select("t1").distinct()), "t1", "left_semi")
    second = second.join(C.small_side(anchors.select("t2").distinct()), "t2", "left_semi")
    both = anchors.join(first, "t1").join(second, ["block", "t2"])
    places = C.keep(C.map_arrow(both.select("block", "item", "j1", "j2", "o1", "p1", "o2", "p2"), _intersect,
                                "block long, item long, ord int, delta long, near boolean"), "bench-places")
    near = (places.where("near").select("block", "ord", "item", "delta").distinct()
            .groupBy("block", "ord").agg(F.count(F.lit(1)).alias("n_near")))
    found = places.where("not near").select("block", "ord", "item", "delta").distinct().join(items, "item")
    found = C.keep(found.select("block", "ord", "item", "delta", "terms"), "bench-found")
    needed = C.small_side(found.select(F.explode("terms").alias("term")).distinct())
    docs_found = C.small_side(found.groupBy("block").agg(F.collect_set("ord").alias("wanted")), BLOCKS)
    lists = posting.join(needed, "term", "left_semi").join(docs_found, "block")
    lists = C.map_arrow(lists.select("block", "term", "ords", "poss", "wanted"), _of_documents,
                        "block long, term long, ords array<int>, poss array<int>")
    hits = (lists.groupBy("block")
            .cogroup(found.groupBy("block"))
            .applyInArrow(_phrases(window), "block long, ord int, n_hit long, items array<long>"))
    hits = C.keep(hits, "bench-hits")
    ids = (hits.select("block", "ord", F.explode("items").alias("item")).join(items.select("item", "item_id"), "item")
           .groupBy("block", "ord").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    doc = index.where("kind = 0").select("block", "ord", "doc_id", "n_words")
    return (doc.join(hits.select("block", "ord", "n_hit"), ["block", "ord"], "left")
            .join(ids, ["block", "ord"], "left").join(near, ["block", "ord"], "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("n_near", F.lit(0)).alias("n_near"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The registered query."""
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        "n_near")


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark window go."""
    key = C.fresh(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark)
    gone = C.keep(found.where("n_hit > 0").select(F.col("doc_id").alias("gone_key")).distinct(), "bench-gone")
    return keyed.join(gone, keyed[key] == gone["gone_key"], "left_anti").drop(key)
