"""Suffix-array dedup: bytes covered by a 200-byte string that starts
anywhere else, found by merging Burrows-Wheeler transforms of shards.

1. Every 200-byte window is assigned to the smallest 48-byte gram in it
   (by hash, leftmost on ties), so equal windows share their gram; runs of
   windows with one gram are a segment.  A scan lists each text's segments
   as (gram, content) hashes.
2. Grams that occur once cannot hold a repeat.  Of the rest, segments of
   equal content are counted as one class; a class of two or more is
   repeated as a whole.  Classes that share a gram with another class have
   their bytes fetched, one representative each.
3. The representatives meet by gram.  Each pack of groups is dealt into
   shards; a shard's transform is the symbol (8 bytes) before each of its
   sorted suffixes.  The transforms are merged by refining the interleave
   of their rows, one symbol a round: a stable sort of the rows by their
   symbols orders them by one symbol more, blocks being rows that agree so
   far.  Rows in blocks of a single shard are settled and leave; after 25
   rounds the blocks are the 200-byte strings that two shards share, and a
   shard's own sorted rows give those within it.  Suffixes are sorted in
   their shards only, never again.  A gram whose representatives have more
   than GROUP bytes is not merged: the hashes of its windows are counted,
   combined on the map side, so no group of any size meets in one task.

Matches never cross documents; positions are judged on the input.

Edge cases: a null text is empty; texts of fewer than 200 bytes lose
nothing; equal texts of 200 bytes or more lose everything; rows that repeat
one another count as documents of their own; other columns are ignored,
and kept by the pipeline stage (where bytes of a character that a cut
splits are dropped)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.llm import common as C

LENGTH = 200          # bytes of a repeat; a multiple of SYMBOL
GRAM = 48
SPAN = LENGTH - GRAM + 1
SYMBOL = 8
SHARDS = 4
PIECE = 1 << 18       # bytes scanned at a time
PACK = 1 << 17        # bytes of segments merged at a time
PART = 1 << 19        # segments listed in one row; longer texts take several
HOT = 20_000          # classes of a gram beyond which windows are counted
GROUP = 1 << 20       # bytes of a gram's classes beyond which they are, too


# -- scan -----------------------------------------------------------------

def segments(data: np.ndarray, offsets: np.ndarray):
    """(start, windows, gram hash, content hash) of every segment of every
    text in the buffer, in order of position."""
    out = []
    lo, n = 0, len(data)
    while lo + LENGTH <= n:
        hi = min(lo + PIECE, n - LENGTH + 1)  # windows start in [lo, hi)
        piece = data[lo:hi + LENGTH - 1]
        prefix = C.prefix_hash(piece)
        at = np.arange(len(piece) - GRAM + 1)
        gram = C.span_hash(prefix, at, at + GRAM)
        low = (gram & ~C.U64(0xFFFFFF)) | at.astype(C.U64)
        width = 1
        while width * 2 <= SPAN:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[:len(low) - (SPAN - width)], low[SPAN - width:])
        anchor = (low & C.U64(0xFFFFFF)).astype(np.int64)
        row = np.searchsorted(offsets, np.arange(lo, hi), "right") - 1 if len(offsets) > 2 else np.zeros(hi - lo, np.int64)
        valid = np.arange(lo, hi) + LENGTH <= offsets[row + 1]
        first = valid.copy()
        first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        last = valid.copy()
        last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        content = C.span_hash(prefix, s, e + LENGTH - 1)
        content = C.mix64(content + (anchor[s] - s).astype(C.U64))
        out.append((s + lo, e - s, gram[anchor[s]], content))
        lo = hi
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, C.U64), np.zeros(0, C.U64)
    return tuple(np.concatenate(x) for x in zip(*out))


_LIST = "rid long, doc_id long, t long, n_bytes long, n long, lo array<int>, windows array<int>, anchor array<long>, seg array<long>"


def list_segments(docs: DataFrame) -> DataFrame:
    """One row per text part: its segments; ``n`` is the number of rows of
    the Arrow batch with this text, given once for each text."""
    def run(batches):
        rid = TaskContext.get().partitionId() << 24
        for b in batches:
            data, offsets = C.text_buffer(b.column("text"))
            t = b.column("t").to_numpy()
            n_bytes = np.diff(offsets)
            same, first, count = np.unique(np.stack([t, n_bytes]), axis=1, return_index=True, return_counts=True)[0:3]
            start, windows, gram, content = segments(data, offsets)
            edge = np.searchsorted(start, offsets)
            parts = []
            ids = b.column("doc_id").to_pylist()
            for i, k in zip(first.tolist(), count.tolist()):
                for a in range(edge[i], max(edge[i + 1], edge[i] + 1), PART):
                    z = min(a + PART, edge[i + 1])
                    parts.append((rid, ids[i], int(t[i]), int(n_bytes[i]), k, a, z, i))
                    rid += 1
            cut = [np.arange(a, z) for *_, a, z, _ in parts]
            take = np.concatenate(cut) if cut else np.zeros(0, np.int64)
            lengths = np.array([len(c) for c in cut], np.int64)
            base = np.repeat(np.array([offsets[p[-1]] for p in parts], np.int64), lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[j] for p in parts], pa.int64()) for j in range(5)]
                + [C.list_of((start[take] - base).astype(np.int32), lengths),
                   C.list_of(windows[take].astype(np.int32), lengths),
                   C.list_of(gram[take].view(np.int64), lengths), C.list_of(content[take].view(np.int64), lengths)],
                ["rid", "doc_id", "t", "n_bytes", "n", "lo", "windows", "anchor", "seg"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _identity("text").alias("t"))
    return base.mapInArrow(lambda it: run(b for b in it if b.num_rows), _LIST)


def _identity(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


# -- transforms of shards, and their merge ---------------------------------

class Shard:
    """Sorted suffixes of some segments and the symbol before each.

    Row r stands for the r-th suffix in the order of the first LENGTH
    bytes; ``symbol[r]`` are the SYMBOL bytes before it and ``before[r]``
    is the row of the suffix that begins with them (-1: none)."""

    def __init__(self, buffers: list[bytes]):
        sizes = np.array([len(b) for b in buffers], np.int64)
        self.start = np.cumsum(sizes + 1) - sizes - 1   # each segment has a slot for its empty suffix
        n = int((sizes + 1).sum())
        text = np.frombuffer(b"".join(b + b"\0" for b in buffers) + b"\0" * SYMBOL, np.uint8)
        self.offset = np.arange(n) - np.repeat(self.start, sizes + 1)
        self.left = np.repeat(sizes, sizes + 1) - self.offset
        self.segment = np.repeat(np.arange(len(buffers)), sizes + 1)
        gram = np.zeros(n, np.uint64)
        for j in range(SYMBOL):  # bytes past the segment's end read as zero
            gram = (gram << C.U64(8)) | np.where(self.left > j, text[j:n + j], 0).astype(np.uint64)
        rank = _dense(gram)
        width = SYMBOL
        while width * 2 <= LENGTH:
            rank = self._joined(rank, width)
            width *= 2
        if width < LENGTH:
            rank = self._joined(rank, LENGTH - width)
        order = np.argsort(rank, kind="stable")
        self.row = np.empty(n, np.int64)
        self.row[order] = np.arange(n)
        self.position = order
        self.symbol = np.where(self.offset[order] >= SYMBOL, gram[np.maximum(order - SYMBOL, 0)], 0)
        self.before = np.where(self.offset[order] >= SYMBOL, self.row[np.maximum(order - SYMBOL, 0)], -1)
        whole = self.left >= LENGTH
        times = np.bincount(rank[whole], minlength=int(rank.max()) + 1 if n else 1)
        self.repeated = whole & (times[rank] > 1)       # by position, within this shard

    def _joined(self, rank: np.ndarray, step: int) -> np.ndarray:
        """Ranks by ``step`` bytes more: pairs of the ranks of p and p + step."""
        n = len(rank)
        ahead = np.where(self.left >= step, rank[np.minimum(np.arange(n) + step, n - 1)] + 1, 0)
        return _dense(rank * (int(rank.max(initial=0)) + 2) + ahead)


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _stable_order(c: np.ndarray) -> np.ndarray:
    """Stable order of dense ranks, by 16 bits at a time (radix sorts)."""
    order = np.argsort((c & 0xFFFF).astype(np.uint16), kind="stable")
    if len(c) and c.max() > 0xFFFF:
        order = order[np.argsort((c >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def merge(shards: list[Shard]) -> list[np.ndarray]:
    """Flags of each shard's positions: a LENGTH-byte string that starts
    there also starts elsewhere in these shards.

    The merged rows are never materialised: the interleave holds the rows
    still in a block of several shards, in merged order."""
    base = np.cumsum([0] + [len(s.row) for s in shards])
    symbol = _dense(np.concatenate([s.symbol for s in shards]))
    before = np.concatenate([s.before + b for s, b in zip(shards, base)])
    owner = np.repeat(np.arange(len(shards)), np.diff(base))
    can_start = np.concatenate([s.offset[s.position] >= LENGTH for s in shards])
    rows = np.flatnonzero(can_start)                # ends of whole windows, shard by shard
    block = np.zeros(len(rows), np.int64)
    for _ in range(LENGTH // SYMBOL):
        if not len(rows):
            break
        c = symbol[rows]
        order = _stable_order(c)
        c, rows, block = c[order], before[rows[order]], block[order]
        new = np.append(True, (c[1:] != c[:-1]) | (block[1:] != block[:-1]))
        block = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(rows)) - 1
        live = (owner[rows[first]] != owner[rows[last]])[block]  # rows of a block lie shard by shard
        rows, block = rows[live], block[live]
    out = [s.repeated.copy() for s in shards]
    for i, s in enumerate(shards):
        mine = rows[(rows >= base[i]) & (rows < base[i + 1])] - base[i]
        out[i][s.position[mine]] = True
    return out


def repeats(buffers: list[bytes], shards: int = SHARDS):
    """(segment, start, end): maximal stretches of the segments covered by
    LENGTH-byte strings that start at two places of them."""
    dealt = [list(range(i, len(buffers), shards)) for i in range(min(shards, len(buffers)))]
    built = [Shard([buffers[i] for i in d]) for d in dealt]
    seg, at = [], []
    for d, s, flags in zip(dealt, built, merge(built)):
        p = np.flatnonzero(flags)
        seg.append(np.array(d)[s.segment[p]])
        at.append(s.offset[p])
    if not seg:
        z = np.zeros(0, np.int64)
        return z, z, z
    seg, at = np.concatenate(seg), np.concatenate(at)
    order = np.lexsort((at, seg))
    return cover(seg[order], at[order], at[order] + LENGTH)


def cover(owner: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of intervals per owner, given sorted by owner and start."""
    if not len(owner):
        return owner, start, end
    reach = np.maximum.accumulate(end + owner * (1 << 40)) - owner * (1 << 40)
    new = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], start[first], reach[last]


# -- the job ----------------------------------------------------------------

def _wanted(b: pa.RecordBatch):
    """(anchor, oid, windows, bytes) of each wanted class."""
    data, offsets = C.text_buffer(b.column("text"))
    wanted = b.column("wanted")
    which = np.repeat(np.arange(b.num_rows), wanted.value_lengths().to_numpy())
    w = wanted.flatten()
    anchor, oid, lo, windows = (w.field(i).to_numpy(zero_copy_only=False) for i in range(4))
    for i in range(len(which)):
        a = int(offsets[which[i]] + lo[i])
        yield int(anchor[i]), int(oid[i]), int(windows[i]), data[a:a + int(windows[i]) + LENGTH - 1]


def _fetch(b: pa.RecordBatch):
    """Segment bytes of each wanted class."""
    cols = list(zip(*((anchor, oid, seg.tobytes()) for anchor, oid, _, seg in _wanted(b)))) or [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
        cols, (pa.int64(), pa.int64(), pa.binary()))], ["grp", "oid", "bytes"])


def _window_hashes(b: pa.RecordBatch):
    """Hashes of the windows of each wanted class, in order of position."""
    anchors, oids, lengths, hashes = [], [], [], [np.zeros(0, C.U64)]
    for anchor, oid, windows, seg in _wanted(b):
        at = np.arange(windows)
        anchors.append(anchor)
        oids.append(oid)
        lengths.append(windows)
        hashes.append(C.span_hash(C.prefix_hash(seg), at, at + LENGTH))
    yield pa.RecordBatch.from_arrays(
        [pa.array(anchors, pa.int64()), pa.array(oids, pa.int64()),
         C.list_of(np.concatenate(hashes).view(np.int64), np.array(lengths, np.int64))], ["anchor", "oid", "hashes"])


def _counted(hashes: DataFrame) -> DataFrame:
    """(oid, s, e): the stretch of each class that windows cover which
    another class of its gram has too.  Windows of a segment hold one place
    of the gram, so they are all different and any two of them overlap."""
    each = hashes.select("anchor", "oid", F.posexplode("hashes").alias("at", "h"))
    twice = (each.groupBy("anchor", "h").agg(F.min("oid").alias("first"), F.max("oid").alias("last"))
             .where("first != last").select("anchor", "h"))
    return (each.join(twice, ["anchor", "h"]).groupBy("oid")
            .agg(F.min("at").alias("s"), (F.max("at") + LENGTH).alias("e")))


def _merge_packs(batches):
    """Merge whole groups, PACK bytes or more at a time; rows come sorted by
    group."""
    groups, sizes, rows, size = [], [], [], 0
    last = None

    def flush():
        owner, start, end = repeats([r[1] for r in rows])
        if not len(owner):
            return
        oid = np.array([r[0] for r in rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array(oid[owner]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["oid", "s", "e"])

    for b in batches:
        for g, oid, seg in zip(*(b.column(c).to_pylist() for c in ("grp", "oid", "bytes"))):
            if g != last and size >= PACK:
                yield from flush()
                rows, size = [], 0
            last = g
            rows.append((oid, seg))
            size += len(seg)
    if rows:
        yield from flush()


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text, wanted): texts meet their wanted segments by document and
    text, so copies of a text spread out."""
    w = wanted.select(F.col("doc_id").alias("d"), F.col("t").alias("h"), F.col("n_bytes").alias("z"), "wanted")
    keys = w.select("d", "h", "z")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _identity("text").alias("t"),
                        F.octet_length("text").cast("long").alias("n_bytes"))
    texts = texts.join(C.small_side(keys), texts["doc_id"].eqNullSafe(keys["d"]) & (texts["t"] == keys["h"])
                       & (texts["n_bytes"] == keys["z"]), "left_semi")
    return texts.join(w, texts["doc_id"].eqNullSafe(w["d"]) & (texts["t"] == w["h"])
                      & (texts["n_bytes"] == w["z"])).select("text", "wanted")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(t, n_bytes, spans): for each text with repeats, its identity and the
    maximal stretches of bytes [s, e) that repeats cover."""
    spark = docs.sparkSession
    C.use_small_batches(spark)
    listed = C.keep(list_segments(docs), "suffix-list")
    every = listed.select("rid", "doc_id", "t", "n_bytes", "n", F.posexplode(F.arrays_zip(
        "lo", "windows", "anchor", "seg")).alias("i", "x")).select(
        (F.shiftleft("rid", 20) + F.col("i")).alias("oid"), "doc_id", "t", "n_bytes", "n",
        "x.lo", "x.windows", "x.anchor", "x.seg")
    grams = C.keep(listed.select("n", F.explode("anchor").alias("anchor")).groupBy("anchor")
                   .agg(F.sum("n").alias("total")).where("total > 1").select("anchor"), "suffix-grams")
    found = C.keep(every.join(C.small_side(grams), "anchor"), "suffix-found")
    classes = C.keep(found.groupBy("anchor", "seg").agg(F.sum("n").alias("n"), F.min("oid").alias("oid"),
                                                         F.min("windows").alias("windows")),
                     "suffix-classes")
    kinds = classes.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum(F.col("windows") + (LENGTH - 1)).alias("size")).where("kinds > 1")
    open_ = classes.join(kinds, "anchor").select("oid", ((F.col("kinds") > HOT) | (F.col("size") > GROUP)).alias("hot"))
    wanted = (found.join(open_, "oid").groupBy("doc_id", "t", "n_bytes", "hot")
              .agg(F.collect_list(F.struct("anchor", "oid", "lo", "windows")).alias("wanted")))
    wanted = C.keep(wanted, "suffix-wanted")
    cold, hot = wanted.where("not hot"), wanted.where("hot")
    fetched = C.map_arrow(_texts(docs, cold), _fetch, "grp long, oid long, bytes binary")
    fetched = fetched.dropDuplicates(["oid"])  # a row repeated with its id is fetched twice
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = C.keep(fetched.repartition(parts, "grp").sortWithinPartitions("grp", "oid")
                    .mapInArrow(_merge_packs, "oid long, s int, e int"), "suffix-merged")
    if not hot.isEmpty():
        hashes = C.keep(C.map_arrow(_texts(docs, hot), _window_hashes, "anchor long, oid long, hashes array<long>"),
                        "suffix-hashes")
        merged = merged.union(C.keep(_counted(hashes), "suffix-counted"))
    shared = merged.join(classes.where("n = 1").select("oid", "anchor", "seg"), "oid").select("anchor", "seg", "s", "e")
    whole = classes.where("n > 1").select("anchor", "seg", F.lit(0).alias("s"), F.lit(-1).alias("e"))
    spans = (found.select("t", "n_bytes", "lo", "windows", "anchor", "seg").join(shared.union(whole), ["anchor", "seg"])
             .select("t", "n_bytes", (F.col("lo") + F.col("s")).alias("s"),
                     (F.col("lo") + F.when(F.col("e") < 0, F.col("windows") + (LENGTH - 1)).otherwise(F.col("e"))).alias("e")))
    return spans.groupBy("t", "n_bytes").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans"))


def _cuts(b: pa.RecordBatch):
    """Per row: its bytes, and the merged spans to remove."""
    data, offsets = C.text_buffer(b.column("text"))
    spans = b.column("spans")
    lengths = spans.value_lengths().fill_null(0).to_numpy()
    flat = spans.flatten()
    owner, s, e = cover(np.repeat(np.arange(b.num_rows), lengths), flat.field(0).to_numpy().astype(np.int64),
                        flat.field(1).to_numpy().astype(np.int64))
    edge = np.searchsorted(owner, np.arange(b.num_rows + 1))
    for i in range(b.num_rows):
        own = data[offsets[i]:offsets[i + 1]]
        yield own, s[edge[i]:edge[i + 1]], e[edge[i]:edge[i + 1]]


def _left_over(own: np.ndarray, s: np.ndarray, e: np.ndarray) -> bytes:
    cuts = np.concatenate([[0], np.stack([s, e], 1).ravel(), [len(own)]]).astype(np.int64)
    return b"".join(own[a:z].tobytes() for a, z in zip(cuts[::2], cuts[1::2]))


def with_spans(df: DataFrame, spans: DataFrame) -> DataFrame:
    """``df`` (column text) with the spans of its texts; a hot text is a
    skewed join, which AQE splits."""
    keyed = df.withColumn("span_t", _identity("text")).withColumn(
        "span_z", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return keyed.join(spans, (keyed["span_t"] == spans["t"]) & (keyed["span_z"] == spans["n_bytes"]), "left").drop(
        "span_t", "span_z", "t", "n_bytes")


def op10(docs: DataFrame) -> DataFrame:
    """The registered query: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = C.keep(repeated_spans(docs), "suffix-spans")

    def run(b: pa.RecordBatch):
        rows = [(len(own), int((e - s).sum()), len(s), hashlib.sha256(_left_over(own, s, e)).hexdigest())
                for own, s, e in _cuts(b)]
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return C.map_arrow(with_spans(base, spans).select("doc_id", "text", "spans"), run,
                       "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document, its text without the repeated bytes;
    ``n_chars``, where there is one, follows."""
    spans = C.keep(repeated_spans(docs), "suffix-spans")
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")
    held = with_spans(docs.select(columns, "text"), spans).select("d", "text", "spans")
    schema = held.select("d", "text").schema

    def run(b: pa.RecordBatch):
        was_null = b.column("text").is_null().to_pylist()
        left = [None if n else _left_over(own, s, e).decode("utf-8", "ignore")
                for (own, s, e), n in zip(_cuts(b), was_null)]
        yield pa.RecordBatch.from_arrays([b.column("d"), pa.array(left, pa.string())], ["d", "text"])

    out = C.map_arrow(held, run, schema)
    new = {"text": F.col("text"), "n_chars": F.length("text")}
    kinds = dict(docs.dtypes)
    return out.select(*[(new[c].cast(kinds[c]) if c in new else F.col("d")[c]).alias(c) for c in docs.columns])
