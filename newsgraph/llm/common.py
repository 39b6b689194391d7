"""Helpers shared by the training-data operators.

* byte-wise word scanning of whole Arrow string columns with numpy,
* tables in the shared folder (lineage cuts that survive lost executors),
* connected components as Spark joins."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgraph.session import materialize

ARROW_ROWS = 500            # rows per Arrow batch handed to Python workers
PIECE_BYTES = 1 << 17       # text is scanned in pieces of about this size

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)

_bytes = np.arange(256)
LOWER = _bytes.astype(np.uint8)
LOWER[65:91] += 32
#: bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
WORD_BYTE = (_bytes >= 128) | ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 97) & (_bytes <= 122))
#: bytes of ``[^\x20\x09-\x0D]+``
NON_SPACE_BYTE = ~((_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13)))


def use_small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows per Arrow batch: whole documents can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back with its schema."""
    return materialize(df, f"llm-{name}")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            out = np.full(size, base, dtype=U64)
            out[0] = 1
            _powers[key] = np.cumprod(out, dtype=U64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H[i] = sum over j < i of (data[j] + 1) * base**j, modulo 2**64."""
    up, _ = powers(len(data))
    out = np.empty(len(data) + 1, dtype=U64)
    out[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * up, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings [start, end) of a prefix-hashed piece."""
    _, down = powers(len(prefix))
    h = (prefix[end] - prefix[start]) * down[start]
    return mix64(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and the row offsets into them;
    a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, count=n + 1 + column.offset)[column.offset:]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


class Words(NamedTuple):
    row: np.ndarray    # row of each word, ascending
    hash: np.ndarray   # 64-bit hash of its bytes
    start: np.ndarray  # byte position in the column's buffer
    end: np.ndarray


def scan_words(column: pa.Array, word_byte: np.ndarray = WORD_BYTE, lower: bool = True,
               hashes: bool = True) -> Words:
    """All words of a string column, in order.  Long columns are scanned in
    pieces cut between words, so working memory does not follow the length
    of a text."""
    data, offsets = text_buffer(column)
    starts, ends, hashed = [], [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + PIECE_BYTES, n)
        if hi < n:
            hi = _cut(data, offsets, lo, hi, word_byte, lower)
        piece = data[lo:hi]
        if lower:
            piece = LOWER[piece]
        inside = word_byte[piece]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = offsets[np.searchsorted(offsets, lo, "right"):np.searchsorted(offsets, hi, "left")] - lo
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if hashes:
            hashed.append(span_hash(prefix_hash(piece), s, e))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    if not starts:
        z = np.zeros(0, np.int64)
        return Words(z, np.zeros(0, U64), z, z)
    s, e = np.concatenate(starts), np.concatenate(ends)
    h = np.concatenate(hashed) if hashes else np.zeros(0, U64)
    per_row = np.diff(np.searchsorted(s, offsets))
    return Words(np.repeat(np.arange(len(per_row)), per_row), h, s, e)


def _cut(data, offsets, lo, hi, word_byte, lower) -> int:
    """A place at or before ``hi`` (after it for a word longer than a piece)
    where no word is cut."""
    row_start = offsets[np.searchsorted(offsets, hi, "right") - 1]
    inside = word_byte[LOWER[data[lo:hi]] if lower else data[lo:hi]]
    gaps = np.flatnonzero(~inside)
    place = max(int(row_start), lo + int(gaps[-1]) + 1 if len(gaps) else 0)
    if place > lo:
        return min(place, hi)
    step, n = PIECE_BYTES, len(data)
    while hi < n:
        ahead = data[hi:hi + step]
        out = np.flatnonzero(~word_byte[LOWER[ahead] if lower else ahead])
        limit = offsets[np.searchsorted(offsets, hi, "left")]
        stop = hi + int(out[0]) if len(out) else hi + len(ahead)
        if stop >= limit:
            return int(limit)
        if len(out):
            return stop
        hi = stop
    return n


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n)


def shingles(words: Words, n_rows: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each run of ``size`` words; a text with fewer words,
    but not none, is one shingle."""
    counts = row_counts(words.row, n_rows)
    n = len(words.row)
    rows, out = [], []
    if n >= size:
        h = np.zeros(n - size + 1, U64)
        for j in range(size):
            h = (h + words.hash[j:n - size + 1 + j]) * U64(0xD1342543DE82EF95)
        whole = words.row[:n - size + 1] == words.row[size - 1:]
        rows.append(words.row[:n - size + 1][whole])
        out.append(mix64(h[whole]))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first, length = (np.cumsum(counts) - counts)[short], counts[short]
        h = np.zeros(len(short), U64)
        for j in range(size - 1):
            h = np.where(j < length, (h + words.hash[np.minimum(first + j, n - 1)]) * U64(0xD1342543DE82EF95), h)
        rows.append(short)
        out.append(mix64(h + length.astype(U64)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    rows, out = np.concatenate(rows), np.concatenate(out)
    if len(short):
        order = np.argsort(rows, kind="stable")
        rows, out = rows[order], out[order]
    return rows, out


SHINGLE_BITS = 48


def shingle_sets(words: Words, n_rows: int, size: int = 5):
    """(row, hash, count) of the distinct shingles, sorted by row and hash.
    Hashes are cut to 48 bits, so that row and hash sort as one integer."""
    rows, h = shingles(words, n_rows, size)
    if not len(rows):
        return rows, h, np.zeros(0, np.int64)
    key = np.sort((rows.astype(U64) << U64(SHINGLE_BITS)) | (h >> U64(64 - SHINGLE_BITS)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    key = key[at]
    return ((key >> U64(SHINGLE_BITS)).astype(np.int64), key & U64((1 << SHINGLE_BITS) - 1),
            np.diff(np.append(at, len(rows))))


def text_key(column: Column | str) -> Column:
    """Exact identity of a text: 128 bits of its SHA-256 as a string (null
    and empty texts share one key)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.substring(F.sha2(F.coalesce(c, F.lit("")), 256), 1, 32)


def list_of(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Arrow list column from flat values and per-row lengths."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` over record batches, one call of ``fn`` per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from fn(b)
    return df.mapInArrow(run, schema)


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """Connected components of an edge table: (node, root), root being the
    smallest node of the component.

    Alternating large-star and small-star steps; each step is a min
    aggregation (combined map-side) and a join that AQE can split on a hot
    node, and each round's edges are written to the shared folder.  It
    stops when a round changes nothing."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e = keep(e, name)
    mark = _edge_mark(e)
    while mark[0]:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u"), F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").union(low2.select("u", F.col("m").alias("v"))).distinct())
        e = keep(small, name)
        new = _edge_mark(e)
        if new == mark:
            break
        mark = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _edge_mark(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)).alias("n"),
                F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet."""
    name, used = base, {c.lower() for c in df.columns}
    while name.lower() in used:
        name = f"_{name}"
    return name


BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if a count finds it small enough, else as
    it is: the join then shuffles."""
    most = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
