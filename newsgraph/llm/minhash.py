"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A text's shingles are its runs of five words (bytes ``[0-9a-z]`` and all
non-ASCII ones after lower-casing A-Z), weighted by how often they occur; a
text of one to four words is one shingle.  Each shingle is a Poisson process
of arrivals at random registers whose rate is its weight; arrivals are drawn
until none can still lower a register (early termination), and the share of
registers with the same winner estimates the probability Jaccard
similarity.  Registers are banded, and every candidate is verified exactly.

Edge cases: copies (equal texts; a null counts as empty) are one class
whatever their length, without being compared; a text without words links
with nothing else; rows that repeat a doc_id are versions of one document;
a row with a null doc_id is in no class (null) and is kept; other columns
are ignored, and kept by the pipeline stage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.llm import common as C
from newsgraph.llm import lsh

SIMILARITY = 0.8
SHINGLE_WORDS = 5
BANDS, ROWS = 20, 4   # a pair at 0.8 shares no band with probability 3e-5


def prob_minhash(rows: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """(n, k) winners, 32 bits each, of the weighted sets given as (row,
    hash, weight) sorted by row; a row without elements is all ones."""
    best = np.full(n * k, np.iinfo(np.uint64).max, dtype=C.U64)  # arrival (float32 bits) above, winner below
    low = C.mix64(h) & C.U64(0xFFFFFFFF)
    at, state, time, rate, base = np.arange(len(h)), h.copy(), np.zeros(len(h)), weight.astype(float), rows * k
    full = np.zeros(n)
    step = 0
    while len(at):
        step += 1
        state = C.mix64(state + C.U64(0x9E3779B97F4A7C15 * (2 * step + 1) & 0xFFFFFFFFFFFFFFFF))
        u = ((state >> C.U64(11)).astype(float) + 1) * (1.0 / (1 << 53))
        time = time - np.log(u) / rate
        alive = time.astype(np.float32) <= full[rows[at]] if step > 1 else np.ones(len(at), bool)
        at, state, time, rate = at[alive], state[alive], time[alive], rate[alive]
        if not len(at):
            break
        register = ((C.mix64(state) >> C.U64(32)) * C.U64(k) >> C.U64(32)).astype(np.int64)
        packed = (time.astype(np.float32).view(np.uint32).astype(C.U64) << C.U64(32)) | low[at]
        np.minimum.at(best, base[at] + register, packed)
        worst = best.reshape(n, k).max(1)
        full = np.where(worst == np.iinfo(np.uint64).max, np.inf,
                        (worst >> C.U64(32)).astype(np.uint32).view(np.float32))
    return (best & C.U64(0xFFFFFFFF)).astype(np.uint32).reshape(n, k)


def _signatures(b: pa.RecordBatch):
    words = C.scan_words(b.column("text"))
    rows, h, count = C.shingle_sets(words, b.num_rows, SHINGLE_WORDS)
    keys = lsh.band_keys(prob_minhash(rows, h, count, b.num_rows, BANDS * ROWS), ROWS)
    some = np.bincount(rows, minlength=b.num_rows) > 0
    yield pa.RecordBatch.from_arrays(
        [b.column("doc_id"), b.column("key"), C.list_of(keys[some].ravel(), np.where(some, BANDS, 0))],
        ["doc_id", "key", "bands"])


def _sets(b: pa.RecordBatch):
    yield lsh.pack_sets(b.column("id"), *C.shingle_sets(C.scan_words(b.column("text")), b.num_rows, SHINGLE_WORDS))


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(doc_id, key, class_id), one row per row of ``docs`` with an id;
    ``key`` identifies the text, ``class_id`` is the smallest doc_id of the
    documents reachable by links."""
    C.use_small_batches(docs.sparkSession)
    base = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", C.text_key("text").alias("key"))
    sig = C.keep(C.map_arrow(base, _signatures, "doc_id long, key string, bands array<long>"), "minhash-sig")
    texts = C.keep(sig.groupBy("key").agg(F.min(F.struct("doc_id", "bands")).alias("m"))
                   .select("key", F.col("m.doc_id").alias("id"), "m.bands"), "minhash-texts")
    bands = texts.select("id", F.explode("bands").alias("band"))

    def make_sets(ids: DataFrame) -> DataFrame:
        wanted = texts.join(ids, "id").select("id", "key")
        found = (base.join(wanted, [base["doc_id"] == wanted["id"], base["key"] == wanted["key"]])
                 .select("id", "text"))
        return C.map_arrow(found, _sets, lsh.SETS)

    linked = lsh.classes(bands, None, make_sets, threshold, "minhash")
    of_text = (texts.select("key", "id").join(linked.withColumnRenamed("node", "id"), "id", "left")
               .select("key", F.coalesce("root", "id").alias("class_id")))
    return sig.select("doc_id", "key").join(of_text, "key").select("doc_id", "key", "class_id")


def op3(docs: DataFrame) -> DataFrame:
    """The registered query: doc_id, class_id, kept."""
    found = near_duplicates(docs).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
    none = docs.where("doc_id is null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"),
        F.lit(True).alias("kept"))
    return found.union(none)


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class the document with the smallest id
    stays, once; rows without an id stay."""
    classes = near_duplicates(docs)
    gone = C.keep(classes.where("doc_id != class_id").select(
        F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key")).distinct(), "minhash-gone")
    key = C.fresh(docs, "text_key")
    keyed = docs.withColumn(key, C.text_key("text"))
    left = keyed.join(gone, (keyed["doc_id"] == gone["gone_id"]) & (keyed[key] == gone["gone_key"]), "left_anti")
    return left.dropDuplicates(["doc_id", key]).drop(key)
