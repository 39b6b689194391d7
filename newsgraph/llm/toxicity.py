"""Toxicity scores by FTRL-proximal logistic regression.

Features of a text are the distinct hashed word unigrams, bigrams and
one-word skip-grams of the whole text.  Training runs FTRL-proximal in
rounds: each round every shard of the training rows starts from the shared
state, passes once over its rows with per-coordinate rates, and the shards'
states are averaged per coordinate by a grouped aggregation.  L1 keeps the
weights sparse; the state never exceeds ``2 ** HASH_BITS`` coordinates, so
both what the driver collects and what scoring broadcasts is bounded.

Edge cases: a null or empty text has no features and scores the model's
bias; labels that are null are not used; a document with several labels
counts as toxic if any says so; with no training rows every score is 0;
columns other than those named are passed through untouched."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.llm import common as C

HASH_BITS = 18        # size of the hashed feature space
TRAIN_ROWS = 20_000   # bound of the labelled training sample
SHARDS = 4            # parallel FTRL learners
ROUNDS = 4            # passes over the sample
ALPHA, BETA, L1, L2 = 0.5, 1.0, 6.0, 1.0
POSITIVE_WEIGHT = 4.0  # toxic rows are rare
BIAS = 1 << HASH_BITS
HELD_OUT = 5          # crc32(doc_id) mod 5 = 0 is never trained on


class Model(NamedTuple):
    """Sparse weights: coordinates, ascending, and their values."""
    index: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << HASH_BITS)
        w[self.index] = self.weight
        return w


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, coordinate) of every gram of every text, repeats included."""
    w = C.scan_words(texts)
    rows, out = [w.row], [w.hash]
    for step, factor in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
        if len(w.row) > step:
            same = w.row[:-step] == w.row[step:]
            rows.append(w.row[:-step][same])
            out.append(C.mix64(w.hash[:-step] * C.U64(factor) + w.hash[step:])[same])
    return np.concatenate(rows), (np.concatenate(out) >> C.U64(64 - HASH_BITS)).astype(np.int64)


def distinct_features(rows: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, coordinate) once, sorted."""
    key = np.unique((rows << HASH_BITS) | index)
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1)


def scores(texts: pa.Array, dense: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1 for each text."""
    rows, index = text_features(texts)
    used = dense[index] != 0
    rows, index = distinct_features(rows[used], index[used])
    logit = np.bincount(rows, weights=dense[index], minlength=len(texts))[:len(texts)] + bias
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def ftrl_pass(examples, z: np.ndarray, n: np.ndarray) -> None:
    """One pass of FTRL-proximal over (coordinates, label) pairs; updates
    the accumulators in place.  The last coordinate is the bias, free of L1."""
    for index, label in examples:
        at = np.append(index, BIAS)
        zi, ni = z[at], n[at]
        w = weights_of(zi, ni, at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = (p - label) * (POSITIVE_WEIGHT if label else 1.0)
        step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
        z[at] = zi + g - step * w
        n[at] = ni + g * g


def weights_of(z: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    l1 = np.where(at == BIAS, 0.0, L1)
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> DataFrame:
    """(shard, pos, label, index): the bounded training sample, chosen by a
    hash of the id among labelled rows outside the held-out fold."""
    in_fold = F.expr(f"pmod(crc32(cast(cast(doc_id as string) as binary)), {HELD_OUT}) != 0")
    picked = (labels.where("toxic is not null and doc_id is not null").where(in_fold)
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
              .select("doc_id", "label", F.xxhash64("doc_id").alias("pos"))
              .orderBy("pos", "doc_id").limit(max_rows))
    # at most max_rows narrow rows, whatever the input: safe to broadcast
    text = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
            .groupBy("doc_id", "label", "pos").agg(F.min("text").alias("text")))

    def extract(b: pa.RecordBatch):
        rows, index = distinct_features(*text_features(b.column("text")))
        yield pa.RecordBatch.from_arrays(
            [b.column("pos"), b.column("label"),
             C.list_of(index.astype(np.int32), C.row_counts(rows, b.num_rows))], ["pos", "label", "index"])

    return C.map_arrow(text.select("pos", "label", "text"), extract, "pos long, label int, index array<int>")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS, rounds: int = ROUNDS) -> Model:
    """Fit the model; see the module's text.  Deterministic for given rows."""
    spark = docs.sparkSession
    C.use_small_batches(spark)
    rows = (training_rows(docs, labels, max_rows)
            .withColumn("shard", F.pmod(F.col("pos"), F.lit(SHARDS)).cast("int"))
            .repartition(SHARDS, "shard").sortWithinPartitions("shard", "pos"))
    rows = C.keep(rows, "toxic-train")
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
    for _ in range(rounds):
        at = np.flatnonzero((z != 0) | (n != 0)).astype(np.int32)
        state = spark.sparkContext.broadcast((at, z[at], n[at]))  # at most 2 ** HASH_BITS + 1 coordinates

        def learn(pdf):
            import pandas as pd

            at, z0, n0 = state.value
            z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
            z[at], n[at] = z0, n0
            pdf = pdf.sort_values("pos")
            ftrl_pass(zip(pdf["index"], pdf["label"]), z, n)
            out = np.flatnonzero((z != 0) | (n != 0))
            return pd.DataFrame({"i": out.astype(np.int32), "z": z[out], "n": n[out]})

        # as Arrow columns: rows of Python objects would take ten times the memory
        moved = (rows.groupBy("shard").applyInPandas(learn, "i int, z double, n double")
                 .groupBy("i").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow())
        shards = rows.select("shard").distinct().count()
        state.unpersist()
        if not moved.num_rows:
            return Model(np.zeros(0, np.int64), np.zeros(0), -35.0)
        z[:], n[:] = 0, 0
        i = moved.column("i").to_numpy()
        z[i], n[i] = moved.column("z").to_numpy() / shards, moved.column("n").to_numpy() / shards
    at = np.arange(BIAS + 1)
    w = weights_of(z, n, at)
    index = np.flatnonzero(w[:BIAS])
    return Model(index, w[index], float(w[BIAS]))


def score_texts(df: DataFrame, model: Model, text: str = "text", column: str = "score",
                keep_below: float | None = None) -> DataFrame:
    """``df`` with the score of each whole text in ``column`` (a column of
    that name is replaced); with ``keep_below``, ``df`` itself without the
    rows that score that much or more."""
    spark = df.sparkSession
    C.use_small_batches(spark)
    sent = spark.sparkContext.broadcast(tuple(model))  # plain arrays, bounded by the hashed space
    names = [c for c in df.columns if c != column or keep_below is not None]
    schema = df.select(*[F.col(f"`{c}`") for c in names]).schema

    def run(batches):
        own = Model(*sent.value)
        dense, bias = own.dense(), own.bias
        for b in batches:
            s = scores(b.column(text), dense, bias)
            if keep_below is not None:
                yield b.filter(pa.array(s < keep_below))
            else:
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(s)], [*names, column])

    out = schema if keep_below is not None else schema.add(column, "double")
    src = df if keep_below is not None else df.select(*[F.col(f"`{c}`") for c in df.columns])
    return src.mapInArrow(run, out)


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query: doc_id, held_out, score, predicted."""
    model = train(docs, labels)
    scored = score_texts(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(F.expr(f"pmod(crc32(cast(cast(doc_id as string) as binary)), {HELD_OUT}) = 0"),
                   F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that score 0.5 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_texts(docs, train(docs, labels), keep_below=0.5)
