"""Topic vectors and k-means.

Vectors are computed for the *distinct* topics with a weight (number of
rows); a weighted point stands for its copies, so centroids equal those of
the full row set while the work scales with the number of distinct topics.

Seeded k-means keeps its ``k × d`` centres on the driver between rounds
(``k`` is the number of given topics, so this is bounded by the caller's
list, not by the data); each round is one pass over the points: whole Arrow
batches against the centres in numpy, and one sum per centre and task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.functions.text import ws_tokens
from newsgraph.operators.neighbours import distances, vectors_of

W2V_DIM, W2V_WINDOW, W2V_MIN_COUNT = 100, 5, 1


W2V_PARTITIONS = 8       # parallel parts of the training; fixed, as the vectors depend on it
W2V_PASSES = 5


def train_word2vec(df: DataFrame, col: str = "topics", dim: int = W2V_DIM, window: int = W2V_WINDOW,
                   min_count: int = W2V_MIN_COUNT, seed: int = 42, partitions: int | None = None):
    """Word2Vec over the whitespace words of every non-null topic row.

    Training makes ``W2V_PASSES`` passes in ``partitions`` parallel parts, of
    rows in a fixed order, so the vectors follow from the data and the seed
    and not from the number of cores."""
    from pyspark.ml.feature import Word2Vec

    partitions = partitions or W2V_PARTITIONS
    words = df.filter(F.col(col).isNotNull()).select(ws_tokens(F.col(col)).alias("_words"))
    words = words.repartition(partitions, F.xxhash64("_words")).sortWithinPartitions("_words")
    w2v = Word2Vec(vectorSize=dim, windowSize=window, minCount=min_count, seed=seed,
                   numPartitions=partitions, maxIter=W2V_PASSES, inputCol="_words", outputCol="_vec")
    return w2v.fit(words)


def topic_vectors(topics: DataFrame, model, col: str = "topic") -> DataFrame:
    """``topics`` + ``vec array<double>``: mean of the topic's word vectors."""
    from pyspark.ml.functions import vector_to_array

    t = topics.withColumn("_words", ws_tokens(F.col(col)))
    out = model.transform(t)
    return out.withColumn("vec", vector_to_array("_vec")).drop("_words", "_vec")


def mean_word_vectors(topics: DataFrame, words: DataFrame, col: str = "topic") -> DataFrame:
    """Mean of word vectors from a given ``(word, vec)`` table: the
    averaging step alone, as joins and aggregations.  A word missing from
    the table is skipped; a topic with no known word gets no row."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    toks = topics.select(F.col(col).alias("topic"), F.posexplode(ws_tokens(F.col(col))).alias("wpos", "word"))
    joined = toks.join(words.select("word", F.col("vec")), "word", "inner")
    vec = array_to_vector(F.col("vec").cast("array<double>"))
    return joined.groupBy("topic").agg(vector_to_array(Summarizer.mean(vec)).alias("vec"))


def kmeans(points: DataFrame, k: int, seed: int = 42, vec_col: str = "vec", max_iter: int = 300,
           weight_col: str | None = None) -> tuple[DataFrame, list[list[float]]]:
    """Plain k-means (k-means|| start, fixed seed): the points with
    ``cluster``, and the centres."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    p = points.withColumn("_v", array_to_vector(F.col(vec_col)))
    km = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_v", predictionCol="cluster")
    if weight_col:
        km = km.setWeightCol(weight_col)
    model = km.fit(p)
    return model.transform(p).drop("_v"), [list(map(float, c)) for c in model.clusterCenters()]


def _nearest(vectors, centres):
    """Row numbers of the nearest centres (the lowest on a tie)."""
    return distances(vectors, centres).argmin(1)


def assign(points: DataFrame, centres: list[list[float]], vec_col: str = "vec") -> DataFrame:
    """Nearest centre (lowest index on a tie) → ``cluster``; whole Arrow
    batches at a time, the centres sent once (k × d values)."""
    sent = points.sparkSession.sparkContext.broadcast(np.array(centres, np.float64))
    schema = T.StructType([*points.schema.fields, T.StructField("cluster", T.IntegerType())])

    def run(batches):
        for b in batches:
            if b.num_rows:
                cluster = _nearest(vectors_of(b.column(vec_col)), sent.value)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cluster, pa.int32())], [*b.schema.names, "cluster"])

    return points.mapInArrow(run, schema)


def _weighted_means(points: DataFrame, centres: list[list[float]], vec_col: str, weight_col: str | None) -> dict[int, list[float]]:
    """Means of the points nearest to each centre: a task gives one sum per
    centre, and sums of tasks are added as vectors."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    sent = points.sparkSession.sparkContext.broadcast(np.array(centres, np.float64))
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)

    def run(batches):
        k, d = sent.value.shape
        total, held = np.zeros((k, d)), np.zeros(k)
        for b in batches:
            if b.num_rows:
                v, w = vectors_of(b.column("v")), b.column("w").to_numpy()
                at = _nearest(v, sent.value)
                np.add.at(total, at, v * w[:, None])
                held += np.bincount(at, weights=w, minlength=k)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(held[some]), pa.array(total[some].tolist(), pa.list_(pa.float64()))],
            ["cluster", "w", "v"])

    sums = points.select(F.col(vec_col).cast("array<double>").alias("v"), weight.alias("w")).mapInArrow(
        run, "cluster int, w double, v array<double>")
    rows = (sums.groupBy("cluster").agg(F.sum("w").alias("w"), vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).collect())
    return {r["cluster"]: [x / r["w"] for x in r["v"]] for r in rows}


def seeded_kmeans(points: DataFrame, seeds: list[list[float]], vec_col: str = "vec",
                  weight_col: str | None = None, max_iter: int = 300, tol: float = 1e-4,
                  fixed_iterations: int | None = None) -> tuple[DataFrame, list[list[float]]]:
    """Lloyd's k-means from the given initial centres (one start).

    ``fixed_iterations`` runs exactly that many update rounds; otherwise
    rounds stop when the squared centre shift falls below ``tol`` times the
    mean per-dimension variance, or after ``max_iter``.  A cluster left empty
    keeps its centre.  Returns the points with ``cluster`` and the centres."""
    centres = [list(map(float, s)) for s in seeds]
    pts = points.select("*").persist()
    try:
        threshold = 0.0
        if fixed_iterations is None and tol > 0:
            from pyspark.ml.functions import array_to_vector, vector_to_array
            from pyspark.ml.stat import Summarizer

            w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
            var = (pts.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("_v"), w.alias("_w"))
                   .withColumn("_q", F.transform(vector_to_array("_v"), lambda x: x * x))
                   .agg(vector_to_array(Summarizer.mean(F.col("_v"), F.col("_w"))).alias("m"),
                        vector_to_array(Summarizer.mean(array_to_vector("_q"), F.col("_w"))).alias("q")).first())
            # population variance over all copies: the mean square less the squared mean
            var = [q - m * m for q, m in zip(var["q"], var["m"])] if var["m"] else []
            threshold = tol * (sum(var) / len(var) if var else 0.0)
        rounds = fixed_iterations if fixed_iterations is not None else max_iter
        for _ in range(rounds):
            means = _weighted_means(pts, centres, vec_col, weight_col)
            new = [means.get(i, c) for i, c in enumerate(centres)]
            shift = sum((a - b) ** 2 for c0, c1 in zip(centres, new) for a, b in zip(c0, c1))
            centres = new
            if fixed_iterations is None and shift <= threshold:
                break
        return assign(points, centres, vec_col), centres
    finally:
        pts.unpersist()
