"""Density clustering of topic vectors as Spark jobs.

Core distance (min_samples = m, weights = copies of a topic): the smallest
distance ``d`` at which the point's other copies plus the weights of its
neighbours within ``d`` reach ``m``; from exact neighbours by pivot cells
(``neighbours``).

``density_clusters`` chooses the clusters itself: the minimum spanning tree of
mutual reachability (``forest``), the condensed hierarchy of its components,
and the selection by stability (``hierarchy``).  ``density_components`` gives
the clusters at one density level: spanning forests of what
is under the cut, never every edge, and their components are found by star
contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.operators import forest
from newsgraph.operators.forest import block_forests, connected_components, listed_tree, reachability_tree
from newsgraph.operators.hierarchy import condense
from newsgraph.operators.neighbours import DEFAULT_BLOCK, knn
from newsgraph.session import Rounds

MIN_SAMPLES = 2
MIN_CLUSTER_SIZE = 2


def core_distances(points: DataFrame, min_samples: int = MIN_SAMPLES,
                   block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``(id, weight, core)`` for ``points(id, vec, weight)``."""
    return _cores(points, knn(points, min_samples, block_size), min_samples)


def _cores(points: DataFrame, nn: DataFrame, min_samples: int) -> DataFrame:
    """Core distances from neighbours, of which more may be listed."""
    nn = nn.select("id", F.slice("nbrs", 1, min_samples).alias("nbrs"))
    p = points.select("id", F.coalesce(F.col("weight"), F.lit(1)).cast("bigint").alias("weight"))
    j = p.join(nn, "id", "left")
    need = F.lit(min_samples) - (F.col("weight") - 1)
    # running weight over the sorted neighbours; first neighbour where it reaches `need`
    cum = F.aggregate(
        F.coalesce(F.col("nbrs"), F.array().cast("array<struct<d:double,nb:bigint,w:bigint>>")),
        F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(None).cast("double").alias("core")),
        lambda acc, x: F.struct(
            (acc["s"] + x["w"]).alias("s"),
            F.when(acc["core"].isNull() & (acc["s"] + x["w"] >= need), x["d"]).otherwise(acc["core"]).alias("core")))
    core = F.when(need <= 0, F.lit(0.0)).otherwise(cum["core"])
    # fewer neighbours than needed: infinite core distance (never core)
    return j.select("id", "weight", F.coalesce(core, F.lit(float("inf"))).alias("core"))


def _listed(points: DataFrame, min_samples: int, block_size: int, rounds: Rounds) -> tuple[DataFrame, DataFrame | None, int]:
    """The cores, and the neighbour lists that a large table's tree is joined
    from with their length; one search gives both."""
    if points.count() <= forest.SMALL:
        return rounds.put("cores", core_distances(points, min_samples, block_size)), None, 0
    listed = max(min_samples, forest.LISTED)
    nn = rounds.put("near", knn(points, listed, block_size))
    return rounds.put("cores", _cores(points, nn, min_samples)), nn, listed


def _weighted(points: DataFrame) -> DataFrame:
    if "weight" not in points.columns:
        points = points.withColumn("weight", F.lit(1).cast("bigint"))
    return points


def density_components(points: DataFrame, cut: float, min_samples: int = MIN_SAMPLES,
                       min_cluster_size: int = MIN_CLUSTER_SIZE,
                       block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Clusters at one density level (DBSCAN*): core points (core distance
    ≤ cut) joined by mutual-reachability edges ≤ cut; a component whose
    total weight reaches ``min_cluster_size`` is a cluster labelled by its
    smallest id, everything else is noise (-1).  Returns ``(id, cluster,
    core)``."""
    points = _weighted(points)
    rounds = Rounds(points.sparkSession, "density")
    cores, nn, listed = _listed(points, min_samples, block_size, rounds)
    core_pts = cores.filter(F.col("core") <= cut).select("id", "weight")
    links = (block_forests(points, cores, block_size, cut) if nn is None
             else listed_tree(points, cores, nn, listed, block_size, cut))
    comps = connected_components(core_pts, links)
    sizes = (comps.join(core_pts, "id").groupBy("comp").agg(F.sum("weight").alias("_size")))
    labelled = (comps.join(sizes, "comp")
                .select("id", F.when(F.col("_size") >= min_cluster_size, F.col("comp"))
                        .otherwise(F.lit(-1)).cast("bigint").alias("cluster")))
    return (cores.join(labelled, "id", "left")
            .select("id", F.coalesce(F.col("cluster"), F.lit(-1).cast("bigint")).alias("cluster"), "core"))


def density_tree(points: DataFrame, min_samples: int = MIN_SAMPLES,
                 block_size: int = DEFAULT_BLOCK) -> tuple[DataFrame, DataFrame]:
    """The spanning tree ``(a, b, w)`` of mutual reachability, and the cores
    ``(id, weight, core)`` it was made with."""
    points = _weighted(points)
    cores, nn, listed = _listed(points, min_samples, block_size, Rounds(points.sparkSession, "density"))
    return reachability_tree(points, cores, block_size, neighbours=nn, listed=listed), cores


def density_clusters(points: DataFrame, min_cluster_size: int = MIN_CLUSTER_SIZE, min_samples: int | None = None,
                     block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Clusters chosen by stability over the whole density hierarchy:
    ``(id, cluster, core)``, a cluster labelled by its smallest id, noise -1.
    ``min_samples`` is the least cluster size unless given.  One cluster that
    holds everything is never the answer; edges of equal weight act at once."""
    tree, cores = density_tree(points, min_cluster_size if min_samples is None else min_samples, block_size)
    return condense(cores, tree, min_cluster_size).join(cores.select("id", "core"), "id")
